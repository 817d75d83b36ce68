import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chunking, datasets, dedup, extract, graph, metrics, resolve
from millrace.operators.quality import quality_profile


def words(t):
    return len(t.split())


@settings(max_examples=150, deadline=None)
@given(st.text("ab. \n!", max_size=120), st.integers(3, 12))
def test_budget_spans_join_to_the_text(t, most):
    spans = chunking.budget_spans(t, lambda x: len(x), most)
    assert "".join(t[a:b] for a, b in spans) == t and all(b - a <= most for a, b in spans)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=4), max_size=60), st.integers(2, 9))
def test_sentence_chunks_keep_every_word_and_the_budget(ws, target):
    t = ". ".join(ws)
    got = chunking.sentence_chunks(t, target, 0)
    assert " ".join(got).split() == t.split()
    assert len(got) == 1 or all(words(c) <= target for c in got)


def test_chunkers():
    t = "\n\n".join(f"section {i} " + "x" * 120 for i in range(20))
    got = chunking.fixed_chunks(t)
    assert all(len(c) <= 500 for c in got) and chunking.fixed_chunks("short") == ["short"] and chunking.chunk_estimate("short") == 1 and chunking.chunk_estimate(t) >= 5
    out = chunking.sentence_chunks("Một câu ngắn. Hai câu ngắn nữa. Ba câu ngắn cuối cùng.", 9, 0)
    assert len(out) >= 2 and all(c.endswith(".") for c in out)
    vectors = {"One two.": (1, 0), "Three four.": (0.9, 0.1), "Five six.": (0, 1)}
    assert len(chunking.semantic_chunks("One two. Three four. Five six.", lambda s: [vectors[x] for x in s], 6, 0, 0.5)) == 2


def test_shards_and_balance(spark):
    r = spark.createDataFrame([(f"r{i}", i % 7 + 1) for i in range(200)], "id string, n int")
    plan = chunking.shard_plan(r, "id", "n", 20).toPandas()
    assert len(plan) == 200 and plan.groupby(["lane", "shard"]).tokens.sum().max() <= 20
    kept = chunking.running_balance(spark.createDataFrame([(i, 10) for i in range(50)], "i int, n int"), "i", "n", 95)
    assert sorted(x.i for x in kept.collect()) == list(range(9))


def test_text_functions(spark):
    d = spark.createDataFrame([("  “A” – b…\r\n\r\n\r\n\r\nc\td ",)], "t string")
    assert d.select(T.clean_english(F.col("t"))).first()[0] == '"A" - b...\n\nc d'
    q = spark.createDataFrame([("Bad!", "en"), ("a b c\na b c\nanother line that is longer than the rest of them", "en"), ("x" * 12 + " word" * 12, "en")], "t string, l string")
    got = [r.p for r in q.select(quality_profile(F.col("t"), F.col("l")).alias("p")).collect()]
    assert got[0].rejection_reasons == ["too_short_characters", "too_short_words"] and got[1].review_flags == ["repeated_lines"] and got[2].review_flags == ["repeated_characters"]
    s = spark.createDataFrame([("One is here. Ann met Bob! Later…\nEnd", "ann", "BOB")], "t string, a string, b string")
    assert s.select(T.evidence_for(T.evidence_sentences(F.col("t")), F.col("a"), F.col("b"))).first()[0] == "Ann met Bob!"
    assert s.select(T.sentences(F.col("t"))).first()[0] == ["One is here.", "Ann met Bob!", "Later…", "End"]
    assert s.select(T.snippet(F.col("t"), F.col("b"), 4)).first()[0] == "met Bob! La"
    assert spark.range(1).select(T.sanitize_relation(F.lit(" is-a? ")), T.acronym(F.lit("World Health Org")), T.kg_name(F.lit("The  Old Mill, "))).first()[:] == ("IS_A", "who", "old mill")
    page = spark.createDataFrame([("Tải xuống\n12/03/2024\n45\nreal line\nab\nSố ký hiệu 3",)], "t string")
    assert page.select(T.drop_furniture(F.col("t"))).first()[0] == "real line"


def test_set_pairs_and_greedy(spark):
    r = random.Random(1)
    sets = [(i, [f"x{r.randrange(30)}" for _ in range(r.randrange(1, 12))]) for i in range(120)]
    df = spark.createDataFrame(sets, "id int, s array<string>")
    first = {}
    for i, s in sets:
        first.setdefault(frozenset(s), i)
    reps = sorted((i, s) for s, i in first.items())
    want = {(a, b) for x, (a, s) in enumerate(reps) for b, t in reps[x + 1 :] if len(s & t) / len(s | t) >= 0.5}
    assert {(x.a, x.b) for x in dedup.set_pairs(df, "id", "s", 0.5).collect()} == want
    kept, gone = [], set()
    near = {i: set() for i, _ in reps}
    for a, b in want:
        near[b].add(a)
    for i, _ in reps:
        if near[i] & set(kept):
            gone.add(i)
        else:
            kept.append(i)
    pairs = spark.createDataFrame(sorted(want), "a int, b int")
    assert {x.id for x in dedup.greedy_keep_first(pairs).collect()} == gone


def test_cosine_recall_is_exact(spark):
    r = random.Random(2)
    v = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(90)] + [(90, None), (91, [0.0] * 4)]
    df = spark.createDataFrame(v, "id int, v array<float>")

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)

    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if cos(v[i][1], v[j][1]) >= 0.9}
    assert {(x.a, x.b) for x in dedup.cosine_pairs(df, "id", "v", 0.9, block=16).collect()} == want
    got = {(x.a, x.b) for x in dedup.cosine_pairs(df, "id", "v", 0.9, F.col("id") % 20 == 0, block=16).collect()}
    assert got == {(i, j) for i in range(0, 90, 20) for j in range(90) if i != j and cos(v[i][1], v[j][1]) >= 0.9}


def test_simhash_and_lines(spark):
    d = spark.createDataFrame([(1, "the same text for both"), (2, "the same text for both"), (3, "something else entirely, and longer"), (4, None)], "pos int, t string")
    assert [x.id for x in dedup.simhash_dedup(d, "pos", "t", 3).collect()] == [2]
    p = spark.createDataFrame([(i, f"footer line\nown {i}") for i in range(4)], "id int, t string")
    assert [x.text for x in dedup.drop_frequent_lines(p, "id", "t").orderBy("id").collect()] == [f"own {i}" for i in range(4)]


def test_extraction(spark):
    d = spark.createDataFrame([(1, "Alan Turing worked at Bletchley Park. He was born in Maida Vale, and he wrote letters. Mail a.b@c.org or see https://x.org now.")], "id int, t string")
    assert {(x.name, x.label) for x in extract.regex_entities(d, "id", "t").collect()} == {("Alan Turing", "NAMED_ENTITY"), ("Bletchley Park", "NAMED_ENTITY"), ("Maida Vale", "NAMED_ENTITY"), ("a.b@c.org", "CONTACT"), ("https://x.org", "URL")}
    facts = {(x.subject, x.predicate, x.object) for x in extract.extract_facts(d, "id", "t").collect()}
    assert ("Alan Turing", "worked_at", "Bletchley Park") in facts and ("Alan Turing", "born_in", "Maida Vale") in facts
    tags = spark.createDataFrame([(1, i, w, t) for i, (w, t) in enumerate([("Viet", "B-ORG"), ("Nam", "I-ORG"), ("and", "O"), ("Lan", "I-PER"), ("Mai", "B-PER")])], "id int, i int, w string, t string")
    assert {(x.start, x.label, x.text) for x in extract.bio_spans(tags, "id", "i", "w", "t").collect()} == {(0, "ORG", "Viet Nam"), (3, "PER", "Lan"), (4, "PER", "Mai")}
    c = spark.createDataFrame([("k", "Ann works for Acme. Acme is in Hue.")], "c string, t string")
    e = spark.createDataFrame([("k", "e1", "Ann", "PERSON"), ("k", "e2", "Acme", "ORG"), ("k", "e3", "Hue", "GPE")], "c string, id string, name string, label string")
    assert {(x.subject, x.predicate, x.object, x.evidence) for x in extract.rule_relations(c, e, "c", "t").collect()} == {("e1", "works_at", "e2", "Ann works for Acme."), ("e2", "located_in", "e3", "Acme is in Hue.")}
    reply = '("entity"<|>"Ann"<|>"person"<|>"a")##("entity"<|>"Acme"<|>"org"<|>"b")##("relationship"<|>"ann"<|>"ACME"<|>"works")##("relationship"<|>"ann"<|>"x"<|>"y")<|COMPLETE|>'
    ent, rel = extract.delimited_records(spark.createDataFrame([(1, reply)], "k int, r string"), "k", "r")
    assert ent.count() == 2 and [(x.subject, x.object) for x in rel.collect()] == [("Ann", "Acme")]
    out = extract.with_model(spark.createDataFrame([("p",)], "prompt string"), "prompt", lambda ps: [p.upper() for p in ps]).first()
    assert out.response == "P" and out.error is None


def test_resolution(spark):
    e = spark.createDataFrame([(0, "Acme Corp Ltd", "ORG"), (1, "Acme Ltd Corp", "ORG"), (2, "Acme Corp", "ORG"), (3, "Acme Corp Ltd", "PER"), (4, None, None), (5, "acme corp ltd ", "ORG")], "pos bigint, name string, type string")
    assert {x.pos: x.canonical_pos for x in resolve.resolve_strings(e, 0.6).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 0}
    assert spark.range(1).select(resolve.surface_compatible(F.lit("World Health Org"), F.lit("W.H.O.")), resolve.surface_compatible(F.lit("Ann"), F.lit("Bob"))).first()[:] == (True, False)


def test_graph_jobs(spark):
    nodes = spark.createDataFrame([(c, c, "X") for c in "abcde"], "id string, name string, type string")
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("a", "d", 2)], "subject string, object string, weight int")
    pr = {x.id: x.rank for x in graph.pagerank(nodes, edges, tolerance=1e-9).collect()}
    assert abs(sum(pr.values()) - 1) < 1e-4 and pr["d"] > pr["b"] > pr["e"]
    assert {x.id: x.component for x in graph.weak_components(nodes, edges).collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e"}
    hop = {(x.id, x.depth) for x in graph.reachable(nodes, edges, nodes.where("id = 'a'"), 3).collect()}
    assert hop == {("b", 1), ("d", 1), ("c", 2), ("a", 3)}
    o = metrics.orphan_audit(nodes, edges).first()
    assert (o.orphan_count, o.flag) == (1, "yellow")


def test_answers_and_samples(spark):
    r = spark.range(1).select(metrics.token_f1(F.lit("a b"), F.lit("B a")), metrics.token_f1(F.lit("a b"), F.lit("a c")), metrics.hallucinated(F.lit("q"), F.lit("a"), F.lit("q a x y"))).first()
    assert r[:] == (1.0, 0.5, True)
    e = spark.createDataFrame([(f"e{i}", f"n{i}", f"n{i + 1}", "some words here", float(i % 3)) for i in range(8)], "id string, source string, target string, description string, loss double")
    k = datasets.khop_subgraphs(e, seeds=2, max_depth=2, max_extra=3, max_tokens=9).toPandas()
    assert k[k.status == "included"].groupby("seed").tokens.max().max() <= 9 and set(k.status) <= {"included", "token_budget", "depth_limit"}
    split = spark.range(1000).select(datasets.hash_split(F.col("id").cast("string"), 0.2).alias("s")).groupBy("s").count().collect()
    assert abs({x.s: x["count"] for x in split}["test"] - 200) < 50


def test_every_triple_with_a_free_node_has_a_false_statement(spark):
    nodes = [(f"n{i}", "X") for i in range(12)] + [("y0", "Y"), ("y1", "Y"), ("z", None)]
    known = [("n0", "p", f"n{i}") for i in range(1, 10)] + [("y0", "q", "y1"), ("n1", "p", "z"), ("n2", "r", "gone")]
    t = spark.createDataFrame([(i, *x) for i, x in enumerate(known)], "pos int, subject string, predicate string, object string")
    kind = dict(nodes)
    got = datasets.true_false(t, spark.createDataFrame(nodes, "id string, type string"), t).collect()
    assert sorted(x.pos for x in got if x.truth) == list(range(12))
    false = {x.pos: x.object for x in got if not x.truth}
    assert len(false) == sum(not x.truth for x in got) == 12
    for i, o in false.items():
        s, p, real = known[i]
        assert o in kind and o not in (s, real) and (s, p, o) not in known
        assert i > 8 or o in ("n10", "n11")
    assert kind[false[9]] != "Y"
    full = spark.createDataFrame([(0, "a", "p", "b")], "pos int, subject string, predicate string, object string")
    assert datasets.true_false(full, spark.createDataFrame([("a", "X"), ("b", "X")], "id string, type string"), full).count() == 1


def test_balance_skips_what_does_not_fit(spark, monkeypatch):
    r = random.Random(5)
    for case, most in ((0, 60), (1, 400), (2, 5), (3, 60)):
        sizes = [r.choice((1, 2, 3, 7, 20, most * 4)) for _ in range(150)]
        sizes[1 - case % 2] = most * 5  # too large: the first row stays alone, a later one is skipped
        budget = [300, 900, 3, 150][case]
        want, used = [], 0
        for i, n in enumerate(sizes):
            if want and used + n > budget:
                continue
            want.append(i)
            used += n
            if used >= budget:
                break
        df = spark.createDataFrame(list(enumerate(sizes)), "i int, n int")
        for fold in (100_000, 10):
            monkeypatch.setattr(chunking, "FOLD", fold)
            assert sorted(x.i for x in chunking.running_balance(df, "i", "n", budget).collect()) == want


def test_khop_decides_every_edge_beside_a_hub(spark):
    rows = [("e0", "a", "hub", "w", 9.0)] + [(f"f{i:03d}", "hub", f"x{i}", "w " * 20, 8.0) for i in range(350)] + [(f"g{i}", "hub", f"y{i}", "w", 1.0) for i in range(4)]
    e = spark.createDataFrame(rows, "id string, source string, target string, description string, loss double")
    k = datasets.khop_subgraphs(e, seeds=1, max_depth=2, max_extra=2, max_tokens=9).toPandas().sort_values("step")
    assert k.edge[k.status == "included"].tolist() == ["e0", "g0", "g1"] and k.edge[k.status == "edge_limit"].tolist() == ["g2", "g3"]
    assert (k.status == "token_budget").sum() == 350 and k.step.tolist() == list(range(355))
