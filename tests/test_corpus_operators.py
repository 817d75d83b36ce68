import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import assembly, datasets, dedup, extract, graph, metrics, resolve
from millrace.sinks import manifests
from millrace.sources import files, graphs
from millrace.streaming import incremental


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_chunks_documents_and_mentions(spark):
    c = spark.createDataFrame([(1, "Ann sat. Bob ran.", "s.txt", "d1", {"parent_source": "a/s.txt", "parent_doc_id": "d", "chunk_index": "0", "title": "T"}), (2, "Bob left.", "s.txt", "d2", {"parent_source": "a/s.txt", "parent_doc_id": "d", "chunk_index": "1"}), (3, None, "x", "y", None), (4, "alone", None, None, None)], "pos bigint, content string, source string, doc_id string, metadata map<string,string>")
    at = assembly.located(c)
    assert {(r.name, r.token_count, r.provenance.get("title")) for r in assembly.chunk_nodes(at).collect()} == {("s.txt chunk 0", 4, "T"), ("s.txt chunk 1", 2, None), ("unknown chunk 0", 1, None)}
    assert {(r.name, r.chunk_count) for r in assembly.document_nodes(at).collect()} == {("T", 2), ("unknown", 1)}
    ids = {r.content: (r.chunk_id, r.parent_id) for r in at.collect()}
    first, second = ids["Ann sat. Bob ran."], ids["Bob left."]
    st = {(r.subject, r.predicate, r.object) for r in assembly.structural_triples(at).collect()}
    assert (first[0], "NEXT", second[0]) in st and (second[0], "PART_OF", first[1]) in st and len(st) == 4
    e = spark.createDataFrame([(first[0], "e1", "bob"), (first[0], "e1", "bob"), (second[0], "e2", "Ann")], "chunk_id string, id string, name string")
    assert {(r.object, r.evidence_sentence) for r in assembly.mention_triples(at, e).collect()} == {("e1", "Bob ran."), ("e2", "")}
    assert assembly.chunk_nodes(assembly.located(c.limit(0))).count() == 0


def test_rewritten_ends_and_upserts(spark):
    t = spark.createDataFrame([("a", "p", "b", None, "c"), ("x", "p", None, "e", None)], "subject string, predicate string, object string, evidence_sentence string, source_chunk_id string")
    m = spark.createDataFrame([("a", "A"), ("a", "B"), (None, "Z")], "id string, canonical string")
    assert {(r.subject, r.object, r.evidence_sentence, r.source_chunk_id) for r in assembly.rewrite_ends(t, m).collect()} == {("A", "b", "", "c"), ("x", None, "e", "")}
    kind = "subject string, object string, predicates array<string>, source_texts array<string>, source_chunk_ids array<string>, description string, weight int"
    old, new = spark.createDataFrame([("a", "b", ["p"], [], ["c1"], "d", 1)], kind), spark.createDataFrame([("a", "b", ["q", "p"], ["t"], ["c2"], "", 2), ("n", "m", None, None, None, None, 1)], kind)
    got = {r.subject: (r.predicates, r.source_chunk_ids, r.description, r.weight) for r in assembly.upsert_edges(old, new).collect()}
    assert got == {"a": (["p", "q"], ["c1", "c2"], "d", 3), "n": ([], [], "", 1)}


def test_dedup_methods(spark):
    base = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([(2, base, [1.0, 0.0]), (10, base + " tail", [0.0, 1.0]), (3, "another text altogether", [0.99, 0.01]), (4, base, [0.5, 0.5]), (5, None, None)], "pos bigint, content string, v array<double>")
    kept = lambda m, **k: {r.pos for r in dedup.deduplicate(d.where("content is not null"), m, **k).collect()}
    assert kept("none") == {2, 3, 4, 10} and kept("exact") == {2, 3, 10}
    assert kept("minhash") == {3, 10}  # the survivor is the smallest position as a string
    assert kept("ngram") == {2, 3} and 3 in kept("simhash")
    assert kept("semantic", vector="v") == {10, 2, 4} and kept("layered", vector="v") == {3, 10}
    for bad in ({"method": "best"}, {"method": "semantic"}, {"method": "exact", "threshold": 2.0}):
        with pytest.raises(ValueError):
            dedup.deduplicate(d, **bad)


def test_assignments_name_canonical_and_evidence(spark):
    r = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9), ("z", None)], "record_id string, quality double")
    m = spark.createDataFrame([("a", "b", 1.0, "exact"), ("b", "c", 0.8, "minhash"), ("b", "b", 1.0, "exact")], "a string, b string, similarity double, method string")
    got = {x.record_id: (x.cluster_id, x.canonical_id, x.is_duplicate, x.similarity, x.matched_record_id) for x in dedup.assign_clusters(r, m).collect()}
    assert got == {"a": ("dup-a", "c", True, 1.0, "b"), "b": ("dup-a", "c", True, 1.0, "a"), "c": ("dup-a", "c", False, 0.8, "b"), "z": (None, "z", False, None, None)}


def test_review_flags_and_embedding_batches(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.99, 0.01]), (3, [0.0, 1.0])], "id bigint, v array<double>")
    matches, flags = dedup.semantic_review(v, "id", "v", 0.95)
    assert {(r.record_id, r.matched_record_id) for r in matches.collect()} == {(1, 2)} and {(r.record_id, r.matched_record_id) for r in flags.collect()} == {(1, 2), (2, 1)}

    def encode(texts):
        if len(texts) > 1:
            raise RuntimeError("out of memory")
        return [[float(len(texts[0]))]]

    d = spark.createDataFrame([("a", "xx", 1), ("b", "yyy", 2), ("c", None, 3)], "record_id string, text string, tokens int")
    got = dedup.embed(d, "record_id", "text", "tokens", encode)
    assert {(r.record_id, r.embedding[0]) for r in got.collect()} == {("a", 2.0), ("b", 3.0)}
    known = spark.createDataFrame([("a", d.select(F.sha2("text", 256)).first()[0], [9.0])], "record_id string, content_hash string, embedding array<float>")
    assert {(r.record_id, r.embedding[0]) for r in dedup.embed(d, "record_id", "text", "tokens", encode, known=known).collect()} == {("a", 9.0), ("b", 3.0)}


def test_paths_match_a_depth_first_walk(spark):
    r = random.Random(2)
    edges = {(f"n{r.randrange(9)}", f"n{r.randrange(9)}") for _ in range(40)}
    succ = {}
    for a, b in sorted(edges):
        succ.setdefault(a, []).append(b)
    want = []
    for start in sorted({a for a, _ in edges}):
        found = []

        def walk(path):
            for b in succ.get(path[-1], []):
                if b not in path and len(found) < 7:
                    found.append((*path, b))
                    if len(path) < 3:
                        walk([*path, b])

        walk([start])
        want += found
    e = spark.createDataFrame([(a, b, ["p"], ["c"]) for a, b in edges], "subject string, object string, predicates array<string>, source_chunk_ids array<string>")
    got = datasets.simple_paths(e, spark.createDataFrame([(f"n{i}",) for i in range(9)], "id string"), 3, 7)
    assert {tuple(x.nodes) for x in got.collect()} == set(want)


def test_raw_questions_match_the_rules_in_python(spark):
    texts = ["Ann Lee was born in Rome, they say. She is a famous painter of Rome. The mill stood near Rome and Paris and Oslo today. Short one."]
    want = {}
    for s in (x.strip() for x in re.split(r"(?<=[.!?])\s+", texts[0])):
        n = [x for x in re.findall(r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b", s) if x.lower() not in datasets.RAW_PRONOUNS]
        if len(s) < 20:
            continue
        if re.match(r"(.+?)\s+(is|was|are|were)\s+(a|an|the)?\s*(.+)", s, re.I) and n:
            want["definition"] = want.get("definition", 0) + 1
        pairs = sum(a != b for i, a in enumerate(n[:3]) for b in n[i + 1 :][:3])
        if pairs:
            want["relationship"] = want.get("relationship", 0) + pairs
        for rx, _ in datasets.RAW_FACTS:
            if (m := re.search(rx, s, re.I)) and m.group(1).strip().lower() not in datasets.RAW_PRONOUNS:
                want["factual"] = want.get("factual", 0) + 1
        if n:
            want["source_grounded"] = want.get("source_grounded", 0) + 1
    d = spark.createDataFrame([(1, texts[0]), (2, None), (3, "")], "id bigint, text string")
    out = datasets.raw_questions(d, "id", "text")
    assert {r.type: r["count"] for r in out.groupBy("type").count().collect()} == want
    assert ("Where was Ann Lee born?", "Rome") in {(r.question, r.answer) for r in out.collect()}


def test_question_rules_and_sides(spark):
    e = spark.createDataFrame([("g", "1", "a", "b"), ("g", "2", "b", "c"), ("g", "3", "x", "y")], "subgraph string, id string, source string, target string")
    a = spark.createDataFrame([("ok", "g", "q", "a", ["1", "2"]), ("blank", "g", " ", "a", ["1", "2"]), ("none", "g", "q", "a", None), ("one", "g", "q", "a", ["1", "1"]), ("far", "g", "q", "a", ["1", "3"]), ("new", "g", "q", "a", ["1", "9"])], "id string, subgraph string, question string, answer string, used array<string>")
    assert dict(rows(datasets.validate_questions(a, e))) == {"ok": None, "blank": "missing_question_or_answer", "none": "used_edge_ids_must_be_a_list", "one": "question_does_not_use_two_edges", "far": "used_edges_do_not_form_an_ordered_path", "new": "unknown_used_edge_id"}
    g = spark.createDataFrame([(f"g{i}",) for i in range(4)], "g string")
    for share in (0.0, 1.0):
        assert {s for _, s in rows(datasets.grouped_sides(g, "g", share))} == {"train", "test"}
    assert rows(datasets.grouped_sides(g.limit(1), "g", 1.0)) == {("g0", "train")}


def test_injected_extraction(spark):
    answers = ["first", "YES", "more", "NO"]
    assert extract.glean(lambda m, said: answers[len(said)], "p", "again", "more?", rounds=5) == ("first\nmore", 4)
    tries = iter(["", "ok", "NO"])
    assert extract.glean(lambda m, said: next(tries), "p", "again", "more?", rounds=1) == ("ok", 3)
    c = spark.createDataFrame([("c1", "x"), ("c2", None)], "id string, prompt string")

    def call(message, said):
        if message is None:
            raise ValueError("no prompt")
        return "a" if not said else "no"

    assert {(r.id, r.response, r.calls, r.error) for r in extract.gleaned(c, "id", "prompt", call, "again", "more?").collect()} == {("c1", "a", 2, None), ("c2", None, 0, "no prompt")}
    t = extract.tagged_entities(c.select("id", F.lit("Ann met ann and the old mill").alias("t")), "id", "t", lambda ts: [[("Ann", "PERSON"), ("ann", "ORG")] for _ in ts], lambda ts: [["the old mill", "it", "ANN"] for _ in ts])
    assert {(r.i, r.name, r.label, r.confidence) for r in t.where("id = 'c1'").collect()} == {(0, "Ann", "PERSON", 0.9), (1, "the old mill", "CONCEPT", 0.7)}
    r = spark.createDataFrame([("c1", 'so: {"relations": [{"subject": "ANN", "predicate": "Works At", "object": "mill"}, {"subject": "ann", "predicate": "p", "object": "nobody"}]}', "Ann runs the mill."), ("c2", "nonsense", "t")], "chunk_id string, response string, text string")
    e = spark.createDataFrame([("c1", "e1", "Ann"), ("c1", "e2", "Mill")], "chunk_id string, id string, name string")
    assert rows(extract.llm_relations(r, e)) == {("c1", "e1", "works_at", "e2", "Ann runs the mill.")}


def test_embedding_resolution_is_greedy_by_seeds(spark):
    r = random.Random(5)
    es = []
    for i in range(60):
        a = r.random()
        es.append((i, f"{r.choice(['north', 'south'])} {r.choice(['mill', 'bank', 'lake'])}", r.choice(["ORG", None]), [a, 1 - a]))
    es += [(60, None, "ORG", [1.0, 0.0]), (61, "north mill", "ORG", None)]
    df = spark.createDataFrame(es, "pos bigint, name string, type string, embedding array<double>")
    got = dict(rows(resolve.resolve_embeddings(df, 0.97)))
    taken, want = set(), {}
    cos = lambda u, v: (u[0] * v[0] + u[1] * v[1]) / ((u[0] ** 2 + u[1] ** 2) * (v[0] ** 2 + v[1] ** 2)) ** 0.5
    ok = [e for e in es if e[1] and e[3]]
    for e in ok:
        if e[0] in taken:
            continue
        want[e[0]] = e[0]
        for o in ok:
            if o[0] > e[0] and o[0] not in taken and (o[2] or "") == (e[2] or "") and set(o[1].split()) & set(e[1].split()) and cos(o[3], e[3]) >= 0.97:
                taken.add(o[0])
                want[o[0]] = e[0]
    assert got == want | {60: 60, 61: 61}


def test_nameless_entities_never_merge_and_ties_are_settled(spark):
    e = spark.createDataFrame([(1, None, "A"), (2, "", "A"), (3, "x", "A"), (4, "X", "A")], "pos bigint, name string, type string")
    assert dict(rows(resolve.resolve_strings(e))) == {1: 1, 2: 2, 3: 3, 4: 3}
    stored = spark.createDataFrame([("b", "x y", "A"), ("a", "y x", "A")], "id string, name string, type string")
    assert resolve.match_stored(spark.createDataFrame([(1, "X Y", "A")], "pos bigint, name string, type string"), stored).first()["stored_id"] == "a"


def test_small_text_helpers(spark):
    d = spark.createDataFrame([("One two. Three…  Four", [1, 2], [7, 8], "https://www.a.gov.example/x"), (None, [1], [2], None), ("", [1], None, "x")], "t string, p array<int>, a array<int>, u string")
    got = d.select(T.sentence_spans(F.col("t")).alias("s"), T.label_mask(F.col("p"), F.col("a"), 3).alias("m"), T.routed(F.col("u"), {"gov.example": F.lit("g")}, F.lit("d")).alias("r")).collect()
    assert [(x.start, x.end) for x in got[0].s] == [(0, 8), (9, 15), (17, 21)] and got[1].s is None and got[2].s == []
    assert got[0].m == [-100, -100, 7] and got[2].m is None and [x.r for x in got] == ["g", "d", "d"]
    assert T.clean_batch(d, "t", "vi").count() == 1


def test_folders_of_any_file_system(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_text("hello")
    (tmp_path / "in" / "deep" / "b.json").write_text('[{"text": "x", "id": "1"}, {"content": "y"}]')
    (tmp_path / "in" / "c.jsonl").write_text('{"text": "z", "url": "u"}\n{broken\n')
    for folder in (str(tmp_path / "in"), f"file:{tmp_path}/in"):
        assert {r.content for r in files.load(spark, [folder], ("txt", "json")).collect()} == {"hello", "x", "y"}
        assert {r.text for r in graphs.raw_documents(spark, [folder]).collect()} == {"hello", "x", "y", "z"}
    assert [r.doc_id for r in files.read_json(spark, f"file:{tmp_path}/in/deep").orderBy("content").collect()][0] == "1"


def test_stream_versions_on_a_uri(spark, tmp_path):
    from millrace.schemas import TRIPLES

    path = f"file:{tmp_path}/store"
    one = spark.createDataFrame([(1, "a", "p", "b", "e", "d1#0", "", 1.0)], TRIPLES)
    two = spark.createDataFrame([(2, "c", "p", "d", "e", "d2#0", "", 1.0)], TRIPLES)
    for v, batch in enumerate((one, two)):
        incremental.merge_batch(incremental.stored(spark, path, v - 1), batch).write.mode("overwrite").parquet(f"{path}/v={v}")
    assert incremental.current_edges(spark, path).count() == 2


def test_manifest_and_results(spark, tmp_path):
    folder = f"{tmp_path}/set"
    spark.range(3).coalesce(1).write.json(folder)
    body = manifests.dataset_manifest(spark, folder, {"rows": 3}, {"b": 1, "a": [2]})
    assert len(body["files"]) == 1 and body["config_hash"] == manifests.config_hash({"a": [2], "b": 1})
    assert "| x |" in manifests.write_metrics(spark.createDataFrame([(1,)], "x int"), f"{tmp_path}/m") and (tmp_path / "m.json").exists()
    manifests.scrape_outputs(spark.range(1), spark.range(2), f"{tmp_path}/scrape", {"pages": 1})
    assert (tmp_path / "scrape" / "manifest.yaml").read_text() == "pages: 1\n"


def test_observed_counts_and_ranks(spark):
    df, seen = metrics.counted("read", spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7
    s = spark.createDataFrame([("a", "accuracy", 0.5), ("b", "accuracy", 0.7), ("a", "hallucination_rate", 0.1), ("b", "hallucination_rate", 0.2)], "model string, metric string, value double")
    assert {(r.metric, r.model) for r in metrics.rank_models(s).where("place = 1").collect()} == {("accuracy", "b"), ("hallucination_rate", "a")}
    e = spark.createDataFrame([("a", "b")], "subject string, object string")
    n = spark.createDataFrame([("a", "x", "DATE"), ("b", "x y", "ORG")], "id string, name string, type string")
    r = metrics.database_audit(n, e.withColumn("predicate", F.lit("p"))).first()
    assert (r.violations, r.compliance_rate, r.reachable_2hop) == (1, 0.0, 1.0)


def test_furniture_starts(spark):
    d = spark.createDataFrame([(i, "Bộ Tài chính\nline %d" % i if i < 2 else "other %d" % i) for i in range(20)], "id bigint, text string")
    got = dict(dedup.drop_frequent_lines(d, "id", "text", 0.5).select("id", "text").collect())
    assert got[0] == "line 0" and got[5] == "other 5"


def test_cosine_pairs_over_blocks_match_brute_force(spark):
    r = random.Random(1)
    v = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(50)]
    df = spark.createDataFrame(v, "id bigint, v array<double>")
    got = {(x.a, x.b) for x in dedup.cosine_pairs(df, "id", "v", 0.8, block=9).collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    assert got == {(a, b) for (a, x), (b, y) in itertools.combinations(v, 2) if cos(x, y) >= 0.8}
    assert graph.SYMMETRIC
