"""Question-answer, path and subgraph datasets out of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import regex_token_count, strip
from millrace.operators.graph import STRUCTURAL
from millrace.session import cut


def single_hop(triples: DataFrame, names: DataFrame) -> DataFrame:
    """(pos, k, question, answer): three questions a domain triple, with names for ids.

    triples(pos, subject, predicate, object); names(id, name). Triples without an object or a known end are left out.
    """
    t = triples.where(~F.upper("predicate").isin(*STRUCTURAL)).join(names.select(F.col("id").alias("subject"), F.col("name").alias("s")), "subject").join(names.select(F.col("id").alias("object"), F.col("name").alias("o")), "object")
    rel = F.translate("predicate", "_", " ")
    forms = F.array(
        F.struct(F.concat(F.lit("What does "), "s", F.lit(" "), rel, F.lit("?")).alias("question"), F.col("o").alias("answer")),
        F.struct(F.concat(F.lit("Who or what "), rel, F.lit(" "), "o", F.lit("?")).alias("question"), F.col("s").alias("answer")),
        F.struct(F.concat(F.lit("How are "), "s", F.lit(" and "), "o", F.lit(" related?")).alias("question"), F.concat("s", F.lit(" "), rel, F.lit(" "), "o").alias("answer")),
    )
    return t.select("pos", F.posexplode(forms).alias("k", "q")).select("pos", "k", "q.*")


def _ranked(nodes: DataFrame) -> DataFrame:
    """(id, ring, rank, size): the place of every node among those of its ring, in hash order; ranks count over two levels."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = nodes.select("id", "ring").distinct().withColumn("h", F.xxhash64("id"))
    n = cut(n.repartitionByRange(parts, "ring", "h", "id").withColumn("p", F.spark_partition_id()))
    of_ring = Window.partitionBy("ring")
    base = n.groupBy("ring", "p").agg(F.count("*").alias("c"))
    base = base.select("ring", "p", F.coalesce(F.sum("c").over(of_ring.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("c").over(of_ring).alias("size"))
    n = n.withColumn("r", F.row_number().over(Window.partitionBy("ring", "p").orderBy("h", "id")))
    return cut(n.join(base, ["ring", "p"]).select("id", "ring", (F.col("r") + F.col("before")).alias("rank"), "size"))


def _next_free(triples: DataFrame, ring: DataFrame, known: DataFrame) -> DataFrame:
    """(pos, object): the first node after the object, around its ring, that isn't the subject or a known object.

    triples has the column ring; an object that isn't in the ring starts before its first node.
    Taken ranks of a subject, predicate and ring are runs without gaps: what follows a run is free.
    """
    pair = ["subject", "predicate"]
    triples, known = (d.withColumns({c: F.coalesce(c, F.lit("\0")) for c in pair}) for d in (triples, known))
    sizes = ring.select("ring", "size").distinct()
    t = triples.join(sizes, "ring").join(ring.select("ring", F.col("id").alias("object"), "rank"), ["ring", "object"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    asked = t.select(*pair, "ring").distinct()
    taken = known.select(*pair, "object").union(t.select(*pair, "object")).union(t.select(*pair, F.col("subject").alias("object"))).distinct()
    taken = taken.join(asked, pair).join(ring.select("ring", F.col("id").alias("object"), "rank", "size"), ["ring", "object"]).select(*pair, "ring", "rank", "size")
    taken = taken.union(t.where("rank = 0").select(*pair, "ring", "rank", "size")).distinct()
    group = Window.partitionBy(*pair, "ring")
    runs = taken.withColumn("run", F.col("rank") - F.row_number().over(group.orderBy("rank")))
    runs = runs.withColumn("end", F.max("rank").over(Window.partitionBy(*pair, "ring", "run")))
    # a run that reaches the ring's last node goes on with what follows the run of its first node
    runs = runs.withColumn("first", F.max(F.when(F.col("rank") == 1, F.col("end"))).over(group))
    after = F.when(F.col("end") < F.col("size"), F.col("end") + 1).when(F.col("first").isNull(), 1).when(F.col("first") < F.col("size"), F.col("first") + 1)
    free = runs.select(*pair, "ring", "rank", after.alias("after")).where("after is not null")
    found = t.join(free, [*pair, "ring", "rank"]).join(ring.select("ring", F.col("rank").alias("after"), F.col("id").alias("next"), "size"), ["ring", "after"])
    return found.groupBy("pos").agg(F.min("next").alias("object"))


def true_false(triples: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
    """(pos, object, truth): each triple, and the same with an object of the same type that makes no known triple.

    The false object is the next node of the type in hash order after the true one that isn't the
    subject or a known object, however far it is; where the type has none, or the object no type, the
    next of all nodes. Only a triple that every node would make true has no false statement.
    """
    n = nodes.select("id", "type").where("id is not null").distinct()
    t = triples.select("pos", "subject", "predicate", "object").where("object is not null")
    known = known.where("object is not null").select("subject", "predicate", "object").distinct()
    typed = t.join(n.where("type is not null").select(F.col("id").alias("object"), F.col("type").alias("ring")), "object")
    near = cut(_next_free(typed, _ranked(n.where("type is not null").withColumnRenamed("type", "ring")), known))
    rest = cut(t.join(near, "pos", "left_anti").withColumn("ring", F.lit("")))
    false = near if rest.isEmpty() else near.union(_next_free(rest, _ranked(n.withColumn("ring", F.lit(""))), known))
    return t.select("pos", "object", F.lit(True).alias("truth")).union(false.select("pos", "object", F.lit(False)))


def two_hop_paths(edges: DataFrame, starts: DataFrame, per_start: int = 20) -> DataFrame:
    """(a, b, c): simple directed paths of two edges from given starts, at most per_start each (a documented sampler), in order of ids."""
    e = edges.select(F.col("subject").alias("s"), F.col("object").alias("o")).distinct().where("s <> o")
    first = e.join(starts.select(F.col("id").alias("s")).distinct(), "s").select(F.col("s").alias("a"), F.col("o").alias("b"))
    two = first.join(e, F.col("b") == F.col("s")).select("a", "b", F.col("o").alias("c")).where("a <> c")
    w = Window.partitionBy("a").orderBy("b", "c")
    return two.withColumn("r", F.row_number().over(w)).where(f"r <= {per_start}").drop("r")


def comparison_pairs(nodes: DataFrame, edges: DataFrame, per_type: int = 10) -> DataFrame:
    """(type, a, b, shared): pairs among the first nodes of each type that share neighbours, with up to five of them."""
    w = Window.partitionBy("type").orderBy("id")
    top = nodes.where("type is not null").select("id", "type").distinct().withColumn("r", F.row_number().over(w)).where(f"r <= {per_type}").drop("r")
    ends = edges.select(F.col("subject").alias("id"), F.col("object").alias("n")).union(edges.select("object", "subject")).distinct().join(top, "id")
    a, b = ends.select("type", "n", F.col("id").alias("a")), ends.select("type", "n", F.col("id").alias("b"))
    both = a.join(b, ["type", "n"]).where("a < b").groupBy("type", "a", "b").agg(F.sort_array(F.collect_set("n")).alias("n"))
    return both.select("type", "a", "b", F.slice("n", 1, 5).alias("shared"))


def hash_split(group: Column, share: float, seed: int = 42) -> Column:
    """"test" for about `share` of the groups, by the first eight bytes of a SHA-256, else "train"."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), group), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return F.when(h < share, "test").otherwise("train")


def edge_rank(mode: str = "max_loss", seed: int = 42) -> list[Column]:
    """Order of edges: by loss, nulls last, then id; or by a seeded hash."""
    if mode == "random":
        return [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id")), 256)]
    return [F.col("loss").desc_nulls_last() if mode == "max_loss" else F.col("loss").asc_nulls_last(), F.col("id")]


def knowledge_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Descriptive edges between known nodes, one per (source, target, description)."""
    ids = nodes.select("id").distinct()
    e = edges.where("description is not null and description <> ''").select(F.col("subject").alias("source"), F.col("object").alias("target"), "description", "source_chunk_ids")
    e = e.join(ids.select(F.col("id").alias("source")), "source", "left_semi").join(ids.select(F.col("id").alias("target")), "target", "left_semi")
    key = F.substring(F.sha2(F.concat_ws("\x1f", "source", "target", "description"), 256), 1, 20)
    return e.groupBy("source", "target", "description").agg(F.first("source_chunk_ids").alias("source_chunk_ids")).withColumn("id", F.concat(F.lit("edge:"), key))


def khop_subgraphs(edges: DataFrame, seeds: int = 100, max_depth: int = 2, max_extra: int = 5, max_tokens: int = 256, mode: str = "max_loss") -> DataFrame:
    """(seed, step, edge, status, depth, tokens): every decision of a bounded expansion around the best-ranked seed edges.

    All seeds advance together, one join a round: the best-ranked edge next to what a seed has that is
    near enough and whose text fits the budget is taken, the better-ranked ones that aren't are rejected
    for good, so there are at most max_extra + 1 rounds. What is undecided beside a seed that has max_extra
    edges is rejected as edge_limit. step counts a seed's decisions. edges(id, source, target, description,
    loss). seeds and the limits are the sampler's parameters.
    """
    e = edges.select("id", "source", "target", "loss", regex_token_count(F.col("description")).cast("int").alias("n"))
    top = e.orderBy(*edge_rank(mode)).limit(seeds)
    order = F.struct(F.when(F.col("loss").isNull(), F.lit(float("inf"))).otherwise((-1 if mode == "max_loss" else 1) * F.col("loss")).alias("l"), F.col("id").alias("i")) if mode != "random" else F.struct(F.sha2(F.concat(F.lit("42:"), F.col("id")), 256).alias("l"), F.col("id").alias("i"))
    e = cut(e.withColumn("order", order))
    touch = e.select(F.col("source").alias("node"), "id", "source", "target", "n", "order").union(e.select("target", "id", "source", "target", "n", "order")).distinct()
    done = cut(top.select(F.col("id").alias("seed"), F.lit(0).alias("step"), F.col("id").alias("edge"), F.when(F.col("n") <= max_tokens, "included").otherwise("seed_exceeds_token_budget").alias("status"), F.lit(0).alias("depth"), F.col("n").alias("tokens"), "source", "target"))
    while True:
        kept = done.where("status = 'included'")
        used = kept.groupBy("seed").agg(F.max("tokens").alias("used"), F.count("*").alias("k"))
        used = used.join(done.groupBy("seed").agg(F.max("step").alias("last")), "seed")
        inside = kept.select("seed", F.explode(F.array("source", "target")).alias("node"), "depth").groupBy("seed", "node").agg(F.min("depth").alias("depth"))
        cand = inside.join(used, "seed").join(touch, "node").groupBy("seed", "used", "k", "last", "id", "source", "target", "n", "order").agg((F.min("depth") + 1).alias("depth"))
        cand = cut(cand.join(done.select("seed", F.col("edge").alias("id")), ["seed", "id"], "left_anti"))
        open_ = cand.where(F.col("k") - 1 < max_extra)
        status = F.when(F.col("depth") > max_depth, "depth_limit").when(F.col("used") + F.col("n") > max_tokens, "token_budget").otherwise("included")
        open_ = open_.withColumn("status", status).withColumn("best", F.min(F.when(F.col("status") == "included", F.col("order"))).over(Window.partitionBy("seed"))).where("best is null or order <= best")
        step = (F.col("last") + F.row_number().over(Window.partitionBy("seed").orderBy("order"))).cast("int").alias("step")
        new = cut(open_.select("seed", step, F.col("id").alias("edge"), "status", "depth", F.when(F.col("status") == "included", F.col("used") + F.col("n")).otherwise(F.col("used")).alias("tokens"), "source", "target"))
        if new.isEmpty():
            step = (F.col("last") + F.row_number().over(Window.partitionBy("seed").orderBy("id"))).cast("int").alias("step")
            limit = cand.select("seed", step, F.col("id").alias("edge"), F.lit("edge_limit").alias("status"), F.lit(max_depth + 1).alias("depth"), F.col("used").alias("tokens"))
            return done.select("seed", "step", "edge", "status", "depth", "tokens").union(limit)
        done = cut(done.union(new))


def simple_paths(edges: DataFrame, starts: DataFrame, hops: int = 3, per_start: int = 20) -> DataFrame:
    """(start, nodes, predicates, chunks): the first per_start simple directed paths of 1 to `hops` edges from each of starts(id), depth first by ids.

    edges(subject, object, predicates, source_chunk_ids); structural predicates don't count, an edge of
    only such ones isn't walked, and the first other predicate names a step. The first paths of a start
    only use the first per_start paths of each length, and of each node its first per_start + hops
    successors, so no join sees more than that of a hub; nothing among the first paths is lost.
    """
    domain = F.filter("predicates", lambda p: ~F.upper(p).isin(*STRUCTURAL))
    none = F.array().cast("array<string>")
    e = edges.where("subject <> object").select(F.col("subject").alias("s"), F.col("object").alias("o"), F.get(domain, F.lit(0)).alias("p"), F.coalesce("source_chunk_ids", none).alias("c")).where("p is not null")
    e = e.withColumn("k", F.row_number().over(Window.partitionBy("s").orderBy("o"))).where(f"k <= {per_start + hops}").drop("k")
    first = Window.partitionBy("start").orderBy("nodes")
    front = starts.select(F.col("id").alias("start"), F.array("id").alias("nodes"), none.alias("predicates"), none.alias("chunks")).distinct()
    out = None
    for _ in range(hops):
        step = front.join(e, F.element_at("nodes", -1) == F.col("s")).where("not array_contains(nodes, o)")
        front = step.select("start", F.concat("nodes", F.array("o")).alias("nodes"), F.concat("predicates", F.array("p")).alias("predicates"), F.array_union("chunks", "c").alias("chunks"))
        front = cut(front.withColumn("r", F.row_number().over(first)).where(f"r <= {per_start}").drop("r"))
        out = front if out is None else out.union(front)
    return out.withColumn("r", F.row_number().over(first)).where(f"r <= {per_start}").drop("r")


def multi_hop(edges: DataFrame, names: DataFrame, starts: DataFrame, hops: int = 3, per_start: int = 20, share: float = 0.2, seed: int = 42) -> DataFrame:
    """(start, nodes, hops, question, answer, path, group_id): questions over simple paths of 2 to `hops` edges.

    A start has at most per_start paths, those of one edge counted, in depth-first order of ids (a
    sampler's parameter). Paths whose chunks fall on both sides of hash_split are dropped; the group is
    the first chunk, or the path where there is none.
    """
    p = simple_paths(edges, starts, hops, per_start).where("size(nodes) > 2")
    sides = F.array_distinct(F.transform("chunks", lambda c: hash_split(F.concat(F.lit("source:"), c), share, seed)))
    p = p.where(F.size(sides) < 2)
    long = p.select("start", "nodes", F.posexplode("nodes").alias("i", "id")).join(names.select("id", "name"), "id", "left").groupBy("start", "nodes").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("name", "id").alias("name")))), lambda x: x["name"]).alias("labels"))
    p = p.join(long, ["start", "nodes"])
    said = F.transform("predicates", lambda x: F.translate(x, "_", " "))
    steps = F.transform(F.sequence(F.lit(0), F.size("predicates") - 1), lambda i: F.concat_ws(" ", F.get("labels", i), F.translate(F.get("predicates", i), "_", " "), F.get("labels", i + 1)))
    question = F.concat(F.lit("Starting from "), F.get("labels", F.lit(0)), F.lit(" and following "), F.array_join(said, " → "), F.lit(", what is reached?"))
    group = F.coalesce(F.concat(F.lit("source:"), F.get(F.array_sort("chunks"), F.lit(0))), F.concat(F.lit("path:"), F.array_join("nodes", "|")))
    return p.select("start", F.array_join("nodes", "|").alias("nodes"), F.size("predicates").alias("hops"), question.alias("question"), F.element_at("labels", -1).alias("answer"), F.array_join(steps, " → ").alias("path"), group.alias("group_id"))


def sft_samples(triples: DataFrame, edges: DataFrame, starts: DataFrame, n: int = 100, shares: tuple[float, float, float] = (0.3, 0.4, 0.3), seed: int = 42) -> DataFrame:
    """(hops, sample): up to n samples of 1, 2 and 3 triples in the given shares, in seeded hash order; sample is `s|p|o` joined by `;`.

    One-edge samples come from triples(subject, predicate, object), longer ones from simple paths out of starts.
    """
    one = triples.where("object is not null").select(F.lit(1).alias("hops"), F.concat_ws("|", "subject", "predicate", "object").alias("sample")).distinct()
    p = simple_paths(edges, starts, 3).where("size(predicates) > 1")
    joined = F.array_join(F.transform(F.sequence(F.lit(0), F.size("predicates") - 1), lambda i: F.concat_ws("|", F.get("nodes", i), F.get("predicates", i), F.get("nodes", i + 1))), ";")
    all_ = one.union(p.select(F.size("predicates"), joined))
    first, second = int(n * shares[0]), int(n * shares[1])
    want = F.when(F.col("hops") == 1, first).when(F.col("hops") == 2, second).otherwise(n - first - second)
    w = Window.partitionBy("hops").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), "sample"), 256), "sample")
    return all_.withColumn("r", F.row_number().over(w)).where(F.col("r") <= want).select("hops", "sample")


def grouped_sides(items: DataFrame, group: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """(group, side): hash_split over groups, with at least one group on each side where there are two or more."""
    g = items.select(F.col(group).alias("g")).where("g is not null").distinct()
    g = g.select("g", F.sha2(F.concat(F.lit(f"{seed}:"), "g"), 256).alias("h"), hash_split(F.col("g"), share, seed).alias("side"))
    ends = g.agg(F.count("*").alias("n"), F.count(F.when(F.col("side") == "test", 1)).alias("t"), F.max_by("g", F.struct("h", "g")).alias("last"), F.min_by("g", F.struct("h", "g")).alias("first"))
    side = F.when((F.col("n") > 1) & (F.col("t") == 0) & (F.col("g") == F.col("last")), "test").when((F.col("n") > 1) & (F.col("t") == F.col("n")) & (F.col("g") == F.col("first")), "train").when(F.col("n") < 2, "train").otherwise(F.col("side"))
    return g.join(F.broadcast(ends)).select(F.col("g").alias(group), side.alias("side"))


def validate_questions(answers: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, reason): why a generated question isn't valid, null where it is.

    answers(id, subgraph, question, answer, used array<string>), edges(subgraph, id, source, target): a
    question needs text and answer, two distinct edges of its subgraph, and each edge must touch the next.
    """
    empty = F.array().cast("array<string>")
    a = answers.select("id", "subgraph", F.coalesce(F.trim("question"), F.lit("")).alias("q"), F.coalesce(F.trim("answer"), F.lit("")).alias("a"), F.col("used").isNull().alias("no_list"), F.coalesce("used", empty).alias("used"))
    e = edges.select("subgraph", F.col("id").alias("edge"), F.array("source", "target").alias("ends")).distinct()
    u = a.select("id", "subgraph", F.posexplode("used").alias("i", "edge")).join(e, ["subgraph", "edge"], "left")
    w = Window.partitionBy("id").orderBy("i")
    u = u.withColumn("before", F.lag("ends").over(w)).groupBy("id").agg(F.count(F.when(F.col("ends").isNull(), 1)).alias("unknown"), F.countDistinct("edge").alias("n"), F.count(F.when((F.col("i") > 0) & ~F.arrays_overlap("ends", "before"), 1)).alias("apart"))
    r = a.join(u, "id", "left").na.fill(0, ["unknown", "n", "apart"])
    reason = F.when((F.col("q") == "") | (F.col("a") == ""), "missing_question_or_answer").when(F.col("no_list"), "used_edge_ids_must_be_a_list").when(F.col("n") < 2, "question_does_not_use_two_edges").when(F.col("unknown") > 0, "unknown_used_edge_id").when(F.col("apart") > 0, "used_edges_do_not_form_an_ordered_path")
    return r.select("id", reason.alias("reason"))


# Facts a sentence may state, and the question that asks for the second part.
RAW_FACTS = (
    (r"(.+?)\s+(?:was\s+)?born\s+in\s+(.+?)(?:,|\.|$)", "Where was {0} born?"), (r"(.+?)\s+(?:worked|works)\s+(?:at|for|in)\s+(.+?)(?:,|\.|$)", "Where did {0} work?"),
    (r"(.+?)\s+(?:studied|studies)\s+(?:at|in)\s+(.+?)(?:,|\.|$)", "Where did {0} study?"), (r"(.+?)\s+(?:died|dies)\s+in\s+(.+?)(?:,|\.|$)", "Where did {0} die?"),
    (r"(.+?)\s+(?:discovered|invented|created|developed)\s+(.+?)(?:,|\.|$)", "What did {0} discover?"),
)
# Words that stand for a name.
RAW_PRONOUNS = ("he", "she", "his", "her", "they", "their", "it", "its", "this", "that")


def raw_questions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, i, type, question, answer): questions out of English sentences of 20 characters or more, without a graph.

    Per sentence: what the subject of "X is Y" is, how each of the first three names is related to up to
    three later ones, the facts of RAW_FACTS, and what a sentence of up to 600 characters states about its first name.
    """
    s = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.posexplode(F.transform(F.split(text, r"(?<=[.!?])\s+"), strip)).alias("i", "s")).where("length(s) >= 20")
    n = F.filter(F.regexp_extract_all("s", F.lit(r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b"), 1), lambda x: ~F.lower(x).isin(*RAW_PRONOUNS))
    s = s.withColumn("n", n)
    row = lambda kind, q, a: F.struct(F.lit(kind).alias("type"), q.alias("question"), a.alias("answer"))
    copula = r"(?i)^(.+?)\s+(is|was|are|were)\s+(a|an|the)?\s*(.+)"
    subject, rest = strip(F.regexp_extract("s", copula, 1)), F.regexp_replace(strip(F.regexp_extract("s", copula, 4)), r"\.+$", "")
    out = [F.when(F.col("s").rlike(copula) & (F.size("n") > 0), F.array(row("definition", F.concat(F.lit("What is "), subject, F.lit("?")), rest)))]
    pairs = F.flatten(F.transform(F.slice("n", 1, 3), lambda a, i: F.transform(F.filter(F.slice("n", i + 2, 3), lambda b: b != a), lambda b: row("relationship", F.concat(F.lit("How are "), a, F.lit(" and "), b, F.lit(" related?")), F.col("s")))))
    out.append(F.when(F.size("n") > 1, pairs))
    for rx, ask in RAW_FACTS:
        who, what = strip(F.regexp_extract("s", f"(?i){rx}", 1)), F.regexp_replace(strip(F.regexp_extract("s", f"(?i){rx}", 2)), r"\.+$", "")
        before, after = ask.split("{0}")
        out.append(F.when(F.col("s").rlike(f"(?i){rx}") & ~F.lower(who).isin(*RAW_PRONOUNS), F.array(row("factual", F.concat(F.lit(before), who, F.lit(after)), what))))
    out.append(F.when((F.size("n") > 0) & (F.length("s") <= 600), F.array(row("source_grounded", F.concat(F.lit("According to the source, what is stated about "), F.get("n", F.lit(0)), F.lit("?")), F.col("s")))))
    none = F.array().cast("array<struct<type:string,question:string,answer:string>>")
    return s.select("k", "i", F.explode(F.concat(*[F.coalesce(o, none) for o in out])).alias("q")).select(F.col("k").alias(key), "i", "q.*")
