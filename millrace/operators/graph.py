"""Property graph as two tables: nodes(id, name, type, ...) and edges(subject, object, predicates, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.components import connected_components
from millrace.session import cut

# Predicates without a direction, and those of document structure.
SYMMETRIC = ("knows", "collaborated_with", "partnered_with", "related_to", "associated_with")
STRUCTURAL = ("NEXT", "PART_OF", "MENTIONS")


def latest(df: DataFrame, key: str, when: str, *ties: str) -> DataFrame:
    """The last row of each non-null key by time, then by the tie columns."""
    rest = [c for c in df.columns if c != key]
    order = F.struct(F.col(when).alias("_o"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)])
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def domain_triples(triples: DataFrame, predicate: str = "predicate") -> DataFrame:
    """Without structural predicates, in any letter case."""
    return triples.where(~F.upper(predicate).isin(*STRUCTURAL))


def normalize_triples(triples: DataFrame) -> DataFrame:
    """Self-loops of domain predicates dropped, symmetric ones oriented by id, repeats (evidence aside) dropped; the first by pos stays.

    Needs pos, subject, predicate, object, evidence_sentence, source_chunk_id, description, confidence.
    Triples without an end or predicate are dropped. Window-free: one hash aggregate.
    """
    t = triples.where("subject is not null and object is not null and predicate is not null")
    t = t.where((F.col("subject") != F.col("object")) | F.col("predicate").isin(*STRUCTURAL))
    swap = F.col("predicate").isin(*SYMMETRIC) & (F.col("object") < F.col("subject"))
    t = t.select("pos", F.when(swap, F.col("object")).otherwise(F.col("subject")).alias("subject"), "predicate", F.when(swap, F.col("subject")).otherwise(F.col("object")).alias("object"), "evidence_sentence", "source_chunk_id", "description", "confidence")
    key = ["subject", "predicate", "object", "source_chunk_id", "description", "confidence"]
    return t.groupBy(*key).agg(F.min_by("evidence_sentence", "pos").alias("evidence_sentence"), F.min("pos").alias("pos"))


def first_seen(value: Column, pos: Column) -> Column:
    """An aggregate: distinct non-empty values in order of first position.

    Values are counted once per partition first, so what a hot pair collects are its distinct values.
    """
    seen = F.sort_array(F.collect_set(F.when(value.isNotNull() & (value != ""), F.struct(pos.alias("pos"), value.alias("v")))))
    return F.array_distinct(F.transform(seen, lambda x: x["v"]))


def build_edges(triples: DataFrame) -> DataFrame:
    """(subject, object, predicates, weight, source_texts, source_chunk_ids, description): one row per ordered pair.

    Values keep the order in which they were first seen; weight counts distinct predicates; the last
    non-empty description stays. Distinct values are found before pairs are gathered, so repeats of a
    hot pair never travel.
    """
    ends = triples.where("subject is not null and object is not null")
    kinds = {"predicates": "predicate", "source_texts": "evidence_sentence", "source_chunk_ids": "source_chunk_id"}
    long = ends.select("subject", "object", "pos", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in kinds.items()])).alias("x")).select("subject", "object", "pos", "x.k", "x.v").where("v is not null and v <> ''")
    once = long.groupBy("subject", "object", "k", "v").agg(F.min("pos").alias("pos"))
    pick = lambda k: F.transform(F.sort_array(F.collect_list(F.when(F.col("k") == k, F.struct("pos", "v")))), lambda x: x["v"]).alias(k)
    lists = once.groupBy("subject", "object").agg(*[pick(k) for k in kinds])
    text = ends.groupBy("subject", "object").agg(F.coalesce(F.max_by("description", F.when(F.col("description") != "", F.col("pos"))), F.lit("")).alias("description"))
    return lists.join(text, ["subject", "object"]).withColumn("weight", F.size("predicates"))


def build_nodes(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """Entity nodes (id, name, type) and ENTITY stubs for ends that aren't among them."""
    ends = edges.select(F.col("subject").alias("id")).union(edges.select("object")).distinct()
    stubs = ends.join(entities.select("id"), "id", "left_anti").select("id", F.col("id").alias("name"), F.lit("ENTITY").alias("type"))
    return entities.select("id", "name", "type").unionByName(stubs)


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, out_degree, in_degree) of every node."""
    ends = edges.select(F.col("subject").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("object", F.lit(0), F.lit(1)))
    d = ends.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
    return nodes.select("id").join(d, "id", "left").na.fill(0, ["out_degree", "in_degree"])


def weak_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id of the weakly connected component."""
    parts = connected_components(edges, "subject", "object")
    return nodes.select("id").join(parts, F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("component"))


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-4, max_rounds: int = 100, weight: str | None = "weight") -> DataFrame:
    """(id, rank): weighted PageRank with uniform dangling mass, until the change sums to less than tolerance times the nodes.

    One join and one aggregate a round; the lineage is cut every five rounds.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    out = edges.select(F.col("subject").alias("s"), F.col("object").alias("o"), w.alias("w")).where("w > 0")
    total = out.groupBy("s").agg(F.sum("w").alias("t"))
    links = cut(out.join(total, "s").select("s", "o", (F.col("w") / F.col("t")).alias("p")))
    base = cut(nodes.select("id").distinct().join(total.select(F.col("s").alias("id"), F.lit(True).alias("has")), "id", "left"))
    n = base.count()
    if n == 0:
        return base.select("id", F.lit(0.0).alias("rank"))
    ranks = base.select("id", "has", F.lit(1.0 / n).alias("rank"))
    for i in range(max_rounds):
        dangling = ranks.where("has is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        got = links.join(ranks, F.col("s") == F.col("id")).groupBy("o").agg(F.sum(F.col("p") * F.col("rank")).alias("x"))
        new = ranks.join(got, F.col("id") == F.col("o"), "left").select("id", "has", F.col("rank").alias("old"), (F.coalesce("x", F.lit(0.0)) * damping + (1 - damping + damping * dangling) / n).alias("rank"))
        new = cut(new)
        change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
        ranks = new.select("id", "has", "rank")
        if change < tolerance * n:
            break
    return ranks.select("id", F.round("rank", 6).alias("rank"))


def reachable(nodes: DataFrame, edges: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """(start, id, depth): nodes reached from each start along directed edges, at their least depth.

    A start counts itself if it lies on a cycle. Each frontier is one join and one anti-join.
    """
    step = cut(edges.select(F.col("subject").alias("s"), F.col("object").alias("o")).distinct())
    seen, front = None, starts.select(F.col("id").alias("start"), "id")
    for depth in range(1, hops + 1):
        new = front.join(step, F.col("id") == F.col("s")).select("start", F.col("o").alias("id")).distinct()
        if seen is not None:
            new = new.join(seen.select("start", "id"), ["start", "id"], "left_anti")
        new = cut(new.withColumn("depth", F.lit(depth)))
        seen = new if seen is None else seen.union(new)
        front = new.select("start", "id")
    return seen


def next_edges(chunks: DataFrame, parent: str, pos: str, key: str) -> DataFrame:
    """(subject, object): consecutive chunks of one parent in the surviving order."""
    w = Window.partitionBy(parent).orderBy(pos)
    return chunks.select(F.col(key).alias("subject"), F.lead(key).over(w).alias("object")).where("object is not null")


def replace_documents(edges: DataFrame, nodes: DataFrame, replaced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) after the chunks of replaced(chunk_id) went: provenance pruned, unsupported edges and orphaned ends dropped.

    Edges that never had provenance stay; so do nodes that had no edge before.
    """
    gone = replaced.select(F.col("chunk_id").alias("c")).where("c is not null").distinct()
    support = edges.select("subject", "object", F.posexplode("source_chunk_ids").alias("i", "c"))
    left = support.join(gone, "c", "left_anti").groupBy("subject", "object").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "c"))), lambda x: x["c"]).alias("kept"))
    kept = edges.join(left, ["subject", "object"], "left").where("kept is not null or size(source_chunk_ids) = 0").withColumn("source_chunk_ids", F.coalesce("kept", "source_chunk_ids")).drop("kept")
    before = edges.select(F.col("subject").alias("id")).union(edges.select("object")).distinct()
    after = kept.select(F.col("subject").alias("id")).union(kept.select("object")).distinct()
    orphaned = before.join(after, "id", "left_anti")
    return kept, nodes.join(orphaned, "id", "left_anti")


def version_status(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """(key, status): new, replaced, unchanged or absent documents between two snapshots, by content hash."""
    a = old.select(F.col(key), F.sha2(text, 256).alias("was")).where(F.col(key).isNotNull()).groupBy(key).agg(F.max("was").alias("was"), F.lit(True).alias("a"))
    b = new.select(F.col(key), F.sha2(text, 256).alias("now")).where(F.col(key).isNotNull()).groupBy(key).agg(F.max("now").alias("now"), F.lit(True).alias("b"))
    status = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "absent").when(F.col("was").eqNullSafe(F.col("now")), "unchanged").otherwise("replaced")
    return a.join(b, key, "full").select(key, status.alias("status"))
