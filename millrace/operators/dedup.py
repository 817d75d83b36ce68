"""Exact, n-gram, SimHash and semantic deduplication; line, triple, fact and question deduplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import char_ngrams, word_shingles
from millrace.operators import grams
from millrace.operators.components import connected_components
from millrace.session import cut


def exact_dedup(docs: DataFrame, text: str, *order: Column) -> DataFrame:
    """The first row of each distinct text by order; null texts are one text. One hash aggregate, no sort."""
    key = F.coalesce(F.sha2(text, 256), F.lit("null"))
    rows = docs.groupBy(key.alias("_k")).agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("r"))
    return rows.select("r.*")


def exact_clusters(docs: DataFrame, key: str, text: str, quality: Column) -> DataFrame:
    """(key, cluster_id, canonical_id, is_duplicate): equal texts; the best quality, then the smallest key, is canonical."""
    d = docs.select(F.col(key).alias("key"), F.sha2(text, 256).alias("h"), quality.alias("q"))
    g = d.groupBy("h").agg(F.count("*").alias("n"), F.min("key").alias("least"), F.min_by("key", F.struct((-F.col("q")).alias("q"), F.col("key"))).alias("canonical_id"))
    return d.join(g, "h").select("key", F.when(F.col("n") > 1, F.concat(F.lit("dup-"), F.col("least").cast("string"))).alias("cluster_id"), F.when(F.col("n") > 1, F.col("canonical_id")).alias("canonical_id"), ((F.col("n") > 1) & (F.col("key") != F.col("canonical_id"))).alias("is_duplicate"))


def set_pairs(sets: DataFrame, key: str, items: str, threshold: float) -> DataFrame:
    """(a, b, similarity): pairs of distinct sets with Jaccard similarity of at least threshold, exactly.

    Equal sets are one class, so a text copied a million times is one row. Prefix filter: with items in
    order of rarity, two similar sets share one of their rarest (1 - threshold) shares; only those are
    joined, with a length filter, and the rest verified. Items are compared as 64-bit values. a and b are the smallest keys of their classes.
    """
    s = sets.select(F.col(key).alias("id"), F.array_sort(F.array_distinct(F.transform(items, lambda x: F.xxhash64(x)))).alias("s")).where("size(s) > 0")
    reps = cut(s.groupBy(F.xxhash64("s").alias("h"), F.hash("s").alias("g")).agg(F.min("id").alias("id"), F.first("s").alias("s")).select("id", "s"))
    long = reps.select("id", F.explode("s").alias("x"), F.size("s").alias("n"))
    often = long.groupBy("x").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("id").orderBy("df", "x")
    pre = long.join(often.where("df > 1"), "x", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("r", F.row_number().over(rank))
    pre = pre.where((F.col("r") <= F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1) & (F.col("df") > 1)).select("id", "x", "n")
    a, b = pre.select(F.col("id").alias("a"), "x", F.col("n").alias("na")), pre.select(F.col("id").alias("b"), "x", F.col("n").alias("nb"))
    cand = a.join(b, "x").where(f"a < b and na >= nb * {threshold} - 1e-9 and nb >= na * {threshold} - 1e-9").select("a", "b").distinct()
    full = cand.join(reps.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(reps.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    sim = both.cast("double") / (F.size("sa") + F.size("sb") - both)
    return full.select("a", "b", sim.alias("similarity")).where(f"similarity >= {threshold} - 1e-12")


def near_dup_clusters(docs: DataFrame, key: str, text: str, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """(key, component, size): every text with the smallest key of its near-duplicate component, over word n-grams."""
    sets = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.array_sort(F.transform(word_shingles(F.col(text), n), lambda x: F.xxhash64(x))).alias("s"))
    sets = cut(sets)
    pairs = set_pairs(sets, "id", "s", threshold)
    keyed = sets.select("id", F.xxhash64("s").alias("h"))
    rep = keyed.groupBy("h").agg(F.min("id").alias("rep"))
    parts = connected_components(pairs)
    out = keyed.join(rep, "h").join(parts, F.col("rep") == F.col("node"), "left").select("id", F.coalesce("root", "rep").alias("component"))
    size = out.groupBy("component").agg(F.count("*").alias("size"))
    return out.join(size, "component").select(F.col("id").alias(key), "component", "size")


def assign_clusters(records: DataFrame, matches: DataFrame, key: str = "record_id", quality: str = "quality") -> DataFrame:
    """(record_id, cluster_id, canonical_id, is_duplicate, method, similarity, matched_record_id) from pairwise evidence.

    matches(a, b, similarity, method) link record ids. The best quality, then the smallest id as a string,
    is canonical; a cluster of several is named after its smallest id; the evidence of a record is its
    strongest match, ties by method and then the matched id. Records without a match stand alone.
    """
    m = matches.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "similarity", "method").where("a <> b")
    m = cut(m.groupBy("a", "b").agg(F.max_by(F.struct("similarity", "method"), F.struct("similarity", F.col("method"))).alias("r")).select("a", "b", "r.*"))
    parts = connected_components(m)
    r = records.select(F.col(key).cast("string").alias("id"), F.coalesce(F.col(quality).cast("double"), F.lit(0.0)).alias("q")).join(parts, F.col("id") == F.col("node"), "left").select("id", "q", F.coalesce("root", "id").alias("root"))
    g = r.groupBy("root").agg(F.min_by("id", F.struct((-F.col("q")).alias("q"), "id")).alias("canonical_id"), F.min("id").alias("least"), F.count("*").alias("n"))
    each = m.select("a", "b", "similarity", "method").union(m.select("b", "a", "similarity", "method"))
    best = each.groupBy(F.col("a").alias("id")).agg(F.min_by(F.struct("method", "similarity", F.col("b").alias("matched")), F.struct((-F.col("similarity")).alias("s"), "method", "b")).alias("e"))
    out = r.join(g, "root").join(best, "id", "left")
    several = F.col("n") > 1
    return out.select(F.col("id").alias("record_id"), F.when(several, F.concat(F.lit("dup-"), "least")).alias("cluster_id"), "canonical_id", (several & (F.col("id") != F.col("canonical_id"))).alias("is_duplicate"), "e.method", "e.similarity", F.col("e.matched").alias("matched_record_id"))


def near_matches(docs: DataFrame, key: str, text: str, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """(a, b, similarity, method): exact copies as a star around their smallest key, near-duplicates between smallest keys."""
    sets = cut(docs.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.sha2(text, 256).alias("c"), F.array_sort(F.transform(word_shingles(F.col(text), n), lambda x: F.xxhash64(x))).alias("s")))
    star = lambda c, m: sets.join(sets.groupBy(F.col(c).alias("_c")).agg(F.min("id").alias("least")), F.col(c) == F.col("_c")).where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"), F.lit(m).alias("method"))
    sets = sets.withColumn("h", F.xxhash64("s"))
    same = star("c", "exact_sha256")
    alike = star("h", "minhash_jaccard").join(same.select("b"), "b", "left_anti").select("a", "b", "similarity", "method")
    return same.union(alike).union(set_pairs(sets, "id", "s", threshold).select("a", "b", "similarity", F.lit("minhash_jaccard")))


def minhash_dedup(docs: DataFrame, pos: str, text: str, threshold: float = 0.8) -> DataFrame:
    """(id): rows dropped as near-duplicates; of a cluster the row whose position is smallest as a string stays."""
    done = assign_clusters(docs.select(F.col(pos).alias("record_id"), F.lit(0.0).alias("quality")), near_matches(docs, pos, text, threshold))
    kind = dict(docs.dtypes)[pos]
    return done.where("is_duplicate").select(F.col("record_id").cast(kind).alias("id"))


def semantic_dedup(vectors: DataFrame, pos: str, vector: str, threshold: float = 0.92) -> DataFrame:
    """(id): rows dropped because they are linked by cosine similarity; the position smallest as a string stays. Exact, not capped."""
    pairs = cosine_pairs(vectors, pos, vector, threshold).withColumn("method", F.lit("semantic_cosine"))
    done = assign_clusters(vectors.select(F.col(pos).alias("record_id"), F.lit(0.0).alias("quality")), pairs)
    return done.where("is_duplicate").select(F.col("record_id").cast(dict(vectors.dtypes)[pos]).alias("id"))


def deduplicate(docs: DataFrame, method: str, pos: str = "pos", text: str = "content", vector: str | None = None, threshold: float = 0.8, semantic_threshold: float = 0.92) -> DataFrame:
    """The rows of docs that a method keeps: none, exact, minhash, simhash, ngram, semantic or layered (minhash, then semantic over what is left).

    pos must be unique; semantic methods need the column `vector`. Another method raises.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be in [0, 1]")
    if method in ("semantic", "layered") and vector is None:
        raise ValueError(f"{method} needs vectors")
    distance = 2 if threshold >= 0.95 else 3 if threshold >= 0.85 else 4 if threshold >= 0.75 else 6
    without = lambda d, gone: d.join(gone.select(F.col("id").alias(pos)), pos, "left_anti").select(*d.columns)
    if method == "none":
        return docs
    if method == "exact":
        return exact_dedup(docs, text, F.col(pos))
    if method == "simhash":
        return without(docs, simhash_dedup(docs, pos, text, distance))
    if method == "ngram":
        return without(docs, ngram_dedup(docs, pos, text, threshold))
    if method == "semantic":
        return without(docs, semantic_dedup(docs, pos, vector, semantic_threshold))
    if method in ("minhash", "layered"):
        left = without(docs, minhash_dedup(docs, pos, text, threshold))
        return left if method == "minhash" else without(left, semantic_dedup(cut(left), pos, vector, semantic_threshold))
    raise ValueError(f"unknown method {method!r}: none, exact, minhash, simhash, ngram, semantic, layered")


def semantic_review(vectors: DataFrame, key: str, vector: str, threshold: float = 0.92, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """(matches, flags): pairs among each record's `top` nearest of at least threshold, once each, and every matched record's strongest one.

    Nothing is dropped: matches(record_id, matched_record_id, similarity), flags(record_id, matched_record_id,
    similarity, flag). `top` is the review's own limit; ties go to the smaller id.
    """
    p = cosine_pairs(vectors, key, vector, threshold)
    both = p.select("a", "b", "similarity").union(p.select("b", "a", "similarity"))
    near = both.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))).where(f"r <= {top}")
    matches = cut(near.select(F.least("a", "b").alias("record_id"), F.greatest("a", "b").alias("matched_record_id"), "similarity").distinct())
    ends = matches.select("record_id", F.col("matched_record_id").alias("m"), "similarity").union(matches.select("matched_record_id", "record_id", "similarity"))
    flags = ends.groupBy("record_id").agg(F.min_by(F.struct(F.col("m").alias("matched_record_id"), "similarity"), F.struct((-F.col("similarity")).alias("s"), "m")).alias("e")).select("record_id", "e.*", F.lit("semantic_duplicate_candidate").alias("flag"))
    return matches, flags


def embed(records: DataFrame, key: str, text: str, tokens: str, encode: Callable[[list[str]], Sequence[Sequence[float]]], budget: int = 8192, rows: int = 32, known: DataFrame | None = None) -> DataFrame:
    """(key, content_hash, embedding) of records, longest first in batches of at most `rows` rows and `budget` tokens.

    A batch that the encoder refuses for memory is halved until a single row fails. known(key,
    content_hash, embedding) are vectors of an earlier run; only other records are encoded.
    """
    r = records.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.sha2(text, 256).alias("content_hash"), F.col(text).alias("text"), F.coalesce(F.col(tokens), F.lit(0)).cast("int").alias("tokens"))
    kind = dict(r.dtypes)["key"]
    have = None if known is None else known.select(F.col(key).alias("key"), "content_hash", F.col("embedding").cast("array<float>").alias("embedding")).join(r.select("key", "content_hash"), ["key", "content_hash"], "left_semi")
    if have is not None:
        r = r.join(have.select("key", "content_hash"), ["key", "content_hash"], "left_anti")

    def encoded(texts: list[str]) -> list:
        try:
            return [list(map(float, v)) for v in encode(texts)]
        except (MemoryError, RuntimeError) as e:
            if len(texts) < 2 or not (isinstance(e, MemoryError) or "memory" in str(e).lower()):
                raise
            half = len(texts) // 2
            return encoded(texts[:half]) + encoded(texts[half:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.sort_values(["tokens", "key"], ascending=[False, True], kind="stable")
            vectors: list = []
            held: list[str] = []
            most = 0
            for t, n in zip(b["text"], b["tokens"]):
                most = max(most, n)
                if held and (len(held) >= rows or most * (len(held) + 1) > budget):
                    vectors += encoded(held)
                    held, most = [], n
                held.append(t)
            vectors += encoded(held) if held else []
            yield pd.DataFrame({"key": b["key"], "content_hash": b["content_hash"], "embedding": vectors})

    new = r.select("key", "content_hash", "text", "tokens").mapInPandas(run, f"key {kind}, content_hash string, embedding array<float>")
    return (new if have is None else have.unionByName(new)).withColumnRenamed("key", key)


def _simhash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    shifts = np.arange(64, dtype=np.uint64)
    for b in batches:
        out = []
        for t in b["text"]:
            grams = [t[i : i + 4] for i in range(max(len(t) - 3, 1))]
            kinds, times = np.unique(np.asarray(grams, object).astype("U4"), return_counts=True)
            h = np.fromiter((int.from_bytes(hashlib.md5(g.encode()).digest()[8:], "big") for g in kinds.tolist()), np.uint64, len(kinds))
            votes = (((h[:, None] >> shifts) & np.uint64(1)).astype(np.int64) * 2 - 1) * times[:, None]
            out.append(np.uint64(sum(1 << i for i in np.flatnonzero(votes.sum(0) > 0).tolist())).astype(np.int64))
        yield pd.DataFrame({"id": b["id"], "signature": np.asarray(out, np.int64)})


def simhash_signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, signature) of non-null texts, as signed 64-bit numbers."""
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null and id is not null")
    return d.mapInPandas(_simhash_batches, "id long, signature long")


def greedy_keep_first(pairs: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(id): rows dropped when each row in order is dropped if it is linked to an earlier kept one.

    The sequential rule as rounds: a row all of whose earlier neighbours are dropped is kept, a row with
    a kept earlier neighbour is dropped. A round decides every row whose earlier neighbours are decided,
    so the number of rounds is the longest chain of links in order, usually a handful.
    """
    e = cut(pairs.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct())
    dropped = e.select(F.col("v").alias("id")).limit(0)
    for _ in range(max_rounds):
        later = e.select("v").distinct()
        kept = e.select(F.col("u").alias("id")).distinct().join(later, F.col("id") == F.col("v"), "left_anti")
        gone = e.join(kept, F.col("u") == F.col("id"), "left_semi").select(F.col("v").alias("id")).distinct()
        dropped = cut(dropped.union(gone))
        left = e.join(gone, F.col("u") == F.col("id"), "left_anti").join(gone, F.col("v") == F.col("id"), "left_anti").join(kept, F.col("u") == F.col("id"), "left_anti")
        e = cut(left)
        if e.isEmpty():
            return dropped.distinct()
    raise RuntimeError("greedy order not settled")


def simhash_dedup(docs: DataFrame, key: str, text: str, distance: int = 3) -> DataFrame:
    """(id): texts dropped because an earlier kept one is within a Hamming distance, by blocks.

    distance + 1 blocks of bits: at least one is equal within the distance, so equal blocks are joined
    and candidates counted exactly. Equal signatures are one class.
    """
    sig = cut(simhash_signatures(docs, key, text))
    reps = sig.groupBy("signature").agg(F.min("id").alias("id"))
    width = -(-64 // (distance + 1))
    blocks = F.array(*[F.struct(F.lit(i).alias("i"), F.shiftrightunsigned("signature", i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("v")) for i in range(distance + 1)])
    r = reps.select("id", "signature", F.explode(blocks).alias("k"))
    a, b = r.select(F.col("id").alias("a"), F.col("signature").alias("sa"), "k"), r.select(F.col("id").alias("b"), F.col("signature").alias("sb"), "k")
    near = a.join(b, "k").where("a < b").where(F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= distance).select("a", "b").distinct()
    gone = greedy_keep_first(near).select(F.col("id").alias("r"))
    copies = sig.join(reps.select("signature", F.col("id").alias("rep")), "signature")
    return copies.where("id <> rep").select("id").union(copies.where("id = rep").join(gone, F.col("id") == F.col("r"), "left_semi").select("id"))


def ngram_dedup(docs: DataFrame, key: str, text: str, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """(id): texts dropped because an earlier kept one shares enough character n-grams.

    Copies of a text go with its first row. Below the least threshold of ngram_pairs, or with a key that
    isn't a whole number, a row is made of every n-gram.
    """
    kind = dict(docs.dtypes)[key]
    if threshold < grams.LEAST or kind not in ("tinyint", "smallint", "int", "bigint"):
        sets = cut(docs.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.array_sort(F.array_distinct(F.transform(char_ngrams(F.col(text), n), lambda x: F.xxhash64(x)))).alias("s")))
        keyed = sets.select("id", F.xxhash64("s").alias("h"))
        rep = keyed.groupBy("h").agg(F.min("id").alias("rep"))
        gone = greedy_keep_first(set_pairs(sets, "id", "s", threshold)).select(F.col("id").alias("r"))
        all_ = keyed.join(rep, "h")
        return all_.where("id <> rep").select("id").union(all_.where("id = rep").join(gone, F.col("id") == F.col("r"), "left_semi").select("id"))
    keyed = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(text).alias("h"))
    rep = keyed.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    copies = keyed.join(rep, "h").where("id <> rep").select("id")
    gone = greedy_keep_first(grams.ngram_pairs(docs, key, text, threshold, n).select("a", "b"))
    return copies.union(gone.select(F.col("id").cast(kind).alias("id")))


def _blocks(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qa, qv, ba, bv in zip(*(batch.column(i).to_pylist() for i in range(4))):
                q, b = np.frombuffer(qv, np.float32).reshape(len(qa), -1), np.frombuffer(bv, np.float32).reshape(len(ba), -1)
                sim = q.astype(np.float64) @ b.astype(np.float64).T
                i, j = np.nonzero(sim >= threshold)
                qa_, ba_ = np.asarray(qa), np.asarray(ba)
                yield pa.RecordBatch.from_arrays([pa.array(qa_[i]), pa.array(ba_[j]), pa.array(sim[i, j])], names=["a", "b", "similarity"])

    return run


def cosine_pairs(vectors: DataFrame, key: str, vector: str, threshold: float, queries: Column | None = None, block: int = 2048) -> DataFrame:
    """(a, b, similarity): all rows b with a cosine similarity of at least threshold to a query a, a < b or a <> b for given queries.

    Without queries: exact over all rows, for sets up to some ten thousands (block against block); with
    a condition that picks queries, those against all rows, a product of two blocks at a time.
    """
    v = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), (queries if queries is not None else F.lit(True)).alias("q")).where("id is not null and v is not null")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    v = v.withColumn("n", norm).where("n > 0").select("id", "q", F.transform("v", lambda x: (x / F.col("n")).cast("float")).alias("v"))
    n = v.count()
    parts = max(1, -(-n // block))
    blocked = v.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(parts)))

    def pack(t: pa.Table) -> pa.Table:
        m = np.asarray(t.column("v").to_pylist(), np.float32)
        return pa.table({"b": pa.array([t.column("b")[0].as_py()], pa.int64()), "ids": pa.array([t.column("id").to_pylist()], pa.list_(pa.int64())), "m": pa.array([m.tobytes()], pa.binary())})

    all_ = cut(blocked.drop("q").groupBy("b").applyInArrow(pack, "b long, ids array<long>, m binary"))
    some = all_ if queries is None else blocked.where("q").drop("q").groupBy("b").applyInArrow(pack, "b long, ids array<long>, m binary")
    # blocks meet through an explicit list of block numbers: an equi-join, one task a pair of blocks
    first = F.lit(0).cast("long") if queries is not None else F.col("b")
    left = some.select(F.col("ids").alias("qa"), F.col("m").alias("qv"), F.explode(F.sequence(first, F.lit(parts - 1).cast("long"))).alias("to"))
    met = left.join(all_.select(F.col("b").alias("to"), F.col("ids").alias("ba"), F.col("m").alias("bv")), "to").select("qa", "qv", "ba", "bv")
    out = met.mapInArrow(_blocks(threshold), "a long, b long, similarity double")
    if queries is not None:
        return out.where("a <> b")
    # every pair of blocks meets once; within a block both orders come out
    return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


# Starts of lines that are page furniture as soon as two pages have them.
STARTS = ("Bộ ", "Tỉnh ", "Thành phố ", "Tập đoàn ", "Tổng công ty ", "Tổng Công ty ", "Công ty TNHH ", "Trung tâm ", "Đoạn ", "Phó Thủ tướng ", "Thủ tướng ", "Lĩnh vực ")


def line_frequency(pages: DataFrame, key: str, text: str) -> DataFrame:
    """(line, pages): on how many pages each trimmed line of at least four characters stands."""
    x = pages.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.explode(F.array_distinct(F.filter(F.transform(F.split(text, "\n"), F.trim), lambda l: F.length(l) >= 4))).alias("line"))
    return x.groupBy("line").agg(F.count("*").alias("pages"))


def drop_frequent_lines(pages: DataFrame, key: str, text: str, share: float = 0.33) -> DataFrame:
    """(key, text, content_hash, n): pages without lines that stand on max(2, share of all) pages, or on two with a known start.

    Fewer than three pages stay as they are. The frequent lines are joined, so their number may grow.
    """
    p = pages.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    n = p.count()
    if n < 3:
        return p.select(F.col("k").alias(key), F.col("t").alias("text"), F.sha2("t", 256).alias("content_hash"), F.length("t").alias("n"))
    often = line_frequency(p, "k", "t").where((F.col("pages") >= max(2, int(n * share))) | ((F.col("pages") > 1) & F.col("line").rlike("^(?:" + "|".join(STARTS) + ")"))).select(F.col("line").alias("l"))
    x = p.select("k", F.posexplode(F.split("t", "\n")).alias("i", "line")).withColumn("l", F.trim("line"))
    left = x.join(often, "l", "left_anti").groupBy("k").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "line"))), lambda r: r["line"]), "\n").alias("text"))
    out = p.select("k").join(left, "k", "left").select(F.col("k").alias(key), F.coalesce("text", F.lit("")).alias("text"))
    return out.withColumn("content_hash", F.sha2("text", 256)).withColumn("n", F.length("text"))
