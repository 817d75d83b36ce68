"""Near-duplicate records: bottom-k sketches, inverted lists, exact verification.

One hash function gives every run of `words` consecutive words a 64-bit value; the k smallest of
a text are its sketch. Two texts of similarity s share each value of their common sketch with
probability s, so they share stretches of r consecutive retained values with probability s**r a
place. The inverted lists are keyed by such stretches rather than by single values: texts that only
share stock phrases meet in few lists, near copies in many. r depends on the number of distinct
runs, with overlapping ranges, so texts whose sizes differ by up to a factor two meet at one r.

1. one pass over the texts emits, per batch and bucket, packed (list key, class) arrays; a class is
   a set of texts with the same runs, so exact copies count once however many there are;
2. each bucket, a bounded share of all keys, turns lists into weighted class pairs; of a hot list every
   pair is judged by the union sketch instead, in blocks, at the smallest hot key that the two share;
3. for pairs with enough weight the union sketch (the smallest values of both) estimates the
   similarity; only pairs it leaves open get their whole run sets and are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.runs import WordHasher, mix, run_set
from millrace.operators.components import connected_components
from millrace.session import cut

#: (retained values in a key, fewest and most distinct runs of a text, weight of a shared key)
LEVELS = ((4, 64, 1 << 40, 2), (3, 16, 127, 1), (2, 6, 63, 2), (1, 1, 15, 3))
ENOUGH = 3
HOT = 256
#: Classes of a hot list in one block; a task gets two blocks.
BLOCK = 2048
#: Most rows (16 bytes each) of a side that is broadcast; more are joined by shuffling.
BROADCAST_ROWS = 1_000_000
#: Values of the sketch that filters pairs before their run sets are moved.
FILTER = 32
_PAD = np.uint32(0xFFFFFFFF)


def _keys(sketch: np.ndarray, n: int) -> np.ndarray:
    """List keys of one text, the level in the lowest two bits."""
    keys = []
    for r, low, high, _ in LEVELS:
        m = len(sketch) - r + 1
        if low <= n <= high and m > 0:
            h = sketch[:m]
            for j in range(1, r):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sketch[j : j + m])
            keys.append((mix(h) & ~np.uint64(3)) | np.uint64(r - 1))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _pack(words: int, k: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            rows, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            member_row, member_class, known = [], [], {}
            keys, owners, sketches, sizes = [], [], [], []
            for row, text in zip(rows, texts):
                s = run_set(text, words, hasher)
                if len(s) == 0:
                    continue
                c = xxhash.xxh3_64_intdigest(s.tobytes())
                member_row.append(row)
                member_class.append(c)
                if c in known:
                    continue
                known[c] = len(known)
                key = _keys(s[:k], len(s))
                sizes.append(len(s))
                sketch = np.full(FILTER, _PAD)
                sketch[: min(FILTER, len(s))] = s[:FILTER] >> np.uint64(32)
                sketches.append(sketch)
                keys.append(key)
                owners.append(np.full(len(key), known[c], np.uint32))
            if not member_row:
                continue
            member = b"".join((np.asarray([len(member_row), len(known)], np.int64).tobytes(), np.asarray(member_class, np.uint64).tobytes(), np.asarray(member_row, np.int64).tobytes(), np.fromiter(known, np.uint64, len(known)).tobytes(), np.asarray(sizes, np.int64).tobytes(), np.concatenate(sketches).tobytes()))
            out_bucket, out_blob = [-1 - int(member_class[0] % buckets)], [member]
            key, owner = np.concatenate(keys), np.concatenate(owners)
            classes = np.fromiter(known, np.uint64, len(known))
            bucket = ((key >> np.uint64(34)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                o = order[at[b] : at[b + 1]]
                if len(o):
                    used, local = np.unique(owner[o], return_inverse=True)
                    out_bucket.append(b)
                    out_blob.append(b"".join((np.asarray([len(used), len(o)], np.uint32).tobytes(), classes[used].tobytes(), key[o].astype(np.uint32).tobytes(), local.astype(np.uint32 if len(used) > 65535 else np.uint16).tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array(out_blob, pa.binary())], names=["bucket", "blob"])

    return run


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(blob, np.uint32, 2)
    n, m = int(n), int(m)
    classes = np.frombuffer(blob, np.uint64, n, 8)
    key = np.frombuffer(blob, np.uint32, m, 8 + 8 * n)
    wide = np.uint32 if n > 65535 else np.uint16
    local = np.frombuffer(blob, wide, m, 8 + 8 * n + 4 * m)
    return key, classes[local]


def _list_pairs(key: np.ndarray, cls: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (first, second, key) of each list; key and cls are sorted by key."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    for n in np.unique(size[size > 1]):
        at = start[size == n]
        step = max(1, int(4_000_000 // (n * n)))
        i, j = np.triu_indices(n, 1)
        for s in range(0, len(at), step):
            rows = cls[at[s : s + step, None] + np.arange(n)]
            yield rows[:, i].ravel(), rows[:, j].ravel(), np.repeat(key[at[s : s + step]], len(i))


def _lists(keys: tuple, table: pa.Table) -> pa.Table:
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "w": pa.array([], pa.int32()), "sketch": pa.array([], pa.binary())})
    blobs = table.column("blob").to_pylist()
    if keys[0].as_py() < 0:  # members: class and row; then each class's size and short sketch
        out = []
        for x in blobs:
            n, m = (int(v) for v in np.frombuffer(x, np.int64, 2))
            at = 16 + 16 * n
            sketches = [x[at + 16 * m + 4 * FILTER * i : at + 16 * m + 4 * FILTER * (i + 1)] for i in range(m)]
            out.append((np.frombuffer(x, np.int64, n, 16), np.frombuffer(x, np.int64, n, 16 + 8 * n), np.frombuffer(x, np.int64, m, at), np.frombuffer(x, np.int64, m, at + 8 * m), sketches))
        a = np.concatenate([v for c, _, d, _, _ in out for v in (c, d)])
        b = np.concatenate([v for _, r, _, z, _ in out for v in (r, z)])
        w = np.concatenate([v for c, _, d, _, _ in out for v in (np.full(len(c), -1, np.int32), np.full(len(d), -2, np.int32))])
        return pa.table({"a": a, "b": b, "w": w, "sketch": pa.array([v for c, _, _, _, k in out for v in [None] * len(c) + k], pa.binary())})
    parts = [_unpack(x) for x in blobs]
    key, cls = (np.concatenate([p[i] for p in parts]) for i in range(2))
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]
    key, cls = key[fresh], cls[fresh]
    # hot lists leave as they are, for _hot_pairs
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.repeat(np.diff(np.r_[start, len(key)]), np.diff(np.r_[start, len(key)]))
    hot = size > HOT
    a, b = [cls[hot].view(np.int64)], [key[hot].astype(np.int64) | np.int64(keys[0].as_py() << 32)]
    w = [np.full(int(hot.sum()), -3, np.int32)]
    weight = np.zeros(4, np.int32)
    for r, _, _, v in LEVELS:
        weight[r - 1] = v
    if not hot.all():
        for x, y, k in _list_pairs(key[~hot], cls[~hot]):
            x, y = x.view(np.int64), y.view(np.int64)
            a.append(np.minimum(x, y))
            b.append(np.maximum(x, y))
            w.append(weight[(k & np.uint32(3)).astype(np.int64)])
    a, b, w = np.concatenate(a), np.concatenate(b), np.concatenate(w)
    return pa.table({"a": a, "b": b, "w": w, "sketch": pa.nulls(len(w), pa.binary())})


def _near(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two sketch matrices _estimate would keep; whole run sets are compared without its deviations."""
    both = np.sort(np.concatenate((x, y), 1), 1)
    real = both != _PAD
    again = np.zeros_like(real)
    again[:, 1:] = real[:, 1:] & (both[:, 1:] == both[:, :-1])
    rank = np.cumsum(real & ~again, 1)
    n = np.clip(rank[:, -1], 1, FILTER)
    whole = (x[:, -1] == _PAD) & (y[:, -1] == _PAD)
    near = np.where(whole, again.sum(1) / np.maximum(rank[:, -1], 1), (again & (rank <= FILTER)).sum(1) / n)
    return near + np.where(whole, 0.01, 4 * np.sqrt(threshold * (1 - threshold) / n)) >= threshold


def _hot_pairs(threshold: float):
    """Pairs of a hot list that may be similar, of two of its blocks; a pair counts at the smallest hot key it shares."""

    def run(keys: tuple, table: pa.Table) -> pa.Table:
        key, one, two = (x.as_py() for x in keys)
        cls, block, size = (table.column(c).to_numpy() for c in ("class", "block", "size"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(-1, FILTER)
        lists = table.column("keys").combine_chunks()
        value, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(cls)), lists.value_lengths().to_numpy())
        less = value < key
        names, at = np.unique(value[less], return_inverse=True)
        has = np.zeros((len(cls), len(names)), np.float32)
        has[owner[less], at] = 1
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s in range(0, len(left), 64):
            rows = left[s : s + 64]
            m, n = size[rows, None], size[None, right]
            ok = (np.minimum(m, n) >= threshold * np.maximum(m, n)) & (has[rows] @ has[right].T == 0)
            if one == two:
                ok &= cls[rows, None] < cls[None, right]
            i, j = np.nonzero(ok)
            i, j = rows[i], right[j]
            near = _near(sketch[i], sketch[j], threshold) if len(i) else np.empty(0, bool)
            x, y = cls[i[near]], cls[j[near]]
            out_a.append(np.minimum(x, y))
            out_b.append(np.maximum(x, y))
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return run


def _slim(s: np.ndarray) -> bytes:
    """The upper 48 bits of sorted values: enough to tell the runs of two texts apart, a quarter less to move."""
    h = s >> np.uint64(16)
    return (h >> np.uint64(16)).astype(np.uint32).tobytes() + h.astype(np.uint16).tobytes()


def _wide(blob: pa.Buffer) -> np.ndarray:
    n = len(blob) // 6
    return (np.frombuffer(blob, np.uint32, n).astype(np.uint64) << np.uint64(16)) | np.frombuffer(blob, np.uint16, n, 4 * n)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sets = [_slim(run_set(x, words, hasher)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["class", "runs"])

    return run


def _estimate(threshold: float):
    """Pairs whose union sketch (the smallest values of both) leaves the threshold within four deviations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                x, y = x[x != _PAD], y[y != _PAD]
                union = np.union1d(x, y)[:FILTER]
                both = np.intersect1d(x, y)
                near = np.searchsorted(both, union[-1], "right") / len(union) if len(union) else 1.0
                keep.append(near + 4 * np.sqrt(threshold * (1 - threshold) / max(len(union), 1)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = _wide(x.as_buffer()), _wide(y.as_buffer())
                n = len(np.intersect1d(x, y, assume_unique=True))
                s = n / (len(x) + len(y) - n)
                sims.append(s if s >= threshold else None)
            keep = pa.array([s is not None for s in sims])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array([s for s in sims if s is not None], pa.float64())], names=["a", "b", "similarity"])

    return run


def near_duplicates(docs: DataFrame, text: str, row: str, words: int = 5, threshold: float = 0.8, k: int = 128) -> tuple[DataFrame, DataFrame]:
    """(links, members) of the near-duplicates among docs.

    members(row, class, group): one row per text with at least one word; class is shared by texts
    with the same runs, group by all texts joined by links (a class without links is its own group).
    links(a, b, similarity): pairs of classes whose run sets have a Jaccard similarity of at least
    threshold; copies aren't expanded into pairs. row must be a unique BIGINT; rows where it is null
    and null, blank or wordless texts aren't in the result; extra columns are ignored; an
    empty table gives empty results. A text of fewer than `words` words has one run. Texts are read
    whole. Candidates are found with high probability: at a similarity of 0.5 at most 1 % of pairs of equal
    size and 2.2 % of pairs whose sizes differ by a factor two are missed (README, Known limits).
    Raises below a threshold of 0.5: the ranges of sizes that meet overlap by a factor of two.
    """
    if threshold < 0.5:
        raise ValueError("threshold must be at least 0.5")
    slim = docs.select(F.col(row).cast("long").alias("row"), F.col(text).cast("string").alias("text")).where("row is not null and text is not null")
    buckets = max(12, ceil(docs.count() / 4000))
    lists = cut(slim.mapInArrow(_pack(words, k, buckets), "bucket int, blob binary").groupBy("bucket").applyInArrow(_lists, "a long, b long, w int, sketch binary"))
    members = lists.where("w = -1").select(F.col("b").alias("row"), F.col("a").alias("class"))
    sketch = lists.where("w = -2").groupBy(F.col("a").alias("class")).agg(F.first("sketch").alias("sketch"), F.first("b").alias("size"))
    pairs = lists.where("w > 0").groupBy("a", "b").agg(F.sum("w").alias("w")).where(f"w >= {ENOUGH}").select("a", "b")
    pairs = pairs.join(sketch.select(F.col("class").alias("a"), F.col("sketch").alias("x")), "a").join(sketch.select(F.col("class").alias("b"), F.col("sketch").alias("y")), "b").select("a", "b", "x", "y")
    pairs = pairs.mapInArrow(_estimate(threshold), "a long, b long")
    hot = lists.where("w = -3").select(F.col("a").alias("class"), F.col("b").alias("key"))
    if not hot.isEmpty():
        own = hot.groupBy("class").agg(F.collect_list("key").alias("keys")).join(sketch, "class")
        blocks = hot.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        own = hot.join(own, "class").join(blocks, "key").withColumn("block", F.expr("cast(pmod(xxhash64(class), blocks) as int)"))
        own = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
        pairs = pairs.union(own.select("key", "one", "two", "class", "block", "size", "keys", "sketch").groupBy("key", "one", "two").applyInArrow(_hot_pairs(threshold), "a long, b long")).distinct()
    pairs = cut(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    first = members.groupBy("class").agg(F.min("row").alias("row")).join(wanted, "class", "left_semi")
    first = cut(first.select("class", "row"))
    if first.count() <= BROADCAST_ROWS:  # a checked size: the texts then stay where they are read
        first = F.broadcast(first)
    sets = slim.join(first, "row").select("class", "text").mapInArrow(_sets(words), "class long, runs binary")
    sets = cut(sets)
    left, right = sets.select(F.col("class").alias("a"), F.col("runs").alias("x")), sets.select(F.col("class").alias("b"), F.col("runs").alias("y"))
    links = cut(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify(threshold), "a long, b long, similarity double"))
    parts = connected_components(links)
    members = members.join(parts.select(F.col("node").alias("class"), "root"), "class", "left").select("row", "class", F.coalesce("root", "class").alias("group"))
    return links, members


def group_pairs(members: DataFrame, docs: DataFrame, row: str, key: str) -> DataFrame:
    """(a, b): pairs a < b of different keys in one group, each once."""
    named = members.join(docs.select(F.col(row).alias("row"), F.col(key).alias("key")).where("key is not null"), "row").select("group", "key").distinct()
    big = named.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    named = named.join(big, "group", "left_semi")
    return named.select("group", F.col("key").alias("a")).join(named.select("group", F.col("key").alias("b")), "group").where("a < b").select("a", "b").distinct()
