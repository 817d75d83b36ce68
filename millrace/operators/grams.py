"""Pairs of texts that share enough character n-grams: exact, without a row per n-gram.

The n-grams of a text, as 64-bit values, fall into m parts by value. Two sets of n and n' values
with a Jaccard similarity of at least t differ in at most k = (1 - t) / (1 + t) * (n + n') values,
and each spoils one part, so all parts but k are equal. A part's content is hashed to a signature;
two similar texts differ in at most k signatures, so if each sends its first k + s in one order of
all signatures, they share s of them (prefix filter). The order is by how often a signature occurs,
rarest first, from a table of counters of fixed size; any order gives the same pairs.

1. one pass counts signatures of all texts;
2. one pass sends the first k + s of each text, packed by level and bucket. A level is a range of sizes that fixes m;
   a text whose partners may reach into the next level is sent to both. s = (hits - 1) * buckets + 1, so
   similar texts share `hits` signatures in at least one bucket;
3. each bucket yields the pairs with that many; their n-grams are compared exactly.

Texts with fewer than k + s parts also send their rarest single n-grams (the ordinary prefix filter); a pair of which one
has enough parts is found by the parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.runs import mix
from millrace.session import cut

#: Least threshold: below, the sizes of similar texts span more than two levels or single n-grams don't suffice.
LEAST = 0.6
#: Sizes of the first level, whose parts are single values; each further level reaches twice as far.
FIRST = 64
#: Counters of signatures, as a power of two, and slices in which they are added up.
COUNTERS, SLICES = 22, 16
#: Texts up to which there are the fewest buckets, the fewest and the most.
FEW_TEXTS, BUCKETS = 1_000_000, (12, 64)
#: Characters hashed at once, pairs counted at once, and rows of a side that is broadcast.
CHARS, PAIRS, BROADCAST_ROWS = 400_000, 8_000_000, 500_000
#: Most signatures that a pair must share in a bucket.
MOST_HITS = 4
#: The level of texts with too few parts.
SINGLES = 63
_K = np.uint64(0x9E3779B97F4A7C15)
_32 = np.uint64(32)


def _sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram values of each text, one after the other, and where each text's begin. A text shorter than n is its only n-gram."""
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.zeros(max(len(c) - n + 1, 0), np.uint64)
    for j in range(n):
        h = h * _K + c[j : j + len(h)]
    h = mix(mix(h) + _K)
    sets, at = [], 0
    for t in texts:
        if len(t) >= n:
            sets.append(np.sort(h[at : at + len(t) - n + 1]))
        else:
            x = len(t) + 1
            for ch in t:
                x = (x * int(_K) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
            sets.append(mix(mix(np.asarray([x], np.uint64)) ^ _K))
        at += len(t)
    v = np.concatenate(sets)
    start = np.r_[0, np.cumsum([len(s) for s in sets])]
    fresh = np.r_[True, v[1:] != v[:-1]]
    fresh[start[:-1]] = True
    return v[fresh], np.r_[0, np.cumsum(np.add.reduceat(fresh, start[:-1], dtype=np.int64))]


class Plan:
    """Parts, signatures and their number, by threshold and buckets."""

    def __init__(self, threshold: float, n: int, buckets: int) -> None:
        self.t, self.n, self.buckets = threshold, n, buckets
        self.tops = FIRST * 2 ** np.arange(40, dtype=np.int64)
        # as many hits as cost a level's smallest text under 0.15 of its size in signatures
        self.hits = np.clip((0.15 * np.r_[0, self.tops[:-1]] - 1) // buckets + 1, 1, MOST_HITS).astype(np.int64)
        self.more = (self.hits - 1) * buckets + 1
        self.parts = np.maximum(1, 1.8 * (1 - threshold) / threshold * self.tops).astype(np.int64) + 2 * self.more
        self.parts[0] = 0

    def level(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, size, "right")

    def differ(self, size: np.ndarray, most: np.ndarray) -> np.ndarray:
        """In how many values a text may differ from a similar one of at most `most`."""
        return ((1 - self.t) / (1 + self.t) * (size + most) + 1e-6).astype(np.int64)

    def signatures(self, v: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, level, signatures to send, all signatures, where each text's begin) of each level that a text is sent to."""
        size = np.diff(start)
        most = (size / self.t + 1e-9).astype(np.int64)
        own, next_ = self.level(size), self.level(most)
        for rows, level in ((np.arange(len(size)), own), (np.flatnonzero(next_ > own), next_[next_ > own])):
            if not len(rows):
                continue
            k = size[rows]
            if len(rows) < len(size):
                at = np.repeat(start[rows] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(k.sum())
                x = v[at]
            else:
                x = v
            begin = np.r_[0, np.cumsum(k)]
            m = np.repeat(self.parts[level].astype(np.uint64), k)
            part = ((x >> _32) * m) >> _32
            new = np.r_[True, part[1:] != part[:-1]] | (m == 0)
            new[begin[:-1]] = True
            first = np.flatnonzero(new)
            sig = mix(np.add.reduceat(mix(x + np.repeat(level.astype(np.uint64), k)), first) + _K)
            where = np.r_[np.searchsorted(first, begin)]
            need = self.differ(k, np.minimum(most[rows], self.tops[level] - 1)) + self.more[level]
            yield rows, level, need, sig, where


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held > CHARS:
            yield at, texts[at : i + 1]
            at, held = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def _slot(sig: np.ndarray) -> np.ndarray:
    return (sig >> np.uint64(64 - COUNTERS)).astype(np.int64)


def _count(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTERS, np.uint32)
        any_ = False
        for batch in batches:
            for _, texts in _chunks([x.decode("utf-8", "surrogateescape") for x in batch.column(1).to_pylist()]):
                any_ = True
                for _, _, _, sig, _ in plan.signatures(*_sets(texts, plan.n)):
                    slot, times = np.unique(_slot(sig), return_counts=True)
                    counts[slot] += times.astype(np.uint32)
        if any_:
            # one task's count above 65,535 only means "often"
            blobs = [zlib.compress(b.astype(np.uint8).tobytes() + (b >> np.uint32(8)).astype(np.uint8).tobytes(), 1) for b in np.split(np.minimum(counts, 65535), SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "blob"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The counters of a slice over all tasks, in steps of an eighth of a power of two."""
    n = (1 << COUNTERS) // SLICES
    total = np.zeros(n, np.float64)
    for blob in table.column("blob"):
        b = np.frombuffer(zlib.decompress(blob.as_py()), np.uint8)
        total += b[:n] + 256.0 * b[n:]
    often = np.minimum(8 * np.log2(np.maximum(total, 1)), 255).astype(np.uint8)
    return pa.table({"slice": table.column("slice").slice(0, 1), "often": pa.array([zlib.compress(often.tobytes(), 1)], pa.binary())})


def _send(plan: Plan, packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(zlib.decompress(packed), np.uint8)

        def chosen(sig: np.ndarray, where: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = often[_slot(sig)].astype(np.uint64) << np.uint64(56) | sig >> np.uint64(8)
            out = [order[a:b] if b - a <= k else np.partition(order[a:b], k - 1)[:k] for a, b, k in zip(where[:-1].tolist(), where[1:].tolist(), need.tolist())]
            return np.concatenate(out), np.asarray([len(o) for o in out])

        for whole in batches:
            for piece in range(0, whole.num_rows, 50_000):
                batch = whole.slice(piece, 50_000)
                ids, copies = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
                order = np.lexsort((ids, copies))
                order = order[np.r_[True, copies[order[1:]] != copies[order[:-1]]]] if len(order) else order
                ids, copies = ids[order], copies[order]
                keys, groups, owners, sizes = [], [], [], np.zeros(len(ids), np.uint32)
                for at, texts in _chunks([x.decode("utf-8", "surrogateescape") for x in batch.column(1).take(pa.array(order)).to_pylist()]):
                    v, start = _sets(texts, plan.n)
                    size = np.diff(start)
                    sizes[at : at + len(texts)] = size
                    few = np.zeros(len(texts), bool)
                    sent = []
                    for rows, level, need, sig, where in plan.signatures(v, start):
                        sent.append((rows, level, *chosen(sig, where, need)))
                        few[rows[np.diff(where) < need]] = True
                    if few.any():
                        rows = np.flatnonzero(few)
                        single = np.concatenate([v[start[r] : start[r + 1]] for r in rows])
                        k = size[rows]
                        need = plan.differ(k, (k / plan.t + 1e-9).astype(np.int64)) + 1
                        sent.append((rows, np.full(len(rows), SINGLES), *chosen(mix(single + np.uint64(SINGLES)), np.r_[0, np.cumsum(k)], need)))
                    for rows, level, order, times in sent:
                        keys.append(order.astype(np.uint32))
                        groups.append(np.repeat(level, times) * 64 + (mix(order) % np.uint64(plan.buckets)).astype(np.int64))
                        owners.append(np.repeat(rows + at, times).astype(np.uint16))
                if not keys:
                    continue
                key, group, owner = np.concatenate(keys), np.concatenate(groups), np.concatenate(owners)
                order = np.argsort(group.astype(np.uint64) << _32 | key)
                key, group, owner = key[order], group[order], owner[order]
                edge = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
                blobs = []
                for a, b in zip(edge[:-1], edge[1:]):
                    used, local = np.unique(owner[a:b], return_inverse=True)
                    step = np.diff(key[a:b], prepend=np.uint32(0))
                    blobs.append(b"".join((np.asarray([len(used), b - a], np.int64).tobytes(), ids[used].astype(np.int64).tobytes(), copies[used].astype(np.int64).tobytes(), sizes[used].tobytes(), step.astype(np.uint16).tobytes(), (step >> np.uint32(16)).astype(np.uint16).tobytes(), local.astype(np.uint16).tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(group[edge[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    return run


def _meet(plan: Plan):
    """Pairs of texts that share enough signatures in a bucket and whose sizes allow for the threshold."""

    def run(keys: tuple, table: pa.Table) -> pa.Table:
        level = keys[0].as_py() // 64
        hits = 1 if level == SINGLES else int(plan.hits[level])
        ids, copies, sizes, rows, texts = [], [], [], [], 0
        for blob in table.column("blob"):
            blob = blob.as_buffer()
            n, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
            at = 16 + 20 * n
            ids.append(np.frombuffer(blob, np.int64, n, 16))
            copies.append(np.frombuffer(blob, np.int64, n, 16 + 8 * n))
            sizes.append(np.frombuffer(blob, np.uint32, n, 16 + 16 * n))
            low, high, local = (np.frombuffer(blob, np.uint16, m, at + 2 * m * i) for i in range(3))
            key = np.cumsum(low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(16))
            rows.append(key << _32 | (local.astype(np.uint64) + np.uint64(texts)))
            texts += n
        ids, copies, sizes, row = np.concatenate(ids), np.concatenate(copies), np.concatenate(sizes).astype(np.float64), np.concatenate(rows)
        del rows
        # copies send the same, so all of a text's are here: its least key stays
        order = np.lexsort((ids, copies))
        stays = np.zeros(len(ids), bool)
        stays[order[np.r_[True, copies[order[1:]] != copies[order[:-1]]]]] = True
        if not stays.all():
            row = row[stays[(row & np.uint64(0xFFFFFFFF)).astype(np.int64)]]
        row.sort()
        key, text = (row >> _32).astype(np.uint32), row.astype(np.uint32)
        del row
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        later = np.repeat(edge[1:], np.diff(edge)) - np.arange(len(key)) - 1
        # every place of a text, text after text, with the later places of its list
        place = np.argsort(text, kind="stable")
        place = place[later[place] > 0]
        whose, upto = text[place], np.cumsum(later[place])
        out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        a = 0
        while a < len(place):
            b = max(int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")), a + 1)
            if b < len(place):  # a text's places stay together
                b = int(np.searchsorted(whose, whose[b], "left")) if whose[b] != whose[a] else int(np.searchsorted(whose, whose[a], "right"))
            p = place[a:b]
            times = later[p]
            other = text[np.repeat(p + 1 - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())]
            pair = np.repeat(text[p], times).astype(np.uint64) << _32 | other
            pair.sort()
            first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            pair = pair[first[np.diff(np.r_[first, len(pair)]) >= hits]]
            x, y = (pair >> _32).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
            m, n = sizes[x], sizes[y]
            ok = (np.minimum(m, n) >= plan.t * np.maximum(m, n) - 1e-6) & (ids[x] != ids[y])
            x, y = ids[x[ok]], ids[y[ok]]
            out_a.append(np.minimum(x, y))
            out_b.append(np.maximum(x, y))
            a = b
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return run


def _verify(threshold: float, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([x.decode("utf-8", "surrogateescape") for x in batch.column(i).to_pylist()] for i in (2, 3))
            known: dict[str, set] = {}
            sims = []
            for x, y in zip(left, right):
                if len(known) > 500:
                    known.clear()
                for t in (x, y):
                    if t not in known:
                        known[t] = {t[i : i + n] for i in range(max(len(t) - n + 1, 1))}
                both = len(known[x] & known[y])
                sims.append(both / (len(known[x]) + len(known[y]) - both))
            sims = np.asarray(sims, np.float64)
            keep = pa.array(sims >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(sims).filter(keep)], names=["a", "b", "similarity"])

    return run


def ngram_pairs(docs: DataFrame, key: str, text: str, threshold: float, n: int) -> DataFrame:
    """(a, b, similarity): pairs a < b of texts whose sets of character n-grams have a Jaccard similarity of at least threshold, exactly.

    key must be a unique whole number and the threshold at least LEAST; rows with a null key or text
    are left out. Copies of a text (equal by 64 bits) have pairs only through the least of their keys.
    """
    if threshold < LEAST:
        raise ValueError(f"threshold must be at least {LEAST}")
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("t"), F.xxhash64(text).alias("copy")).where("id is not null and t is not null")
    plan = Plan(threshold, n, min(BUCKETS[1], max(BUCKETS[0], ceil(docs.count() / FEW_TEXTS * BUCKETS[0]))))
    counted = d.mapInArrow(_count(plan), "slice int, blob binary").groupBy("slice").applyInArrow(_added, "slice int, often binary")
    slices = sorted(counted.collect())  # SLICES rows of a table of fixed size
    packed = zlib.compress(b"".join(zlib.decompress(bytes(s.often)) for s in slices) or bytes(1 << COUNTERS), 1)
    pairs = cut(d.mapInArrow(_send(plan, packed), "bucket int, blob binary").groupBy("bucket").applyInArrow(_meet(plan), "a long, b long").distinct())
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    if wanted.count() <= BROADCAST_ROWS:  # a checked size: the texts then stay where they are read
        wanted = F.broadcast(wanted)
    some = cut(d.join(wanted, "id", "left_semi").select("id", "t"))
    met = pairs.join(some.select(F.col("id").alias("a"), F.col("t").alias("x")), "a").join(some.select(F.col("id").alias("b"), F.col("t").alias("y")), "b")
    return met.select("a", "b", "x", "y").mapInArrow(_verify(threshold, n), "a long, b long, similarity double")
