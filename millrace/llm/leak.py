"""Evaluation passages inside training pages: BM25 over an index of the test items, block-max WAND.

The terms of the index are the distinct runs of four consecutive words of each passage, as read. A
page is a query: its runs. An item's weights are scaled by the least score that half of its runs can
reach, so "at least half of the runs" implies a score of one or more, and retrieving everything from
one upwards loses nothing. WAND skips items whose terms can't reach one together, block maxima skip
parts of posting lists; an exact count of shared runs follows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.fold import words
from millrace.functions.runs import WordHasher, run_values

N, K1, B = 4, 1.2, 0.75
#: Items of one index; more items are indexed and searched block by block.
ITEMS = 20_000
POSTINGS = 16
_EPS = 1e-9


class Index:
    """An inverted index of items with BM25 weights, scaled so that the threshold is one."""

    def __init__(self, items: list[tuple[int, str]], share: float) -> None:
        hasher = WordHasher()
        runs = [(i, run_values(h, N)) for i, text in items if len(h := hasher(words(text))) >= N]
        sets = [np.unique(r, return_counts=True) for _, r in runs]
        self.ids = np.asarray([i for i, _ in runs], np.int64)
        self.sizes = np.asarray([len(s) for s, _ in sets], np.int64)
        self.share = share
        if not runs:
            self.terms = np.empty(0, np.uint64)
            return
        length = np.asarray([len(r) for _, r in runs], float)
        term = np.concatenate([s for s, _ in sets])
        tf = np.concatenate([c for _, c in sets]).astype(float)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.terms, at, df = np.unique(term, return_inverse=True, return_counts=True)
        idf = np.log(1 + (len(runs) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / length.mean())
        weight = idf[at] * tf * (K1 + 1) / (tf + norm[owner])
        for i in range(len(sets)):
            own = owner == i if len(sets) < 2 else slice(int(self.sizes[:i].sum()), int(self.sizes[: i + 1].sum()))
            need = math.ceil(share * self.sizes[i] - _EPS)
            weight[own] /= np.sort(weight[own])[:need].sum()
        order = np.lexsort((owner, at))
        self.at = np.searchsorted(at[order], np.arange(len(self.terms) + 1))
        self.owner, self.weight = owner[order], weight[order]
        self.most = np.maximum.reduceat(self.weight, self.at[:-1])
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, values: np.ndarray) -> np.ndarray:
        """The distinct positions in terms of those values that are terms."""
        v = values[self.filter[(values & np.uint64((1 << 20) - 1)).astype(np.int64)]] if len(self.terms) else values[:0]
        at = np.searchsorted(self.terms, v)
        at[at == len(self.terms)] = 0
        return np.unique(at[self.terms[at] == v]) if len(v) else at

    def search(self, terms: np.ndarray) -> list[int]:
        """All items that the terms score with one or more: document-at-a-time, block-max WAND."""
        if self.most[terms].sum() < 1 - _EPS:
            return []
        lists = [(self.owner[self.at[t] : self.at[t + 1]].tolist(), self.weight[self.at[t] : self.at[t + 1]].tolist()) for t in terms.tolist()]
        top = self.most[terms].tolist()
        blocks = [[max(w[i : i + POSTINGS]) for i in range(0, len(w), POSTINGS)] for _, w in lists]
        place = [0] * len(lists)
        live, found = list(range(len(lists))), []
        while live:
            live.sort(key=lambda j: lists[j][0][place[j]])
            bound, pivot = 0.0, None
            for k, j in enumerate(live):
                bound += top[j]
                if bound >= 1 - _EPS:
                    pivot = k
                    break
            if pivot is None:
                break
            item = lists[live[pivot]][0][place[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][0][place[live[pivot + 1]]] == item:
                pivot += 1
            near = 0.0
            for j in live[: pivot + 1]:  # block maxima of the blocks that can hold the item
                at = place[j]
                own = lists[j][0]
                while at < len(own) and own[at] < item:
                    at = min(len(own), (at // POSTINGS + 1) * POSTINGS) if own[min(len(own), (at // POSTINGS + 1) * POSTINGS) - 1] < item else at + 1
                place[j] = at
                if at < len(own) and own[at] == item:
                    near += blocks[j][at // POSTINGS]
            if near >= 1 - _EPS:
                score = sum(lists[j][1][place[j]] for j in live[: pivot + 1] if place[j] < len(lists[j][0]) and lists[j][0][place[j]] == item)
                if score >= 1 - _EPS:
                    found.append(item)
            for j in live[: pivot + 1]:
                if place[j] < len(lists[j][0]) and lists[j][0][place[j]] == item:
                    place[j] += 1
            live = [j for j in live if place[j] < len(lists[j][0])]
        return found


def _search(index: Index, extra: dict[int, tuple[list[str], list[str]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            rows = []
            for page, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words(text)
                if len(ws) < N or not len(index.terms):
                    continue
                terms = index.hits(run_values(hasher(ws), N))
                if not len(terms):
                    continue
                for i in index.search(terms):
                    both = sum(1 for t in terms.tolist() if i in index.owner[index.at[t] : index.at[t + 1]])
                    if both >= index.share * index.sizes[i] - _EPS:
                        item, held = int(index.ids[i]), set(ws)
                        q, a = extra[item]
                        part = lambda x, held=held: sum(w in held for w in x) / len(x) if x else None
                        rows.append((page, item, both, int(index.sizes[i]), part(q), part(a)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=["page", "item", "shared", "runs", "question_part", "answer_part"])

    return run


def leaked_passages(pages: DataFrame, items: DataFrame, page: str, text: str, item: str, passage: str, question: str, answer: str, share: float = 0.5) -> DataFrame:
    """(page, item, shared, runs, question_part, answer_part): pages that hold a passage.

    A row for every page with at least `share` of an item's distinct runs of four words; question_part
    and answer_part are the shares of the item's question and answer words that stand on the page,
    null where there are none. Null or blank pages and passages, passages of fewer than four words and
    null ids are never a case; pages are read whole; extra columns are ignored; repeated item ids count
    as one item (the smallest passage), repeated pages give repeated rows; empty tables give none.
    The index is broadcast: it holds the held-out items only, ITEMS of them at a time.
    """
    spark = pages.sparkSession
    slim = items.select(F.col(item).cast("long").alias("i"), F.col(passage).cast("string").alias("p"), F.col(question).cast("string").alias("q"), F.col(answer).cast("string").alias("a")).where("i is not null and p is not null").groupBy("i").agg(F.min(F.struct("p", "q", "a")).alias("s")).select("i", "s.*")
    n = slim.count()
    blocks = max(1, math.ceil(n / ITEMS))
    source = pages.select(F.col(page).cast("long").alias("page"), F.col(text).cast("string").alias("text")).where("page is not null and text is not null")
    out = None
    for b in range(blocks):
        rows = slim.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).orderBy("i").collect()
        extra = {r["i"]: (words(r["q"]), words(r["a"])) for r in rows}
        shared = spark.sparkContext.broadcast((Index([(r["i"], r["p"]) for r in rows], share), extra))
        part = source.mapInArrow(lambda it, shared=shared: _search(*shared.value)(it), "page long, item long, shared int, runs int, question_part double, answer_part double")
        out = part if out is None else out.union(part)
    return out
