import itertools
import random

import numpy as np

from millrace.functions.fold import words
from millrace.llm.neardup import ENOUGH, LEVELS, _keys, group_pairs, near_duplicates

SCHEMA = "pos bigint, content string, doc_id string, group string, class string, row string"


def _docs(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        base = [r.choice(vocabulary) for _ in range(r.choice((4, 12, 40, 90, 300)))]
        out.append(" ".join(base))
        for _ in range(r.randrange(3)):
            copy = list(base)
            for _ in range(r.randrange(1, max(2, len(base) // 25))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            out.append(" ".join(copy))
    return out


def _sets(t, n):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(texts, n, threshold):
    sets = [_sets(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    return {(f"d{i:04d}", f"d{j:04d}") for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and sets[j] and find(i) == find(j)}


def test_matches_brute_force(spark):
    texts = _docs()
    df = spark.createDataFrame([(i, t, f"d{i:04d}", "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)
    _, members = near_duplicates(df, "content", "pos", words=3, threshold=0.5)
    got = {(r.a, r.b) for r in group_pairs(members, df, "pos", "doc_id").collect()}
    want = brute(texts, 3, 0.5)
    assert len(want) > 20 and got <= want and len(got) >= 0.97 * len(want)


def test_edges(spark):
    rows = [(1, None, "a", None, None, None), (2, "", "b", None, None, None), (3, "  ​ ", "c", None, None, None), (4, "one two", "d", None, None, None), (5, "ONE  two!", "e", None, None, None), (5, "ONE  two!", "e", None, None, None), (None, "one two", "f", None, None, None), (6, "long " * 50_000, "g", None, None, None), (7, "long " * 50_000, "h", None, None, None), (8, "one two", None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    _, members = near_duplicates(df, "content", "pos", words=3, threshold=0.5)
    got = {(r.a, r.b) for r in group_pairs(members, df, "pos", "doc_id").collect()}
    assert got == {("d", "e"), ("g", "h")}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    links, members = near_duplicates(df, "content", "pos")
    assert links.count() == 0 and members.count() == 0


def test_copies_of_a_third_of_all_rows_make_no_pairs(spark):
    texts = ["the same words in every copy of it"] * 400 + _docs(3, 40)
    df = spark.createDataFrame([(i, t, f"d{i}", "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)
    links, members = near_duplicates(df, "content", "pos", words=3, threshold=0.5)
    assert links.count() < 200
    assert members.groupBy("group").count().agg({"count": "max"}).first()[0] == 400


def test_over_256_texts_on_one_template_match_brute_force(spark):
    r = random.Random(4)
    template = " ".join(f"t{i}" for i in range(22))
    texts = [f"{template} " + " ".join(f"o{r.randrange(10**9)}" for _ in range(r.randrange(5, 17))) for _ in range(700)]
    df = spark.createDataFrame([(i, t, f"d{i}", "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)
    links, members = near_duplicates(df, "content", "pos", words=3, threshold=0.5)
    row = {m["class"]: m["row"] for m in members.collect()}
    got = {tuple(sorted((row[x.a], row[x.b]))) for x in links.collect()}
    sets = [_sets(t, 3) for t in texts]
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if 2 * len(sets[i] & sets[j]) >= len(sets[i] | sets[j])}
    assert len(want) > 50_000 and got <= want and len(got) >= 0.999 * len(want)


def test_few_pairs_at_the_threshold_are_missed_at_any_size():
    r = np.random.default_rng(6)
    weight = {level - 1: w for level, _, _, w in LEVELS}
    for n, m in [(n, n) for n in (8, 12, 20, 31, 32, 33, 34, 36, 40, 50, 63, 64, 80, 128)] + [(16, 32), (18, 36), (31, 32), (40, 80)]:
        missed = 0
        for _ in range(300):
            both = -(-(n + m) // 3)
            v = r.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
            a, b = (_keys(np.sort(x)[:128], len(x)) for x in (v[:n], v[n - both :]))
            missed += sum(weight[int(k) & 3] for k in np.intersect1d(a, b)) < ENOUGH
        assert missed <= 9, (n, m, missed)


def test_a_threshold_below_one_half_is_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        near_duplicates(spark.createDataFrame([], SCHEMA), "content", "pos", threshold=0.4)
