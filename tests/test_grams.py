import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import dedup


def _near(seed, alphabet, shortest, longest, families=40):
    """Texts in families of copies with a few changed characters or a lost end, around a similarity of 0.8."""
    r = random.Random(seed)
    texts = []
    for _ in range(families):
        x = "".join(r.choice(alphabet) for _ in range(r.randint(shortest, longest)))
        texts.append(x)
        for _ in range(3):
            y = list(x)
            for _ in range(int(len(y) * r.choice([0, 0.01, 0.02, 0.025, 0.03, 0.04]))):
                y[r.randrange(len(y))] = r.choice(alphabet)
            texts.append("".join(y[: int(len(y) * r.choice([1, 1, 0.9, 0.82, 0.8, 0.79]))]))
    r.shuffle(texts)
    return texts


def _sets(texts):
    return [{t[i : i + 5] for i in range(max(len(t) - 4, 1))} for t in texts]


@pytest.mark.parametrize("alphabet, shortest, longest, threshold", [("ab", 0, 60, 0.8), ("abcdefghijkl", 0, 300, 0.8), ("abcdefghijklmnopqrstuvwxyz é😀", 300, 1500, 0.8), ("abcdefghijklmnopqrstuvwxyz", 50, 700, 0.6)])
def test_ngram_pairs_equal_brute_force(spark, alphabet, shortest, longest, threshold):
    from millrace.operators.grams import ngram_pairs

    texts = list(dict.fromkeys(_near(3, alphabet, shortest, longest)))
    sets = _sets(texts)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold}
    got = ngram_pairs(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t", threshold, 5).collect()
    assert want and {(x.a, x.b) for x in got} == want and len(got) == len(want)


def test_ngram_dedup_keeps_first_without_rows_of_ngrams(spark):
    texts = _near(4, "abcdefghijklmnopqrstuvwxyz ", 300, 1500) + ["", "", "abc", "abc", "x" * 9, "x" * 12, None, None]
    kept, gone = [], set()
    for i, t in enumerate(texts):
        if t is None:
            continue
        s = _sets([t])[0]
        if any(len(s & k) / len(s | k) >= 0.8 for k in kept):
            gone.add(i)
        else:
            kept.append(s)
    folder = spark.conf.get("spark.checkpoint.dir")
    size = lambda: sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names)
    before = size()
    rows = dedup.ngram_dedup(spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3), "id", "t").collect()
    assert len(rows) == len(gone) and {x.id for x in rows} == gone
    # a row of eight bytes an n-gram took over seven bytes a character
    assert size() - before < 4 * sum(len(t) for t in texts if t)


def test_ngram_dedup_other_keys_and_thresholds(spark):
    texts = ["the same few words stand here", "the same few words stand here", "the same few words stand here!", "something else entirely"]
    d = spark.createDataFrame([(f"k{i}", i, t) for i, t in enumerate(texts)], "k string, i long, t string")
    assert {x.id for x in dedup.ngram_dedup(d, "k", "t").collect()} == {"k1", "k2"}
    assert {x.id for x in dedup.ngram_dedup(d, "i", "t", 0.5).collect()} == {1, 2}
    assert dedup.ngram_dedup(d.where(F.lit(False)), "i", "t").count() == 0
