import os

import pytest

from millrace.llm.mix import TOKENIZER, mix, pivotal

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer here")
DOCS, TARGETS = "doc_id bigint, source string, text string, id string, p double, copies int", "source string, target_share double, max_repeats int"


def test_pivotal_keeps_the_sum():
    units = [(f"u{i}", 0.37) for i in range(1000)]
    done, held = pivotal(units, 3)
    assert abs(sum(done.values()) + (held[1] if held else 0) - 370) < 1e-6 and set(done.values()) <= {0, 1}
    assert pivotal(units, 3)[0] == done and pivotal(units, 4)[0] != done
    assert pivotal([], 1) == ({}, None) and pivotal([("a", 1.0), ("b", 0.0)], 1) == ({"a": 1, "b": 0}, None)


def test_mean_of_each_unit_is_its_probability():
    n = [0] * 20
    for seed in range(2000):
        done, held = pivotal([(str(i), 0.3) for i in range(20)], seed)
        for k, v in done.items():
            n[int(k)] += v
        if held:
            n[int(held[0])] += held[1]
    assert all(abs(x / 2000 - 0.3) < 0.05 for x in n)


def test_shares_caps_and_repeats(spark):
    rows = [(i, " A" if i % 2 else "a", "word " * (5 + i % 7), "x", 0.1, 1) for i in range(600)] + [(1000 + i, "b", "word " * 6, "x", 0.1, 1) for i in range(20)] + [(2000, None, "word " * 100, "x", 0.1, 1), (2001, "z", None, "x", 0.1, 1)]
    targets = [("a", 0.5, 2), ("B", 0.5, 3), ("none", 0.0, 1), ("gone", 0.1, 9), (None, 0.1, 1), ("a", 0.2, 1)]
    copies, report = mix(spark.createDataFrame(rows, DOCS), spark.createDataFrame(targets, TARGETS), "doc_id", "source", "text")
    c = {r.id: r.copies for r in copies.collect()}
    assert len(c) == 620 and all(c[str(1000 + i)] == 3 for i in range(20)) and max(c[str(i)] for i in range(600)) <= 2
    r = {x.source: x for x in report.collect()}
    assert r["b"].short and r["gone"].short and r["gone"].tokens == 0 and not r["a"].short and not r["none"].short
    assert abs(r["a"].taken - r["a"].wanted) < 0.02 * r["a"].wanted and abs(sum(x.actual_share for x in r.values()) - 1) < 1e-9


def test_empty(spark):
    copies, report = mix(spark.createDataFrame([], DOCS), spark.createDataFrame([("a", 1.0, 1)], TARGETS), "doc_id", "source", "text")
    assert copies.count() == 0 and [(x.source, x.short) for x in report.collect()] == [("a", False)]


def test_null_ids_are_told_apart_by_text(spark):
    from millrace.llm.mix import token_sizes

    df = spark.createDataFrame([(None, "s", "one two"), (None, "s", "two one"), (None, "s", "two one"), (None, "s", None)], "id bigint, source string, text string")
    assert token_sizes(df, "id", "source", "text").select("id").distinct().count() == 3
