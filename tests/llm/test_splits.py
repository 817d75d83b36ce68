from millrace.llm.splits import grouped_splits, place, related_groups, tied_items

SCHEMA = "item_id bigint, _group_id string, source string, type string, root string, item string, k0 string"


def test_groups(spark):
    rows = [(1, "A ", None, "x", "", "", ""), (2, " a", "s", "x", "", "", ""), (3, None, "S ", "x", "", "", ""), (4, "", "  ", "x", "", "", ""), (5, None, None, "x", "", "", ""), (5, None, None, "x", "", "", ""), (None, "a", "s", "x", "", "", ""), (6, "b", "t", None, "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    g = related_groups(df, "item_id", ["_group_id", "source"])
    assert {(r.item, r.root) for r in tied_items(g).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert g.count() == 6
    assert related_groups(df.limit(0), "item_id", ["_group_id", "source"]).count() == 0


def test_splits_keep_groups_and_reach_shares(spark):
    rows = [(i, f"g{i // 3}", "hot" if i % 3 == 0 and i < 900 else None, "a" if i % 7 else "b", "", "", "") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = grouped_splits(df, "item_id", ["_group_id", "source"], "type", {"train": 0.8, "validation": 0.1, "test": 0.1})
    pdf = out.toPandas()
    assert len(pdf) == 3000 and pdf.groupby("root").split.nunique().max() == 1
    share = pdf.split.value_counts(normalize=True)
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.02
    rare = pdf[pdf.item % 7 == 0].split.value_counts(normalize=True)
    assert abs(rare["train"] - 0.8) < 0.05


def test_empty(spark):
    out = grouped_splits(spark.createDataFrame([], SCHEMA), "item_id", ["_group_id", "source"], "type", {"train": 1.0})
    assert out.count() == 0


def test_placing_is_deterministic_and_prefers_rare_labels():
    units = [("a", {"x": 5}), ("b", {"x": 5, "y": 1}), ("c", {"y": 1}), ("d", {"x": 2})]
    got = place(units, {"train": 0.5, "test": 0.5})
    assert got == place(list(units), {"train": 0.5, "test": 0.5}) and got["b"] != got["c"] and set(got) == {"a", "b", "c", "d"}


def test_a_unit_goes_where_its_rarest_label_is_needed_most():
    got = place([("big", {"x": 60}), ("r1", {"y": 2, "x": 1}), ("r2", {"y": 2}), ("s", {"x": 37})], {"train": 0.5, "test": 0.5})
    assert got["r1"] != got["r2"] and got["big"] != got["s"]


def test_a_third_of_all_rows_in_one_group_reaches_the_shares(spark):
    rows = [(i, "hot" if i < 1000 else f"g{i // 2}", None, "ab"[i % 2], "", "", "") for i in range(3000)]
    out = grouped_splits(spark.createDataFrame(rows, SCHEMA), "item_id", ["_group_id", "source"], "type", {"train": 0.8, "validation": 0.1, "test": 0.1}).toPandas()
    share = out.split.value_counts(normalize=True)
    assert out[out.item < 1000].split.unique().tolist() == ["train"] and abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.02
