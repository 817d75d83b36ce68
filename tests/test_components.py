import random

from millrace.operators.components import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_random_graphs_and_long_chains(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, x) for x in range(5001, 5200)]
    df = spark.createDataFrame([(a, b, "extra") for a, b in edges], "a bigint, b bigint, root string")
    got = {x.node: x.root for x in connected_components(df).collect()}
    want = {k: v for k, v in brute([(a, b) for a, b in edges if a != b]).items()}
    assert got == want


def test_nulls_loops_repeats_and_nothing(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 3), (4, 5), (5, 4), (4, 5)], "a bigint, b bigint")
    assert {(x.node, x.root) for x in connected_components(df).collect()} == {(4, 4), (5, 4)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
