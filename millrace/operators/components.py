"""Connected components of a link table as an iterative DataFrame job.

Alternating large-star and small-star contraction (Kiveris et al., 2014): every round is two
shuffles over the remaining links, and the number of rounds grows with the logarithm of the
longest chain, not with its length. Nothing is collected but one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): each node that has a link, with the smallest node of its component.

    Null ends and self-links are dropped, repeated and reversed links count once, an empty table
    gives an empty one. Columns beside a and b are ignored. Raises if max_rounds don't suffice.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: each node sends its greater neighbours to its least neighbour
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node sends its lesser neighbours, and itself, to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        e = cut(small.where("u <> v").distinct())
        after = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if after == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v")).distinct())
        before = after
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
