"""Splits that keep related records together: components, then grouped iterative stratification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.components import connected_components
from millrace.session import cut

#: At most this many bundles of small components, and about as many components heavy enough to be placed one by one.
BUNDLES = 4096


def provenance_key(c: str) -> F.Column:
    """A provenance value, trimmed of blanks of any kind, in lower case; null if nothing is left."""
    trimmed = F.regexp_replace(F.col(c).cast("string"), r"^[\s\p{Z}\x{200B}\x{FEFF}]+|[\s\p{Z}\x{200B}\x{FEFF}]+$", "")
    return F.nullif(F.lower(trimmed), F.lit(""))


def related_groups(records: DataFrame, item: str, keys: list[str]) -> DataFrame:
    """(item, root): each record, with the smallest record tied to it through equal keys, directly or not.

    Records meet in a star around the smallest record of each key, so a key that holds a third of all
    rows costs one link a row. Null and blank keys tie nothing; null items are dropped; a record given
    several times counts once; an empty table gives an empty one; extra columns are ignored.
    """
    rows = records.select(F.col(item).alias("item"), *[provenance_key(k).alias(f"k{i}") for i, k in enumerate(keys)]).where("item is not null")
    keyed = rows.select("item", F.explode(F.filter(F.array(*[F.when(F.col(f"k{i}").isNotNull(), F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("key"))) for i in range(len(keys))]), lambda x: x.isNotNull())).alias("x")).select("item", "x.i", "x.key").distinct()
    first = keyed.groupBy("i", "key").agg(F.min("item").alias("first"))
    parts = connected_components(keyed.join(first, ["i", "key"]).select(F.col("item").alias("a"), F.col("first").alias("b")))
    return rows.select("item").distinct().join(parts, F.col("item") == F.col("node"), "left").select("item", F.coalesce("root", "item").alias("root"))


def tied_items(groups: DataFrame) -> DataFrame:
    """(item, root) of groups with at least two records."""
    several = groups.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    return groups.join(several, "root", "left_semi").select("item", "root")


def place(units: list[tuple], shares: dict[str, float]) -> dict:
    """Iterative stratification of weighted units: {unit: split}.

    units: (id, {label: count}). The label with the fewest records still unplaced goes first, its
    largest unit to the split that lacks most of the label, then most records, then by name.
    """
    total = sum(sum(v.values()) for _, v in units)
    labels: dict = {}
    for _, v in units:
        for k, n in v.items():
            labels[k] = labels.get(k, 0) + n
    want = {s: {k: n * share for k, n in labels.items()} for s, share in shares.items()}
    room = {s: total * share for s, share in shares.items()}
    left, out = dict(labels), {}
    by_label: dict = {k: [] for k in labels}
    for u, v in units:
        for k in v:
            by_label[k].append((v[k], sum(v.values()), u))
    content = dict(units)
    for k in by_label:
        by_label[k].sort(key=lambda x: (-x[0], -x[1], str(x[2])))
    while any(n > 0 for n in left.values()):
        label = min((k for k, n in left.items() if n > 0), key=lambda k: (left[k], str(k)))
        for _, size, u in by_label[label]:
            if u in out:
                continue
            s = max(shares, key=lambda s: (want[s][label], room[s], s))
            out[u] = s
            room[s] -= size
            for k, n in content[u].items():
                want[s][k] -= n
                left[k] -= n
        left[label] = 0
    return out


def grouped_splits(records: DataFrame, item: str, keys: list[str], label: str, shares: dict[str, float], bundles: int = BUNDLES) -> DataFrame:
    """(item, root, split): every record's component, and the split all of it goes to.

    Components with more than 1/bundles of all records are units of their own, the others are bundled
    by their rarest label and a hash, at most `bundles` bundles in all: what reaches the driver are
    the label vectors of these units, a number that doesn't grow with the data. Null labels are a
    label of their own; empty tables give an empty result.
    """
    spark = records.sparkSession
    groups = cut(related_groups(records, item, keys))
    labelled = records.select(F.col(item).alias("item"), F.coalesce(F.col(label).cast("string"), F.lit("(none)")).alias("label")).where("item is not null").groupBy("item").agg(F.min("label").alias("label"))
    vector = groups.join(labelled, "item").groupBy("root", "label").agg(F.count("*").alias("n"))
    total, kinds = vector.agg(F.sum("n"), F.countDistinct("label")).first()
    if not total:
        return groups.withColumn("split", F.lit(None).cast("string"))
    overall = vector.groupBy("label").agg(F.sum("n").alias("all"))
    w = Window.partitionBy("root")
    sized = vector.join(overall, "label").withColumn("size", F.sum("n").over(w)).withColumn("rarest", F.min(F.struct("all", "label")).over(w)["label"])
    each = max(1, bundles // kinds)
    unit = F.when(F.col("size") * bundles > total, F.concat(F.lit("c"), F.col("root").cast("string"))).otherwise(F.concat(F.lit("b"), F.pmod(F.xxhash64("root"), F.lit(each)).cast("string"), F.lit(":"), F.col("rarest")))
    sized = cut(sized.select("root", unit.alias("unit"), "label", "n"))
    rows = sized.groupBy("unit", "label").agg(F.sum("n").alias("n")).collect()
    units: dict = {}
    for r in rows:
        units.setdefault(r["unit"], {})[r["label"]] = r["n"]
    chosen = spark.createDataFrame(sorted(place(sorted(units.items()), shares).items()), "unit string, split string")
    return groups.join(sized.select("root", "unit").distinct(), "root").join(F.broadcast(chosen), "unit").select("item", "root", "split")
