"""Documents out of text, JSON, JSON lines and CSV files; each reader gives (content, source, doc_id, metadata)."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("txt", "md", "json", "jsonl", "csv")
_TEXT = ("text", "content", "body")


def file_system(spark: SparkSession, path: str) -> tuple:
    """(Hadoop file system, path) of a path with or without a scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system is a folder."""
    fs, p = file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _rest(m: Column, *used: str) -> Column:
    return F.map_filter(m, lambda k, v: ~k.isin(*used))


def read_text(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One document a file; its path is source and id."""
    d = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=is_folder(spark, path))
    src = F.col("_metadata.file_path")
    return d.select(F.col("value").alias("content"), src.alias("source"), src.alias("doc_id"), F.create_map().cast("map<string,string>").alias("metadata"))


def _from_map(d: DataFrame, keep: Column | None = None) -> DataFrame:
    """Documents out of rows (m map, source, i): text is text or content, the id url, id or path#i."""
    content = F.coalesce(F.nullif(F.element_at("m", "text"), F.lit("")), F.nullif(F.element_at("m", "content"), F.lit("")), F.lit(""))
    key = F.coalesce(F.nullif(F.element_at("m", "url"), F.lit("")), F.nullif(F.element_at("m", "id"), F.lit("")), F.concat("source", F.lit("#"), F.col("i").cast("string")))
    meta = _rest(F.col("m"), "text", "content", "id")
    return d.select(content.alias("content"), "source", key.alias("doc_id"), (meta if keep is None else F.when(keep, meta).otherwise(F.create_map().cast("map<string,string>"))).alias("metadata"))


def read_json(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """An array gives a document an item, an object one document without metadata; malformed files raise."""
    d = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=is_folder(spark, path)).select("value", F.col("_metadata.file_path").alias("source"))
    array = F.ltrim("value").startswith("[")
    rows = F.when(array, F.from_json("value", "array<map<string,string>>", {"mode": "FAILFAST"})).otherwise(F.array(F.from_json(F.when(~array, F.col("value")), "map<string,string>", {"mode": "FAILFAST"})))
    return _from_map(d.select("source", array.alias("a"), F.posexplode(rows).alias("i", "m")), F.col("a"))


def read_jsonl(spark: SparkSession, path: str, pattern: str = "*.jsonl", tolerant: bool = False) -> DataFrame:
    """A document a non-blank line; a malformed line raises, or is skipped if tolerant; upload_date defaults to ''."""
    d = spark.read.text(path, pathGlobFilter=pattern, recursiveFileLookup=is_folder(spark, path)).select("value", F.col("_metadata.file_path").alias("source")).where(F.trim("value") != "")
    m = F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE" if tolerant else "FAILFAST"})
    d = d.select("source", m.alias("m"), F.xxhash64("value").alias("i"))
    if tolerant:
        d = d.where("m is not null")
    out = _from_map(d)
    return out.withColumn("metadata", F.when(F.map_contains_key("metadata", "upload_date"), F.col("metadata")).otherwise(F.map_concat("metadata", F.create_map(F.lit("upload_date"), F.lit("")))))


def read_csv(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """A document a row; the text is the first column named text, content or body in any case, else the first one."""
    d = spark.read.csv(path, header=True, multiLine=True, escape='"', pathGlobFilter=pattern, recursiveFileLookup=is_folder(spark, path))
    names = d.columns
    text = next((c for c in names if c.lower() in _TEXT), names[0])
    src = F.col("_metadata.file_path")
    m = F.create_map(*[x for c in names if c != text for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]) if len(names) > 1 else F.create_map().cast("map<string,string>")
    return d.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"), src.alias("source"), F.concat(src, F.lit("#"), F.xxhash64(*[f"`{c}`" for c in names]).cast("string")).alias("doc_id"), m.alias("metadata"))


READERS = {"txt": read_text, "md": read_text, "json": read_json, "jsonl": read_jsonl, "csv": read_csv}


def load(spark: SparkSession, paths: list[str], formats: tuple[str, ...] = FORMATS, tolerant: bool = False) -> DataFrame:
    """All documents below the paths with a position; folders are walked by format, files loaded whatever the formats say.

    Unknown suffixes give nothing; tolerant skips malformed JSON lines. The position is the rank by source and id, not the order of files.
    """
    parts = []
    for p in paths:
        kinds = formats if is_folder(spark, p) else [os.path.splitext(p)[1].lstrip(".").lower()]
        parts += [READERS[k](spark, p, f"*.{k}", **({"tolerant": True} if tolerant and k == "jsonl" else {})) for k in kinds if k in READERS]
    if not parts:
        return spark.createDataFrame([], "content string, source string, doc_id string, metadata map<string,string>, pos bigint")
    d = reduce(DataFrame.unionByName, parts)
    return number(d, "source", "doc_id", "content")


def number(d: DataFrame, *order: str) -> DataFrame:
    """With pos, 0 to n - 1 in the given order, without a single task that sorts everything: ranges, then ranks within each."""
    from pyspark.sql import Window

    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = d.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
    r = r.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    size = r.groupBy("_p").agg(F.count("*").alias("_n"))
    base = size.select(F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return r.join(F.broadcast(base), F.col("_p") == F.col("_q")).withColumn("pos", F.col("_b") + F.col("_r") - 1).drop("_p", "_q", "_r", "_n", "_b")
