"""A document archive as a history table: versions by canonical id and content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.schemas import ARCHIVE


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The history; an empty one where nothing is stored yet."""
    try:
        return spark.read.schema(ARCHIVE).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], ARCHIVE)
        raise


def latest_versions(history: DataFrame) -> DataFrame:
    """The newest version of each document."""
    return history.groupBy("canonical_id").agg(F.max_by(F.struct(*[c for c in history.columns if c != "canonical_id"]), "version").alias("r")).select("canonical_id", "r.*")


def new_versions(history: DataFrame, batch: DataFrame) -> DataFrame:
    """(canonical_id, version, ..., status) of batch(canonical_id, content): new and replaced documents get a version, unchanged ones none.

    A document given several times counts once (its smallest content). Nulls are dropped.
    """
    b = batch.where("canonical_id is not null and content is not null").groupBy("canonical_id").agg(F.min("content").alias("content")).withColumn("content_hash", F.sha2("content", 256))
    last = latest_versions(history).select("canonical_id", F.col("version").alias("v"), F.col("content_hash").alias("parent_hash"))
    j = b.join(last, "canonical_id", "left")
    status = F.when(F.col("v").isNull(), "new").when(F.col("parent_hash") == F.col("content_hash"), "unchanged").otherwise("replaced")
    return j.select("canonical_id", (F.coalesce("v", F.lit(0)) + F.when(status == "unchanged", 0).otherwise(1)).alias("version"), "content", "content_hash", "parent_hash", F.current_timestamp().alias("stored_at"), status.alias("status"))


def append_versions(history: DataFrame, batch: DataFrame, path: str) -> DataFrame:
    """Writes the new and replaced versions and gives all rows with their status."""
    rows = new_versions(history, batch)
    rows.where("status <> 'unchanged'").drop("status").write.mode("append").parquet(path)
    return rows


def document_history(history: DataFrame) -> DataFrame:
    """Versions with the hash before each, oldest first by canonical id."""
    w = Window.partitionBy("canonical_id").orderBy("version")
    return history.select("canonical_id", "version", "content_hash", F.lag("content_hash").over(w).alias("previous_hash"))
