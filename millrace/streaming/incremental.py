"""Incremental additions as a stream: an extension, batches of triples merged into a stored edge table.

Each micro-batch replaces the documents it holds: edges lose the chunks of those documents, unsupported
ones go, then the batch's own edges are merged. The table is written as numbered versions; a batch
that is run again after a failure writes the same version, so every batch counts exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.graph import build_edges, normalize_triples
from millrace.schemas import TRIPLES
from millrace.sources.files import file_system


def stored(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The triples of the newest version up to a number; none yet is an empty table."""
    fs, p = file_system(spark, path)
    here = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    done = lambda x: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))
    have = [int(x.getName().split("=")[1]) for x in here if x.getName().startswith("v=") and done(x)]
    best = max((v for v in have if v <= version), default=None)
    return spark.createDataFrame([], TRIPLES) if best is None else spark.read.schema(TRIPLES).parquet(f"{path}/v={best}")


def merge_batch(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored triples without those of the batch's documents, and the batch's own."""
    doc = lambda d: F.substring_index("source_chunk_id", "#", 1)
    names = old.columns
    gone = batch.select(doc(batch).alias("_d")).where("_d is not null").distinct()
    kept = old.withColumn("_d", doc(old)).join(gone, "_d", "left_anti").select(*names)
    return kept.unionByName(batch.select(*names))


def start(source: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs the merge for a stream of triples; with once, over all that is available."""

    def each(batch: DataFrame, epoch: int) -> None:
        out = merge_batch(stored(batch.sparkSession, path, epoch - 1), batch)
        out.write.mode("overwrite").parquet(f"{path}/v={epoch}")

    w = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def current_edges(spark: SparkSession, path: str) -> DataFrame:
    """The edge table of the newest version."""
    return build_edges(normalize_triples(stored(spark, path, 1 << 40)))
