"""Session helpers: test tables, the shared checkpoint folder, plan-cutting writes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only where that is unset and all runs in one process, a folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named is None:
        named = sc.getCheckpointDir()
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if named is None:
            named = tempfile.mkdtemp(prefix="millrace-checkpoint-")
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once into the shared folder; later reads survive a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
