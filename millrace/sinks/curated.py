"""Curated corpora: a validated manifest, audit tables, records, and their report."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import MANIFEST

REQUIRED, LANGUAGES = ("dataset_name", "version", "license", "source"), ("en", "vi")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row out of a JSON or YAML manifest; blank required fields or an unknown language raise."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        data = yaml.safe_load(raw) or {}
    else:
        data = json.loads(raw)
    missing = [k for k in REQUIRED if not str(data.get(k) or "").strip()]
    if missing:
        raise ValueError(f"manifest lacks {', '.join(missing)}")
    language = data.get("language", "en")
    if language not in LANGUAGES:
        raise ValueError(f"unknown language {language}")
    row = tuple(str(data[k]).strip() for k in REQUIRED) + (language, data.get("collection_date"))
    return spark.createDataFrame([row], MANIFEST)


def configuration_hash(settings: dict) -> str:
    """A digest of settings that doesn't depend on the order of keys."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def write_curated(records: DataFrame, audit: DataFrame, matches: DataFrame, path: str) -> None:
    """records as JSON lines in order of parent and segment, audit and matches as CSV with arrays joined by semicolons."""
    records.repartitionByRange("parent_id", "segment").sortWithinPartitions("parent_id", "segment").write.mode("overwrite").json(os.path.join(path, "curated"))
    for name, d in (("audit", audit), ("duplicate_matches", matches)):
        flat = d.select(*[F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in d.dtypes])
        flat.write.mode("overwrite").csv(os.path.join(path, name), header=True, escape='"')


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, sha256) of the files below a folder."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return d.select(F.regexp_replace("path", "^.*/", "").alias("file"), "length", F.sha2("content", 256).alias("sha256"))
