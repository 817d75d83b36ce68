"""Dataset manifests, scrape outputs and result files: small driver-side records beside Spark writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import file_system


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file through the Hadoop file system, replacing what is there."""
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def config_hash(settings: dict) -> str:
    """SHA-256 of settings as canonical JSON."""
    import hashlib

    return hashlib.sha256(json.dumps(settings, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes, sha256) of all files below a folder, hashed where they are read; names starting with _ or . are left out."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return f.where(~name.rlike(r"^[_.]")).select(F.regexp_replace("path", r"^.*?" + "/".join(["", *folder.rstrip("/").split("/")[-1:]]) + "/", "").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def dataset_manifest(spark: SparkSession, folder: str, counts: dict[str, int], settings: dict) -> dict:
    """Writes manifest.json into the folder: file hashes, counts, settings and their hash; gives it back."""
    files = [r.asDict() for r in file_hashes(spark, folder).where("file <> 'manifest.json'").orderBy("file").collect()]
    body = {"config_hash": config_hash(settings), "counts": counts, "files": files, "settings": settings}
    write_small(spark, f"{folder}/manifest.json", json.dumps(body, ensure_ascii=False, indent=1, sort_keys=True))
    return body


def scrape_outputs(pages: DataFrame, audit: DataFrame, folder: str, fields: dict[str, str]) -> None:
    """Pages as JSON lines, the audit as CSV with a header, and the run's facts as `key: value` lines in manifest.yaml."""
    pages.write.mode("errorifexists").json(f"{folder}/pages")
    audit.write.mode("errorifexists").csv(f"{folder}/audit", header=True)
    write_small(pages.sparkSession, f"{folder}/manifest.yaml", "".join(f"{k}: {json.dumps(v, ensure_ascii=False)}\n" for k, v in fields.items()))


def write_metrics(metrics: DataFrame, path: str, title: str = "Results") -> str:
    """A small table of results as JSON in path.json and as a Markdown table in path.md; gives back the Markdown."""
    rows = [r.asDict() for r in metrics.collect()]
    names = metrics.columns
    table = [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "-|" * len(names), *("| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows)]
    spark = metrics.sparkSession
    write_small(spark, f"{path}.json", json.dumps(rows, ensure_ascii=False, default=str))
    write_small(spark, f"{path}.md", "\n".join(table) + "\n")
    return "\n".join(table)
