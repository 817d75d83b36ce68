"""Graph, raw-document and training-pair readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.graph import STRUCTURAL
from millrace.sources.files import load, read_jsonl

_NODE = "struct<id:string,name:string,type:string,text:string>"
_FORMS = "subject", "predicate", "object", "evidence_sentence", "source_chunk_id"


def read_graph(spark: SparkSession, path: str, domain: bool = False) -> tuple[DataFrame, DataFrame]:
    """(nodes, triples) of a graph file {"graph": {"nodes": [...]}, "triples": [...]}.

    A triple is an object with named fields or an array of at least three; both are read. With domain,
    structural predicates are left out. Triples without three values are dropped; missing fields are empty.
    """
    raw = spark.read.text(path, wholetext=True)
    nodes = raw.select(F.explode(F.from_json("value", f"struct<graph:struct<nodes:array<{_NODE}>>>")["graph"]["nodes"]).alias("n")).select("n.*")
    each = raw.select(F.posexplode(F.from_json("value", "struct<triples:array<string>>")["triples"]).alias("pos", "t"))
    many = F.from_json("t", "array<string>")
    one = F.from_json("t", "struct<" + ",".join(f"{f}:string" for f in _FORMS) + ">")
    is_list = F.ltrim("t").startswith("[")
    cols = [F.when(is_list, F.get(many, F.lit(i))).otherwise(one[f]).alias(f) for i, f in enumerate(_FORMS)]
    t = each.select("pos", *cols).where("subject is not null and predicate is not null and object is not null")
    t = t.withColumns({c: F.coalesce(c, F.lit("")) for c in _FORMS[3:]})
    return nodes, t.where(~F.upper("predicate").isin(*STRUCTURAL)) if domain else t


def chunk_texts(nodes: DataFrame) -> DataFrame:
    """(source, text): the texts of a graph's chunk nodes, blank ones left out."""
    return nodes.where((F.col("type") == "Chunk") & F.col("text").rlike(r"\S")).select(F.col("id").alias("source"), "text")


def raw_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source, text) of text, JSON and JSON-lines files; blank texts and malformed lines are left out."""
    d = load(spark, paths, ("txt", "json", "jsonl"), tolerant=True)
    return d.where(F.col("content").rlike(r"\S")).select(F.col("doc_id").alias("source"), F.col("content").alias("text"))


def read_jsonl_texts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(source, text) of JSON lines whatever the files are called; blank texts and malformed lines are left out."""
    d = read_jsonl(spark, folder, pattern, tolerant=True)
    return d.where(F.col("content").rlike(r"\S")).select(F.col("doc_id").alias("source"), F.col("content").alias("text"))


def read_pairs(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(instruction, response, context, type) of JSON lines; question and answer stand in for instruction and response.

    A malformed line raises if strict, else it is left out.
    """
    kind = "instruction string, response string, question string, answer string, context string, evidence string, type string"
    d = spark.read.schema(kind + ", _bad string").json(path, mode="FAILFAST" if strict else "PERMISSIVE", columnNameOfCorruptRecord="_bad")
    d = d.where("_bad is null") if not strict else d
    return d.select(F.coalesce("instruction", "question").alias("instruction"), F.coalesce("response", "answer").alias("response"), F.coalesce("context", "evidence").alias("context"), "type").where("instruction is not null")


def encyclopedia(articles: DataFrame, count: int, keywords: tuple[str, ...] = (), text: str = "text", title: str = "title", order: str = "id") -> DataFrame:
    """The first `count` articles in order with a text, and with a keyword in the title or the first 2,000 characters if keywords are given."""
    a = articles.where(F.col(text).rlike(r"\S"))
    if keywords:
        a = a.where(F.concat_ws(" ", title, F.substring(text, 1, 2000)).rlike("(?iu)(?:" + "|".join(keywords) + ")"))
    return a.orderBy(order).limit(count)


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, links) in export shape out of stored rows(subject, predicate, object, evidence, chunk): distinct facts, one link a pair."""
    from millrace.operators.graph import first_seen

    once = rows.groupBy("subject", "predicate", "object").agg(F.min("pos").alias("pos"), F.min_by("evidence", "pos").alias("evidence"), F.min_by("chunk", "pos").alias("chunk"))
    links = once.groupBy(F.col("subject").alias("source"), F.col("object").alias("target")).agg(first_seen(F.col("predicate"), F.col("pos")).alias("predicates"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "predicate", "evidence", "chunk"))), lambda r: F.struct(r["predicate"].alias("predicate"), r["evidence"].alias("evidence"), r["chunk"].alias("chunk"))).alias("relations"))
    nodes = once.select(F.col("subject").alias("id")).union(once.select("object")).distinct()
    return nodes, links
