"""Queries of the training-data problems over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.crosssplit import cross_split, overlap_pairs, overlap_report
from millrace.llm.garbled import damaged_tokens, restored_pages
from millrace.llm.leak import leaked_passages
from millrace.llm.mix import mix
from millrace.llm.names import name_variants
from millrace.llm.neardup import group_pairs, near_duplicates
from millrace.llm.pairs import defective_pairs
from millrace.llm.quality import quality_profiles
from millrace.llm.splits import grouped_splits, related_groups, tied_items
from millrace.llm.visual import look_alikes, visual_forms
from millrace.session import table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "source_documents").select(F.lit("document").alias("record_kind"), F.col("doc_id").alias("key"), F.col("content").alias("text"))
    names = table(spark, sf_dir, "entities").select(F.lit("entity").alias("record_kind"), F.col("node_id").alias("key"), F.col("name").alias("text"))
    return docs.union(names)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of keys whose texts look the same but are stored with other characters."""
    return look_alikes(_texts(spark, sf_dir), "record_kind", "key", "text").select(F.col("kind").alias("record_kind"), "key_a", "key_b")


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form, where that differs from the stored one."""
    return visual_forms(_texts(spark, sf_dir), "text").where("form <> text").select("record_kind", "key", "form").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective question-answer pairs with their defect."""
    items = table(spark, sf_dir, "qa_items").select("item_id", "question", "answer")
    return defective_pairs(items, "item_id", "question", "answer").select(F.col("item").alias("item_id"), "defect")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records most of whose characters aren't natural prose."""
    docs = table(spark, sf_dir, "source_documents").select("doc_id", "content")
    return quality_profiles(docs, "doc_id", "content").where("not is_prose and reasons[0] <> 'blank'").select(F.col("key").alias("doc_id")).distinct()


def p4_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correct figures per record beside the stored ones."""
    docs = table(spark, sf_dir, "source_documents").select("doc_id", "content").distinct()
    p = quality_profiles(docs, "doc_id", "content").select(F.col("key").alias("doc_id"), "char_count", "word_count", F.round("symbol_ratio", 6).alias("symbol_ratio"), F.round("repeated_line_ratio", 6).alias("repeated_line_ratio"))
    audit = table(spark, sf_dir, "source_audit").groupBy("doc_id").agg(F.max(F.struct("audited_at", F.coalesce("word_count", F.lit(-1)).alias("word_count"))).alias("a"))
    return p.join(audit, "doc_id", "left").select(*p.columns, F.col("a.word_count").alias("stored_word_count"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that hold at least half of an item's passage."""
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with shared runs, and how much of question and answer stands on the page."""
    pages, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "eval_items")
    found = leaked_passages(pages, items, "doc_id", "text", "item_id", "passage", "question", "answer")
    return found.select(F.col("page").alias("doc_id"), F.col("item").alias("item_id"), "shared", "runs", "question_part", "answer_part")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that stay below their target with every record used as often as allowed."""
    _, report = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "mix_targets"), "doc_id", "source", "text")
    return report.where("short").select("source")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "mix_targets"), "doc_id", "source", "text")[1]


def p9_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each record is taken."""
    copies = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "mix_targets"), "doc_id", "source", "text")[0]
    return copies.select(F.col("id").cast("long").alias("doc_id"), "source", "copies")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a passage read with the wrong encoding."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return damaged_tokens(docs, "doc_id", "text").select(F.col("page").alias("doc_id")).distinct()


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those pages with their text restored as far as possible."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return restored_pages(docs, "doc_id", "text").select(F.col("page").alias("doc_id"), "restored", "unrestored")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of source records in one near-duplicate group."""
    docs = table(spark, sf_dir, "source_documents").select("pos", "content", "doc_id")
    _, members = near_duplicates(docs, "content", "pos", words=3, threshold=0.5)
    return group_pairs(members, docs, "pos", "doc_id").select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source record with its near-duplicate group and the group's size."""
    docs = table(spark, sf_dir, "source_documents").select("pos", "content", "doc_id")
    _, members = near_duplicates(docs, "content", "pos", words=3, threshold=0.5)
    size = members.groupBy("group").agg(F.count("*").alias("records"), F.countDistinct("class").alias("texts"))
    return members.join(size, "group").select(F.col("row").alias("pos"), F.col("group").alias("group_id"), "records", "texts")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of nodes that stand for one thing."""
    nodes = name_variants(table(spark, sf_dir, "entities")).select("node", "root").distinct()
    big = nodes.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    nodes = nodes.join(big, "root", "left_semi")
    return nodes.select("root", F.col("node").alias("node_id_a")).join(nodes.select("root", F.col("node").alias("node_id_b")), "root").where("node_id_a < node_id_b").select("node_id_a", "node_id_b").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items tied to another one by provenance, with the smallest item of their group."""
    items = table(spark, sf_dir, "qa_items").select("item_id", "_group_id", "source")
    return tied_items(related_groups(items, "item_id", ["_group_id", "source"])).select(F.col("item").alias("item_id"), F.col("root").alias("group_item_id"))


def p6_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item with its group and the split the whole group goes to."""
    items = table(spark, sf_dir, "qa_items").select("item_id", "_group_id", "source", "type")
    shares = {r["split"]: r["share"] for r in table(spark, sf_dir, "split_targets").collect()}
    return grouped_splits(items, "item_id", ["_group_id", "source"], "type", shares).select(F.col("item").alias("item_id"), F.col("root").alias("group_item_id"), "split")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a training and an evaluation item that ask the same with the same answer."""
    items = table(spark, sf_dir, "qa_items").select("item_id", "question", "answer", "split")
    pairs = overlap_pairs(*cross_split(items, "item_id", "question", "answer", "split"))
    return pairs.select(F.least("train_item", "eval_item").alias("item_id_a"), F.greatest("train_item", "eval_item").alias("item_id_b")).distinct()


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked evaluation items per split and source."""
    items = table(spark, sf_dir, "qa_items")
    links, members = cross_split(items, "item_id", "question", "answer", "split")
    return overlap_report(links, members, items, "item_id", "split", "source")


QUERIES = {
    "p1_found": p1_found, "p1_groups": p1_groups, "p5_found": p5_found, "p6_found": p6_found, "p6_splits": p6_splits, "p7_found": p7_found, "p7_report": p7_report,
    "p2_found": p2_found, "p2_forms": p2_forms, "p3_found": p3_found, "p4_found": p4_found, "p4_profiles": p4_profiles, "p8_found": p8_found, "p8_leaks": p8_leaks, "p9_found": p9_found, "p9_report": p9_report, "p9_copies": p9_copies, "p10_found": p10_found, "p10_restored": p10_restored,
}
SQL: dict[str, str] = {
    # sizes in characters: which sources fall short doesn't depend on the tokenizer
    "p9_found": r"""
WITH t AS (SELECT lower(trim(source)) AS source, max(target_share) AS w, max(max_repeats) AS r FROM mix_targets GROUP BY 1),
n AS (SELECT lower(regexp_replace(source, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) AS source, sum(length(text)) AS n FROM documents GROUP BY 1)
SELECT t.source FROM t LEFT JOIN n USING (source) WHERE coalesce(n.n, 0) * t.r < t.w * (SELECT sum(length(text)) FROM documents)""",
    "p6_found": """
WITH RECURSIVE item AS (
  SELECT DISTINCT item_id, lower(nullif(trim(_group_id), '')) AS g, lower(nullif(trim(source), '')) AS s FROM qa_items),
keyed AS (SELECT item_id, 'g' || g AS k FROM item WHERE g IS NOT NULL UNION SELECT item_id, 's' || s FROM item WHERE s IS NOT NULL),
link AS (SELECT DISTINCT a.item_id AS a, b.item_id AS b FROM keyed a JOIN keyed b ON a.k = b.k),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT a AS item_id, min(b) AS group_item_id FROM reach GROUP BY a HAVING count(DISTINCT b) > 1""",
    "p4_profiles": r"""
WITH doc AS (SELECT DISTINCT doc_id, content FROM source_documents WHERE content IS NOT NULL),
line AS (SELECT doc_id, content, list_filter(list_transform(string_split_regex(regexp_replace(content, '\r\n?|[\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n'), lambda x: regexp_replace(x, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')), lambda x: x <> '') AS l FROM doc),
audit AS (SELECT doc_id, max({'t': audited_at, 'w': coalesce(word_count, -1)}) AS a FROM source_audit GROUP BY doc_id)
SELECT line.doc_id, length(content) AS char_count,
  len(regexp_extract_all(content, '[^\s\x{1c}-\x{1f}\x{85}\pZ]+')) AS word_count,
  round(len(regexp_extract_all(content, '[^\pL\pN\s\x{1c}-\x{1f}\x{85}\pZ]')) / greatest(length(content), 1), 6) AS symbol_ratio,
  round(CASE WHEN len(l) > 1 THEN list_max(map_values(list_histogram(l))) / len(l) ELSE 0 END, 6) AS repeated_line_ratio,
  a.w AS stored_word_count
FROM line LEFT JOIN audit ON line.doc_id = audit.doc_id""",
}
