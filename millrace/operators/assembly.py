"""Assembly of a text graph: chunk and document nodes, structural edges, endpoint rewriting, stored-graph upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import evidence_for, evidence_sentences, strip, token_count
from millrace.functions.unicode import stable_ids
from millrace.operators.graph import next_edges

#: Provenance keys that go from a document's metadata to its nodes.
PROVENANCE = ("title", "url", "license", "source_domain", "scraped_at", "crawler", "language", "upload_date")


def _meta(key: str) -> Column:
    return F.nullif(F.element_at("metadata", key), F.lit(""))


def _file_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def located(chunks: DataFrame, document_id: Callable[..., Column] | None = None, chunk_id: Callable[..., Column] | None = None) -> DataFrame:
    """chunks(pos, content, source, doc_id, metadata) with parent_source, parent_doc, parent_id, index and chunk_id.

    The parent is named by metadata parent_source and parent_doc_id, else the chunk is its own parent.
    Ids are stable ids of (parent source, parent document) and (parent id, index and content) unless other
    functions of these columns are given. Null contents have no node.
    """
    document_id, chunk_id = document_id or stable_ids("document"), chunk_id or stable_ids("chunk")
    c = chunks.where("content is not null").withColumns({"parent_source": F.coalesce(_meta("parent_source"), "source"), "parent_doc": F.coalesce(_meta("parent_doc_id"), "doc_id"), "index": F.coalesce(_meta("chunk_index").cast("int"), F.lit(0))})
    c = c.withColumn("parent_id", document_id("parent_source", "parent_doc"))
    return c.withColumn("chunk_id", chunk_id("parent_id", F.concat_ws("\x1f", F.col("index").cast("string"), "content")))


def chunk_nodes(chunks: DataFrame) -> DataFrame:
    """One node a located chunk: id, name, text, token and character counts, the first 200 characters as description, provenance."""
    name = F.coalesce(F.nullif(_file_name(F.col("parent_source")), F.lit("")), F.col("parent_doc"), F.lit("unknown"))
    tokens = F.coalesce(_meta("token_count").cast("int"), token_count(F.col("content")))
    kept = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PROVENANCE) & (strip(v) != ""))
    return chunks.select("pos", F.col("chunk_id").alias("id"), F.concat(name, F.lit(" chunk "), F.col("index").cast("string")).alias("name"), F.lit("Chunk").alias("type"), F.col("content").alias("text"), tokens.alias("token_count"), F.col("index"), F.length("content").alias("char_length"), F.substring("content", 1, 200).alias("description"), "source", "parent_source", kept.alias("provenance"))


def document_nodes(chunks: DataFrame) -> DataFrame:
    """One node a parent, named by the title or file of its first chunk, with the number of chunks that are left."""
    name = F.coalesce(_meta("title"), F.nullif(_file_name(F.col("parent_source")), F.lit("")), F.lit("unknown"))
    g = chunks.groupBy("parent_id").agg(F.min_by(F.struct(name.alias("name"), "parent_source"), "pos").alias("r"), F.count("*").alias("chunk_count"))
    return g.select(F.col("parent_id").alias("id"), "r.name", F.lit("Document").alias("type"), F.col("r.parent_source").alias("source"), F.concat(F.lit("Source document: "), F.coalesce("r.parent_source", F.lit(""))).alias("description"), "chunk_count")


def structural_triples(chunks: DataFrame) -> DataFrame:
    """NEXT between surviving chunks of a parent and PART_OF to it, as (subject, predicate, object, evidence_sentence, source_chunk_id)."""
    following = next_edges(chunks, "parent_id", "pos", "chunk_id").select("subject", F.lit("NEXT").alias("predicate"), "object")
    part = chunks.select(F.col("chunk_id").alias("subject"), F.lit("PART_OF").alias("predicate"), F.col("parent_id").alias("object"))
    return following.unionByName(part).select("subject", "predicate", "object", F.lit("").alias("evidence_sentence"), F.col("subject").alias("source_chunk_id"))


def mention_triples(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """MENTIONS from each chunk to the entities(chunk_id, id, name) found in it, with the first sentence that holds the name."""
    e = entities.select("chunk_id", "id", "name").distinct()
    m = chunks.select("chunk_id", "content").join(e, "chunk_id")
    return m.select(F.col("chunk_id").alias("subject"), F.lit("MENTIONS").alias("predicate"), F.col("id").alias("object"), evidence_for(evidence_sentences(F.col("content")), F.col("name"), F.col("name")).alias("evidence_sentence"), F.col("chunk_id").alias("source_chunk_id"))


def rewrite_ends(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Triples with mapped ends; mapping(id, canonical). Unmapped ends stay, null evidence and chunk become empty."""
    m = mapping.where("id is not null").groupBy("id").agg(F.min("canonical").alias("canonical"))
    for end in ("subject", "object"):
        triples = triples.join(m.select(F.col("id").alias(end), F.col("canonical").alias(f"_{end}")), end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    return triples.withColumns({c: F.coalesce(c, F.lit("")) for c in ("evidence_sentence", "source_chunk_id")})


def upsert_edges(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Edges (subject, object, predicates, source_texts, source_chunk_ids, description, weight) of both tables: arrays take up what is new, weights add up, a new description stays."""
    key, lists = ["subject", "object"], ("predicates", "source_texts", "source_chunk_ids")
    none = F.array().cast("array<string>")
    s, n = (d.select(*key, *[F.col(c).alias(f"{c}{t}") for c in (*lists, "description", "weight")]) for d, t in ((stored, "_s"), (new, "_n")))
    both = s.join(n, key, "full")
    own = [F.array_union(F.coalesce(f"{c}_s", none), F.coalesce(f"{c}_n", none)).alias(c) for c in lists]
    text = F.coalesce(F.nullif("description_n", F.lit("")), "description_s", F.lit("")).alias("description")
    return both.select(*key, *own, text, (F.coalesce("weight_s", F.lit(0)) + F.coalesce("weight_n", F.lit(0))).alias("weight"))


def upsert_nodes(stored: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Nodes of both tables; a new value that isn't null replaces a stored one."""
    rest = [c for c in stored.columns if c != key]
    n = new.select(key, *[F.col(c).alias(f"_{c}") for c in rest])
    return stored.join(n, key, "full").select(key, *[F.coalesce(f"_{c}", c).alias(c) for c in rest])


def without_documents(chunks: DataFrame, triples: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunks, triples) without all chunks of documents(parent_id) and every triple that has one of them, or the document, as an end."""
    gone = documents.select("parent_id").distinct()
    ends = chunks.join(gone, "parent_id", "left_semi").select(F.col("chunk_id").alias("id")).union(gone).distinct()
    left = triples
    for end in ("subject", "object"):
        left = left.join(ends.select(F.col("id").alias(end)), end, "left_anti")
    return chunks.join(gone, "parent_id", "left_anti"), left


def fallback_graph(texts: DataFrame, key: str, text: str, known: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(entities, edges) without any model: runs of capitalised words and known terms, neighbours in a sentence linked.

    entities(key, i, name): distinct in any case, in order of first sight. edges(key, subject, object, evidence)
    link each name of a sentence with the next name, in entity order, that the sentence holds.
    """
    upper, inner = "A-ZÀ-ỸĐ", r"[\wÀ-ỹĐđ]"
    d = texts.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    found = F.regexp_extract_all("t", F.lit(f"(?U)([{upper}]{inner}*(?:\\s+[{upper}]{inner}*)+)"), 1)
    if known:
        found = F.concat(found, F.regexp_extract_all("t", F.lit(r"(?U)\b(" + "|".join(known) + r")\b"), 1))
    names = d.select("k", F.posexplode(F.transform(found, lambda x: F.regexp_replace(x, r"^[ ,.;:()]+|[ ,.;:()]+$", ""))).alias("i", "name")).where("length(name) > 2")
    names = names.groupBy("k", F.lower("name").alias("low")).agg(F.min("i").alias("i"), F.min_by("name", "i").alias("name"))
    s = d.select("k", F.posexplode(F.split("t", r"(?<=[.!?])\s+")).alias("j", "s"))
    hit = s.join(names, "k").where(F.contains(F.lower("s"), F.col("low")))
    w = Window.partitionBy("k", "j").orderBy("i")
    edges = hit.select("k", "j", F.col("name").alias("subject"), F.lead("name").over(w).alias("object"), strip(F.col("s")).alias("evidence")).where("object is not null")
    return names.select(F.col("k").alias(key), "i", "name"), edges.select(F.col("k").alias(key), "j", "subject", "object", "evidence")
