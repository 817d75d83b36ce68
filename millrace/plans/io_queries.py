"""Queries of sources and sinks: round trips through files, link tables, archives and export forms, with their SQL."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import graph
from millrace.plans.graph_queries import _ENT, _G, _TRI, _entities, _graph, _triples  # noqa: F401
from millrace.sinks import export
from millrace.sources import archive, files, web
from millrace.session import scratch, table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").where("content is not null and doc_id is not null").groupBy("doc_id").agg(F.min("content").alias("content"), F.min(F.element_at("metadata", "title")).alias("title"))


def jsonl_source(spark, sf_dir):
    """Records written as JSON lines and read back by the strict reader."""
    path = scratch(spark, "jsonl")
    _docs(spark, sf_dir).select(F.to_json(F.struct(F.col("content").alias("text"), F.col("doc_id").alias("id"), "title")).alias("value")).write.text(path)
    d = files.read_jsonl(spark, path, "part-*")
    return d.select("doc_id", F.md5("content").alias("md5"), F.element_at("metadata", "title").alias("title"))


def csv_source(spark, sf_dir):
    """Records written as CSV with line breaks and quotes, and read back."""
    path = scratch(spark, "csv")
    _docs(spark, sf_dir).where(T.strip(F.col("content")) != "").select("doc_id", F.regexp_replace("content", "\r\n?", "\n").alias("Text")).write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    d = files.read_csv(spark, path, "part-*")
    return d.select(F.element_at("metadata", "doc_id").alias("doc_id"), F.length("content").alias("n"))


def text_source(spark, sf_dir):
    """Entity names as one file a label, read back whole."""
    path = scratch(spark, "text")
    e = _entities(spark, sf_dir).where("type is not null and name is not null")
    e.select("type", F.regexp_replace("name", r"[\r\n]+", " ").alias("value")).repartition(1, "type").write.partitionBy("type").text(path)
    d = files.read_text(spark, path, "part-*")
    return d.select(F.regexp_extract("source", "type=([A-Z_]+)/", 1).alias("type"), (F.size(F.split("content", "\n")) - 1).cast("long").alias("names"))


def sitemap(spark, sf_dir):
    """Addresses of pages through sitemaps of a hundred each, each address once."""
    u = table(spark, sf_dir, "documents").where("url is not null").select("url", F.pmod(F.xxhash64("url"), F.lit(97)).alias("b"))
    maps = u.groupBy("b").agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(F.concat(F.lit("<url><loc>"), "url", F.lit("</loc></url>"))), ""), F.lit("</urlset>")).alias("xml"))
    return web.sitemap_urls(maps, "xml")


def crawl_depths(spark, sf_dir):
    """Pages of a host linked in order of address, crawled three steps from the first of each."""
    u = table(spark, sf_dir, "documents").where("url is not null").select("url", F.parse_url("url", F.lit("HOST")).alias("h")).distinct()
    first = u.groupBy("h").agg(F.min("url").alias("url"))
    links = graph.next_edges(u, "h", "url", "url").select(F.col("subject").alias("source"), F.col("object").alias("target"))
    return web.crawl(links, first, 3)


def archive_versions(spark, sf_dir):
    """The records stored, then stored again with every third changed."""
    path = scratch(spark, "archive")
    d = _docs(spark, sf_dir).select(F.col("doc_id").alias("canonical_id"), "content")
    archive.append_versions(archive.read_archive(spark, path), d, path).count()
    h = archive.read_archive(spark, path)
    again = d.withColumn("content", F.when(F.length("content") % 3 == 0, F.concat("content", F.lit("+"))).otherwise(F.col("content")))
    return archive.new_versions(h, again).select("canonical_id", F.col("version").cast("long").alias("version"), "status")


def turtle(spark, sf_dir):
    return export.turtle_lines(_graph(spark, sf_dir)[1])


def cytoscape(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return export.cytoscape_elements(n, e)


def graphml(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return export.graphml_lines(n, e.select("subject", "object", "predicates", "weight"))


def bulk_relationships(spark, sf_dir):
    """A row a predicate of an edge, its type in capitals, through the CSV files."""
    n, e, *_ = _graph(spark, sf_dir)
    path = scratch(spark, "bulk")
    export.to_csv(n, e, path)
    d = spark.read.csv(os.path.join(path, "relationships"), header=True, escape='"')
    return d.select(F.col(":START_ID").alias("start_id"), F.col(":END_ID").alias("end_id"), F.col(":TYPE").alias("type"))


def node_projections(spark, sf_dir):
    n, *_ = _graph(spark, sf_dir)
    return export.project_nodes(n)["Entity"]


def numbered_documents(spark, sf_dir):
    """Positions 0 to n - 1 in order of key."""
    return files.number(_docs(spark, sf_dir).select("doc_id"), "doc_id").select("doc_id", F.col("pos").cast("long").alias("pos"))


def upload_rows(spark, sf_dir):
    """Relations sent by a writer that only counts."""
    return export.upload(_graph(spark, sf_dir)[1], lambda rows: None).agg(F.sum("sent").alias("sent"))


NAMES = "jsonl_source csv_source text_source sitemap crawl_depths archive_versions turtle cytoscape graphml bulk_relationships node_projections numbered_documents upload_rows".split()
QUERIES = {n: globals()[n] for n in NAMES}
_D = "d AS (SELECT doc_id, min(content) AS content, min(metadata['title']) AS title FROM source_documents WHERE content IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id)"
_IRI = r"regexp_replace(regexp_replace({}, '\s+', '_', 'g'), '[\"''<>]', '', 'g')"
def _xml(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


SQL: dict[str, str] = {
    "jsonl_source": f"WITH {_D} SELECT doc_id, md5(content) AS md5, title FROM d",
    "csv_source": rf"WITH {_D} SELECT doc_id, length(regexp_replace(content, '\r\n?', chr(10), 'g')) AS n FROM d WHERE regexp_replace(content, '^{T.WS}+|{T.WS}+$', '', 'g') <> ''",
    "text_source": f"WITH {_ENT} SELECT type, count(*) AS names FROM ent WHERE type IS NOT NULL AND name IS NOT NULL GROUP BY type",
    "sitemap": "SELECT DISTINCT trim(url) AS url FROM documents WHERE url IS NOT NULL",
    "crawl_depths": "WITH u AS (SELECT DISTINCT url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS h FROM documents WHERE url IS NOT NULL) SELECT url, depth FROM (SELECT url, (row_number() OVER (PARTITION BY h ORDER BY url) - 1)::INT AS depth FROM u) WHERE depth <= 3",
    "archive_versions": f"WITH {_D} SELECT doc_id AS canonical_id, CASE WHEN length(content) % 3 = 0 THEN 2 ELSE 1 END AS version, CASE WHEN length(content) % 3 = 0 THEN 'replaced' ELSE 'unchanged' END AS status FROM d",
    "turtle": f"WITH {_TRI} SELECT 'ent:' || {_IRI.format('subject')} || ' kg:' || {_IRI.format('predicate')} || ' ent:' || {_IRI.format('object')} || ' .' AS value FROM (SELECT DISTINCT subject, predicate, object FROM tri)",
    "bulk_relationships": f"WITH {_TRI} SELECT subject AS start_id, object AS end_id, upper(predicate) AS type FROM (SELECT DISTINCT subject, predicate, object FROM tri)",
    "node_projections": f"{_G} SELECT id, name, type FROM node WHERE coalesce(type, '') NOT IN ('Document', 'Chunk')",
    "numbered_documents": f"WITH {_D} SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM d",
    "upload_rows": f"WITH {_TRI} SELECT count(*) AS sent FROM (SELECT DISTINCT subject, object, predicate FROM tri)",
    "cytoscape": f"""{_G}, lab AS (SELECT subject, object, arg_min(predicate, pos) AS label FROM tri GROUP BY 1, 2)
SELECT '{{"data":{{' || concat_ws(',', '"id":' || to_json(id), '"label":' || to_json(name), '"type":' || to_json(type)) || '}}}}' AS value FROM node
UNION ALL SELECT '{{"data":{{' || concat_ws(',', '"source":' || to_json(subject), '"target":' || to_json(object), '"label":' || to_json(label)) || '}}}}' FROM lab""",
    "graphml": f"""{_G}, lab AS (SELECT subject, object, list(predicate ORDER BY p) AS ps FROM (SELECT subject, object, predicate, min(pos) AS p FROM tri GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT '<node id="' || id || '"><data key="name">' || coalesce({_xml('name')}, '') || '</data><data key="type">' || coalesce({_xml('type')}, '') || '</data></node>' AS value FROM node
UNION ALL SELECT '<edge source="' || subject || '" target="' || object || '"><data key="predicates">["' || array_to_string(ps, '", "') || '"]</data><data key="weight">' || len(ps) || '</data></edge>' FROM lab""",
}
