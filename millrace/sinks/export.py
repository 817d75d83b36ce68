"""Graph exports: node projections, JSON, GraphML, bulk-import CSV, Turtle, Cytoscape, and batched upload."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sinks.manifests import write_small

# What each kind of node may carry.
ALLOWED = {
    "Document": ("id", "name", "type", "title", "chunk_count", "source"),
    "Chunk": ("id", "name", "type", "text", "tokenCount", "index"),
    "": ("id", "name", "type", "aliases", "description", "importanceScore", "confidenceScore"),
}


def project_nodes(nodes: DataFrame) -> dict[str, DataFrame]:
    """Documents, chunks and entities with the properties they may carry; missing ones are left out."""
    out = {}
    for kind, allowed in ALLOWED.items():
        own = nodes.where(F.col("type") == kind) if kind else nodes.where(~F.coalesce(F.col("type"), F.lit("")).isin("Document", "Chunk"))
        out[kind or "Entity"] = own.select(*[c for c in allowed if c in nodes.columns])
    return out


def to_json(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """JSON lines of nodes and of links below a folder: files of any size, written by all tasks."""
    for kind, d in project_nodes(nodes).items():
        d.write.mode("overwrite").json(os.path.join(path, f"nodes/{kind}"))
    edges.select(F.col("subject").alias("source"), F.col("object").alias("target"), *[c for c in edges.columns if c not in ("subject", "object")]).write.mode("overwrite").json(os.path.join(path, "links"))


def to_csv(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Bulk-import tables: a row a node, a row a predicate of an edge with its type in capitals."""
    nodes.select(F.col("id").alias("id:ID"), "name", "type", F.col("type").alias(":LABEL")).write.mode("overwrite").csv(os.path.join(path, "nodes"), header=True, escape='"')
    rel = edges.select(F.col("subject").alias(":START_ID"), F.col("object").alias(":END_ID"), F.explode("predicates").alias("p"), F.array_join("source_chunk_ids", ";").alias("source_chunk_ids"))
    rel.select(":START_ID", ":END_ID", F.upper("p").alias(":TYPE"), "source_chunk_ids").write.mode("overwrite").csv(os.path.join(path, "relationships"), header=True, escape='"')


def turtle_lines(edges: DataFrame) -> DataFrame:
    """(value): a triple a line; blanks become underscores, quotes go."""
    iri = lambda c: F.regexp_replace(F.regexp_replace(c, r"\s+", "_"), "[\"'<>]", "")
    return edges.select(iri("subject").alias("s"), iri("object").alias("o"), F.explode("predicates").alias("p")).select(F.concat(F.lit("ent:"), "s", F.lit(" kg:"), iri("p"), F.lit(" ent:"), "o", F.lit(" .")).alias("value"))


def to_turtle(edges: DataFrame, path: str) -> None:
    """Turtle lines below a folder."""
    turtle_lines(edges).write.mode("overwrite").text(path)


def cytoscape_elements(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(value): a JSON element a line; an edge's label is its first predicate."""
    n = nodes.select(F.to_json(F.struct(F.struct("id", F.col("name").alias("label"), "type").alias("data"))).alias("value"))
    e = edges.select(F.to_json(F.struct(F.struct(F.col("subject").alias("source"), F.col("object").alias("target"), F.get("predicates", F.lit(0)).alias("label")).alias("data"))).alias("value"))
    return n.union(e)


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(value): a GraphML element a line; lists as JSON, nulls empty. Header and footer are the file's."""

    def run(kind: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for row in b.to_dict("records"):
                    data = "".join(f'<data key="{k}">{escape("" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=lambda x: list(x)))}</data>' for k, v in row.items() if k not in ("id", "subject", "object"))
                    out.append(f"<node id={quoteattr(row['id'])}>{data}</node>" if kind == "n" else f"<edge source={quoteattr(row['subject'])} target={quoteattr(row['object'])}>{data}</edge>")
                yield pd.DataFrame({"value": out})

        return go

    return nodes.mapInPandas(run("n"), "value string").union(edges.mapInPandas(run("e"), "value string"))


def to_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """GraphML parts below a folder, with header and footer as the first and last part by name."""
    graphml_lines(nodes, edges).write.mode("overwrite").text(path)
    keys = sorted({*nodes.columns, *edges.columns} - {"id", "subject", "object"})
    head = "".join(f'<key id="{k}" for="all" attr.name="{k}" attr.type="string"/>' for k in keys)
    write_small(nodes.sparkSession, f"{path}/header.xml", f'<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">{head}<graph edgedefault="directed">\n')
    write_small(nodes.sparkSession, f"{path}/trailer.xml", "</graph></graphml>\n")


WRITERS = {"json": to_json, "graphml": to_graphml, "neo4j_csv": to_csv, "rdf": lambda n, e, p: to_turtle(e, p), "cytoscape": lambda n, e, p: cytoscape_elements(n, e).write.mode("overwrite").text(p)}


def export(nodes: DataFrame, edges: DataFrame, path: str, formats: list[str]) -> list[str]:
    """Writes each known format below path and gives the names of unknown ones."""
    for f in formats:
        if f in WRITERS:
            WRITERS[f](nodes, edges, os.path.join(path, f))
    return [f for f in formats if f not in WRITERS]


def upload(edges: DataFrame, send: Callable[[list[dict]], None], batch: int = 500) -> DataFrame:
    """(sent): relations (subject, predicate, object, evidence, chunks) sent in batches by an injected writer; the number a partition sent.

    Equal relations are aggregated before they are sent, so a retry after a lost executor repeats merges, not rows.
    """
    rel = edges.select("subject", "object", F.explode("predicates").alias("predicate"), "source_texts", "source_chunk_ids")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for b in batches:
            rows = b.to_dict("records")
            for i in range(0, len(rows), batch):
                send(rows[i : i + batch])
            n += len(rows)
        yield pd.DataFrame({"sent": [n]})

    return rel.mapInPandas(run, "sent long")


def publish(write: Callable[[str], None], path: str, state: str, resume: bool = False) -> str:
    """Writes into a staging folder and renames it once whole: "published", or "kept" where it already stands.

    A published path is never overwritten. An unfinished staging folder is only taken over when resume is
    set and it was made by the same state. For folders of a POSIX file system.
    """
    if os.path.exists(path):
        with open(os.path.join(path, "STATE"), encoding="utf-8") as f:
            if f.read() != state:
                raise FileExistsError(f"{path} holds another state")
        return "kept"
    stage = f"{path}.staging"
    if os.path.exists(stage):
        mark = os.path.join(stage, "STATE")
        same = os.path.exists(mark) and open(mark, encoding="utf-8").read() == state
        if not (resume and same):
            shutil.rmtree(stage)
    os.makedirs(stage, exist_ok=True)
    with open(os.path.join(stage, "STATE"), "w", encoding="utf-8") as f:
        f.write(state)
    write(stage)
    os.rename(stage, path)
    return "published"
