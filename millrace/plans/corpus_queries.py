"""Queries of graph assembly, the dedup family, derived datasets, audits and further sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.unicode import unicode_repair
from millrace.operators import assembly, datasets, dedup, extract, graph, metrics
from millrace.plans import graph_queries as G
from millrace.plans import text_queries
from millrace.session import scratch, table
from millrace.sources import graphs

#: Starts of the path samplers.
STARTS = 200


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that triples were found in: their evidence sentences, line by line, with hash ids."""
    t = table(spark, sf_dir, "triples").where("source_chunk_id is not null and evidence_sentence is not null")
    c = t.groupBy("source_chunk_id").agg(F.min("pos").alias("pos"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "evidence_sentence"))), lambda x: x["evidence_sentence"]), "\n").alias("content"))
    parent = F.substring_index("source_chunk_id", "#", 1)
    meta = F.create_map(F.lit("parent_source"), F.concat(F.lit("files/"), parent), F.lit("parent_doc_id"), parent, F.lit("chunk_index"), F.substring_index("source_chunk_id", "#", -1))
    c = c.select("pos", "content", F.col("source_chunk_id").alias("source"), F.col("source_chunk_id").alias("doc_id"), meta.alias("metadata"))
    ids = lambda *cols: F.sha2(F.concat_ws("\x1f", *cols), 256)
    return assembly.located(c, ids, ids)


def _named_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_chunk_id, id, name): the ends of each chunk's triples."""
    t = table(spark, sf_dir, "triples").where("source_chunk_id is not null")
    ends = t.select("source_chunk_id", F.col("subject").alias("id")).union(t.select("source_chunk_id", "object")).where("id is not null").distinct()
    return ends.join(G._entities(spark, sf_dir).select("id", "name"), "id").where("name is not null")


def chunk_nodes(spark, sf_dir):
    return assembly.chunk_nodes(_chunks(spark, sf_dir)).select("pos", "id", "name", "token_count", "index", "char_length", F.md5("description").alias("description"))


def document_nodes(spark, sf_dir):
    return assembly.document_nodes(_chunks(spark, sf_dir))


def structural_triples(spark, sf_dir):
    return assembly.structural_triples(_chunks(spark, sf_dir)).select("subject", "predicate", "object")


def mention_triples(spark, sf_dir):
    c = _chunks(spark, sf_dir)
    e = _named_ends(spark, sf_dir).join(c.select(F.col("doc_id").alias("source_chunk_id"), "chunk_id"), "source_chunk_id")
    return assembly.mention_triples(c, e).select("subject", "object", "evidence_sentence")


def rewritten_triples(spark, sf_dir):
    """Triples with their ends mapped to the smallest node of the same type and lower-case name."""
    e = G._entities(spark, sf_dir)
    least = e.groupBy("type", F.lower("name").alias("n")).agg(F.min("id").alias("canonical"))
    m = e.select("id", F.coalesce("type", F.lit("")).alias("type"), F.lower("name").alias("n")).join(least.na.fill("", ["type"]), ["type", "n"])
    return assembly.rewrite_ends(table(spark, sf_dir, "triples"), m).select("pos", "subject", "object", "evidence_sentence", "source_chunk_id")


def upserted_edges(spark, sf_dir):
    """The edges of even triples merged into those of odd ones."""
    t = G._triples(spark, sf_dir)
    e = assembly.upsert_edges(graph.build_edges(t.where("pos % 2 = 1")), graph.build_edges(t.where("pos % 2 = 0")))
    return e.select("subject", "object", F.array_join(F.array_sort("predicates"), ";").alias("predicates"), F.size("source_chunk_ids").alias("chunks"), "weight")


def removed_documents(spark, sf_dir):
    """Structural triples left after every document with a single chunk went."""
    c = _chunks(spark, sf_dir)
    gone = assembly.document_nodes(c).where("chunk_count = 1").select(F.col("id").alias("parent_id"))
    return assembly.without_documents(c, assembly.structural_triples(c), gone)[1].select("subject", "predicate", "object")


def fallback_names(spark, sf_dir):
    d = table(spark, sf_dir, "eval_items").select("item_id", "passage")
    return assembly.fallback_graph(d, "item_id", "passage")[0].select("item_id", "name")


def fallback_edges(spark, sf_dir):
    d = table(spark, sf_dir, "eval_items").select("item_id", "passage")
    return assembly.fallback_graph(d, "item_id", "passage")[1].drop("evidence")


def cluster_assignments(spark, sf_dir):
    """Near-duplicate clusters of the records with canonical, by length as quality."""
    d = table(spark, sf_dir, "source_documents").where("content is not null").select("pos", "content")
    r = d.select(F.col("pos").alias("record_id"), F.length("content").cast("double").alias("quality"))
    return dedup.assign_clusters(r, dedup.near_matches(d, "pos", "content")).select("record_id", "cluster_id", "canonical_id", "is_duplicate", F.round("similarity", 6).alias("similarity"))


def deduplicated(spark, sf_dir):
    return dedup.deduplicate(table(spark, sf_dir, "source_documents").where("content is not null").select("pos", "content"), "minhash").select("pos")


def layered_dedup(spark, sf_dir):
    """Pages with a vector, near-duplicates first, what is alike in meaning after that."""
    d = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("pos"), F.col("text").alias("content"))
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), "embedding")
    return dedup.deduplicate(d.join(v, "pos"), "layered", vector="embedding", semantic_threshold=0.42).select("pos")


def semantic_kept(spark, sf_dir):
    return dedup.deduplicate(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), "embedding"), "semantic", vector="embedding", semantic_threshold=0.42).select(F.col("pos").alias("vec_id"))


def semantic_review(spark, sf_dir):
    flags = dedup.semantic_review(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.4)[1]
    return flags.select("record_id", "matched_record_id", F.round("similarity", 4).alias("similarity"))


def _walk(spark, sf_dir):
    n, e, ent, t = G._graph(spark, sf_dir)
    return n, e, n.select("id").distinct().orderBy("id").limit(STARTS), t


def multi_hop_qa(spark, sf_dir):
    n, e, starts, _ = _walk(spark, sf_dir)
    return datasets.multi_hop(e, n, starts).select("nodes", "hops", "question", "answer", "path", "group_id")


def sft_samples(spark, sf_dir):
    n, e, starts, t = _walk(spark, sf_dir)
    return datasets.sft_samples(t, e, starts)


def grouped_sides(spark, sf_dir):
    return datasets.grouped_sides(table(spark, sf_dir, "qa_items"), "_group_id")


def question_validation(spark, sf_dir):
    """Triples of a chunk as the edges of a question about it, in order."""
    t = table(spark, sf_dir, "triples").where("source_chunk_id is not null")
    e = t.where("object is not null").select(F.col("source_chunk_id").alias("subgraph"), F.col("pos").cast("string").alias("id"), F.col("subject").alias("source"), F.col("object").alias("target"))
    used = F.transform(F.sort_array(F.collect_list("pos")), lambda x: x.cast("string"))
    a = t.groupBy("source_chunk_id").agg(used.alias("used"), F.max("evidence_sentence").alias("question"), F.min("evidence_sentence").alias("answer"))
    return datasets.validate_questions(a.select(F.col("source_chunk_id").alias("id"), F.col("source_chunk_id").alias("subgraph"), "question", "answer", "used"), e)


def raw_questions(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null and lang = 'en'").select("doc_id", "text")
    return datasets.raw_questions(d, "doc_id", "text").groupBy("doc_id", "type").agg(F.count("*").alias("n"))


def audit_duplicates(spark, sf_dir):
    e = G._entities(spark, sf_dir).select("id").count()
    return metrics.duplication_audit(e, G.similar_names(spark, sf_dir))


def audit_overall(spark, sf_dir):
    return metrics.overall_health(*[f(spark, sf_dir) for f in (G.audit_orphans, G.audit_density, G.audit_schema, audit_duplicates, G.audit_hops)])


def audit_database(spark, sf_dir):
    n, e, ent, t = G._graph(spark, sf_dir)
    return metrics.database_audit(n, t.select("subject", "predicate", "object"))


def _sft(spark, sf_dir):
    return table(spark, sf_dir, "qa_items").where("question is not null and answer is not null").select(F.col("item_id").alias("id"), F.col("question").alias("instruction"), F.col("answer").alias("response"), F.coalesce("evidence", F.lit("")).alias("context")).distinct()


def sft_overall(spark, sf_dir):
    return metrics.sft_overall(_sft(spark, sf_dir))


def model_ranking(spark, sf_dir):
    """Question types ranked as if each were a model."""
    m = G.answer_metrics(spark, sf_dir)
    return metrics.rank_models(m.unpivot("type", ["accuracy", "hallucination_rate", "consistency", "words"], "metric", "value").select(F.col("type").alias("model"), "metric", "value"))


def scored_pages(spark, sf_dir):
    """Pages that a stand-in scorer, a tenth of a point a character up to ten, gives nine."""
    return extract.scored_pages(table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", "text"), lambda ts: [min(10.0, len(t) / 100) for t in ts], least=9.0)


def listed_urls(spark, sf_dir):
    """Addresses listed in answers made of the pages' own urls."""
    d = table(spark, sf_dir, "documents").where("url is not null")
    a = d.groupBy(F.col("source_domain").alias("seed")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "url"))), lambda x: F.concat(F.lit('"'), x["url"], F.lit('", '), x["url"])), "\n").alias("response")).where("seed is not null")
    return extract.listed_urls(a).select("seed", "url")


def extracted_relations(spark, sf_dir):
    """Relations out of model answers, here made of the stored triples by names, a word of prose around them."""
    t = table(spark, sf_dir, "triples").where("source_chunk_id is not null and object is not null")
    n = G._entities(spark, sf_dir).where("name is not null").select("id", "name")
    t = t.join(n.select(F.col("id").alias("subject"), F.col("name").alias("s")), "subject").join(n.select(F.col("id").alias("object"), F.col("name").alias("o")), "object")
    a = t.select(F.col("pos").alias("chunk_id"), F.concat(F.lit("Here: "), F.to_json(F.struct(F.array(F.struct(F.upper("s").alias("subject"), "predicate", F.col("o").alias("object"), F.lit("").alias("evidence"))).alias("relations")))).alias("response"), F.coalesce("evidence_sentence", F.lit("")).alias("text"))
    ents = t.select(F.col("pos").alias("chunk_id"), F.col("subject").alias("id"), F.col("s").alias("name")).union(t.select("pos", "object", "o"))
    return extract.llm_relations(a, ents, "chunk_id").withColumnRenamed("chunk_id", "pos")


def sentence_relations(spark, sf_dir):
    """Relations of the two ends of a triple that stand in its evidence sentence."""
    t = table(spark, sf_dir, "triples").where("evidence_sentence is not null and object is not null")
    n = G._entities(spark, sf_dir).where("name is not null").select("id", "name", F.coalesce("type", F.lit("ENTITY")).alias("label"))
    ents = t.select("pos", F.col("subject").alias("id")).union(t.select("pos", "object")).join(n, "id")
    return extract.rule_relations(t.select("pos", "evidence_sentence"), ents, "pos", "evidence_sentence")


def graph_file(spark, sf_dir):
    """Triples written into a graph file, objects and arrays by turns, and read back without structural ones."""
    path = scratch(spark, "graph")
    t = table(spark, sf_dir, "triples")
    one = F.to_json(F.struct("subject", "predicate", "object", "evidence_sentence", "source_chunk_id"))
    many = F.to_json(F.array("subject", "predicate", "object"))
    row = t.select("pos", F.when(F.col("pos") % 2 == 0, one).otherwise(many).alias("j"))
    row = row.groupBy(F.pmod("pos", F.lit(8)).alias("part")).agg(F.concat(F.lit('{"graph": {"nodes": []}, "triples": ['), F.array_join(F.collect_list("j"), ","), F.lit("]}")).alias("value"))
    row.select("value").repartition(8).write.text(path)
    return graphs.read_graph(spark, path, domain=True)[1].groupBy("predicate").agg(F.count("*").alias("n"), F.count(F.when(F.col("evidence_sentence") != "", 1)).alias("with_evidence"))


def pair_file(spark, sf_dir):
    """Pairs written as JSON lines, every tenth line broken, and read by the tolerant reader."""
    path = scratch(spark, "pairs")
    q = table(spark, sf_dir, "qa_items").select("item_id", "question", "answer", "type").distinct()
    line = F.to_json(F.struct("question", "answer", "type"))
    q.select(F.when(F.col("item_id") % 10 == 0, F.concat(F.lit("{"), line)).otherwise(line).alias("value")).write.text(path)
    return graphs.read_pairs(spark, path).groupBy("type").agg(F.count("*").alias("n"), F.count("response").alias("answered"))


def raw_documents(spark, sf_dir):
    """Texts written as JSON lines and read as plain source and text."""
    path = scratch(spark, "raw")
    table(spark, sf_dir, "documents").select(F.to_json(F.struct("text", F.col("doc_id").cast("string").alias("id"))).alias("value")).write.text(path)
    d = graphs.read_jsonl_texts(spark, path)
    return d.select("source", F.md5("text").alias("md5"))


def stored_graph(spark, sf_dir):
    """Stored facts rebuilt into links with their relation records."""
    r = table(spark, sf_dir, "triples").where("object is not null").select("pos", "subject", "predicate", "object", F.col("evidence_sentence").alias("evidence"), F.col("source_chunk_id").alias("chunk"))
    return graphs.rebuilt(r)[1].select("source", "target", F.array_join("predicates", ";").alias("predicates"), F.size("relations").alias("relations"))


def encyclopedia(spark, sf_dir):
    """The first hundred pages that mention a river or a mill."""
    return graphs.encyclopedia(table(spark, sf_dir, "documents"), 100, ("river", "mill"), order="doc_id").select("doc_id")


def clean_vietnamese(spark, sf_dir):
    d = T.clean_batch(table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", "text"), "text", "vi")
    return d.select("doc_id", F.md5("text").alias("md5"))


def repeated_marks(spark, sf_dir):
    """Names in capital letters with every accent written twice, repaired."""
    n = table(spark, sf_dir, "entities").where("name is not null").select("name").distinct()
    return n.select("name", unicode_repair(F.concat(F.regexp_replace("name", "e", "é́"), F.lit(" ạ̃̃̃"))).alias("repaired"))


def sentence_spans(spark, sf_dir):
    d = table(spark, sf_dir, "eval_items").where("passage is not null").select("item_id", "passage")
    return d.select("item_id", "passage", F.posexplode(T.sentence_spans(F.col("passage"))).alias("i", "s")).select("item_id", "i", "s.start", "s.end", F.expr("substring(passage, s.start + 1, s.end - s.start)").alias("sentence"))


def routed_pages(spark, sf_dir):
    """The extractor that each page's host calls for."""
    d = table(spark, sf_dir, "documents").where("url is not null")
    return d.select("doc_id", T.routed(F.col("url"), {"gov.example": F.lit("portal"), "org.example": F.lit("article")}, F.lit("general")).alias("extractor"))


NAMES = (
    "chunk_nodes document_nodes structural_triples mention_triples rewritten_triples upserted_edges removed_documents fallback_names fallback_edges cluster_assignments deduplicated layered_dedup semantic_kept semantic_review multi_hop_qa "
    "sft_samples grouped_sides question_validation raw_questions audit_duplicates audit_overall audit_database sft_overall model_ranking scored_pages listed_urls extracted_relations sentence_relations graph_file pair_file raw_documents "
    "stored_graph encyclopedia clean_vietnamese repeated_marks sentence_spans routed_pages"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

_CH = """ch AS (SELECT *, sha256('files/' || parent || chr(31) || parent) AS parent_id, sha256(sha256('files/' || parent || chr(31) || parent) || chr(31) || i || chr(31) || content) AS chunk_id FROM (
  SELECT source_chunk_id AS c, min(pos) AS pos, string_agg(evidence_sentence, chr(10) ORDER BY pos) AS content, any_value(string_split(source_chunk_id, '#')[1]) AS parent, any_value(string_split(source_chunk_id, '#')[2]) AS i
  FROM triples WHERE source_chunk_id IS NOT NULL AND evidence_sentence IS NOT NULL GROUP BY source_chunk_id))"""
_STRUCT = """st AS (SELECT chunk_id AS subject, 'NEXT' AS predicate, lead(chunk_id) OVER (PARTITION BY parent_id ORDER BY pos) AS object FROM ch QUALIFY object IS NOT NULL UNION ALL SELECT chunk_id, 'PART_OF', parent_id FROM ch)"""
_STRIP = f"'^{T.WS}+|{T.WS}+$', '', 'g'"


def _near(source: str, key: str, text: str) -> str:
    """CTEs up to comp(pos, c): near-duplicate components of a table, and l(a, b, s), their links between classes."""
    return f"""src AS ({source}), w AS (SELECT {key} AS pos, {G._w(f'lower({text})')} AS w FROM src),
s AS (SELECT pos, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], chr(31))))) AS s FROM w),
r AS (SELECT min(pos) AS rep, s, count(*) AS k FROM s GROUP BY s), x AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM r),
p AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep GROUP BY a.rep, b.rep),
l AS (SELECT a, b, c / (na + nb - c) AS s FROM p WHERE c / (na + nb - c) >= 0.8 - 1e-12 UNION SELECT b, a, c / (na + nb - c) FROM p WHERE c / (na + nb - c) >= 0.8 - 1e-12),
reach(a, b) AS (SELECT rep, rep FROM r UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
comp AS (SELECT s.pos, r.rep, r.k, m.c FROM s JOIN r ON s.s = r.s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = r.rep)"""


def _cosine(source: str, least: float, name: str = "cl") -> str:
    return f"""{name}v AS ({source}), {name}l AS (SELECT a.id AS a, b.id AS b FROM {name}v a JOIN {name}v b ON a.id <> b.id WHERE list_cosine_similarity(a.v::DOUBLE[], b.v::DOUBLE[]) >= {least}),
{name}r(a, b) AS (SELECT id, id FROM {name}v UNION SELECT {name}r.a, {name}l.b FROM {name}r JOIN {name}l ON {name}r.b = {name}l.a), {name} AS (SELECT a AS id, min(b) AS c FROM {name}r GROUP BY a)"""


_DOCS = "SELECT pos, content FROM source_documents WHERE content IS NOT NULL"
_KEPT = "SELECT pos FROM comp QUALIFY row_number() OVER (PARTITION BY c ORDER BY pos::VARCHAR) = 1"
_PATHS = f"""{G._G}, de AS (SELECT subject AS s, object AS o, arg_min(predicate, pos) FILTER (upper(predicate) NOT IN {graph.STRUCTURAL!s}) AS p, list_distinct(list(source_chunk_id) FILTER (source_chunk_id <> '')) AS c FROM tri WHERE subject <> object GROUP BY 1, 2 HAVING p IS NOT NULL),
e AS (SELECT * FROM de QUALIFY row_number() OVER (PARTITION BY s ORDER BY o) <= 23), sn AS (SELECT DISTINCT id FROM node ORDER BY id LIMIT {STARTS}),
p1 AS (SELECT sn.id AS st, [sn.id, e.o] AS n, [e.p] AS ps, coalesce(e.c, []) AS c FROM sn JOIN e ON e.s = sn.id QUALIFY row_number() OVER (PARTITION BY st ORDER BY n) <= 20),
p2 AS (SELECT st, list_append(n, o) AS n, list_append(ps, p) AS ps, list_distinct(list_concat(p1.c, coalesce(e.c, []))) AS c FROM p1 JOIN e ON e.s = n[2] AND NOT list_contains(n, o) QUALIFY row_number() OVER (PARTITION BY st ORDER BY list_append(p1.n, o)) <= 20),
p3 AS (SELECT st, list_append(n, o) AS n, list_append(ps, p) AS ps, list_distinct(list_concat(p2.c, coalesce(e.c, []))) AS c FROM p2 JOIN e ON e.s = n[3] AND NOT list_contains(n, o) QUALIFY row_number() OVER (PARTITION BY st ORDER BY list_append(p2.n, o)) <= 20),
path AS (SELECT * FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3) QUALIFY row_number() OVER (PARTITION BY st ORDER BY n) <= 20)"""
_SCORE = "('0x' || substring(sha256('42:' || {0}), 1, 13))::BIGINT / 4503599627370496.0 < 0.2"
_FALL = """nm AS (SELECT item_id, arg_min(n, i) AS name, lower(n) AS low, min(i) AS i FROM (SELECT item_id, unnest(f) AS n0, generate_subscripts(f, 1) AS i, regexp_replace(n0, '^[ ,.;:()]+|[ ,.;:()]+$', '', 'g') AS n FROM (
  SELECT item_id, regexp_extract_all(passage, '[A-ZÀ-ỸĐ][\\pL\\pM\\pN\\p{Pc}]*(?:[\\s\\pZ]+[A-ZÀ-ỸĐ][\\pL\\pM\\pN\\p{Pc}]*)+') AS f FROM eval_items WHERE passage IS NOT NULL)) WHERE length(n) > 2 GROUP BY item_id, lower(n))"""
_AUDITS = {k: G.SQL[k] for k in ("audit_orphans", "audit_density", "audit_schema", "audit_hops")}
_DUP = f"SELECT p.n AS pairs, p.k AS entities_in_pairs, round(greatest(0, 100 - 500 * p.n / greatest(e.n, 1)), 1) AS health_score, CASE WHEN p.n > e.n * 0.1 THEN 'red' WHEN p.n > 0 THEN 'yellow' ELSE 'green' END AS flag FROM (SELECT count(*) AS n, (SELECT count(DISTINCT x) FROM (SELECT a AS x FROM sim UNION ALL SELECT b FROM sim)) AS k FROM sim) p, (SELECT count(DISTINCT node_id) AS n FROM entities) e"
_WITH_DUP = f"WITH sim AS ({G.SQL['similar_names']}) {_DUP}"
SQL: dict[str, str] = {
    "chunk_nodes": f"WITH {_CH} SELECT pos, chunk_id AS id, parent || ' chunk ' || i AS name, len({G._w('content')}) AS token_count, i::INT AS index, length(content) AS char_length, md5(substring(content, 1, 200)) AS description FROM ch",
    "document_nodes": f"WITH {_CH} SELECT parent_id AS id, any_value(parent) AS name, 'Document' AS type, 'files/' || any_value(parent) AS source, 'Source document: files/' || any_value(parent) AS description, count(*) AS chunk_count FROM ch GROUP BY parent_id",
    "structural_triples": f"WITH {_CH}, {_STRUCT} SELECT * FROM st",
    "removed_documents": f"WITH {_CH}, {_STRUCT}, gone AS (SELECT parent_id FROM ch GROUP BY parent_id HAVING count(*) = 1), ends AS (SELECT parent_id AS id FROM gone UNION SELECT chunk_id FROM ch WHERE parent_id IN (SELECT parent_id FROM gone)) SELECT * FROM st WHERE subject NOT IN (SELECT id FROM ends) AND object NOT IN (SELECT id FROM ends)",
    "mention_triples": f"""WITH {_CH}, {G._ENT}, en AS (SELECT DISTINCT source_chunk_id AS c, unnest([subject, object]) AS id FROM triples WHERE source_chunk_id IS NOT NULL),
d AS (SELECT c, chunk_id, list_filter(list_transform(string_split_regex(regexp_replace(content, '([.!?]){T.WS}+', '\\1' || chr(1), 'g'), '[\\x{{1}}\\r\\n]+'), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> '') AS s FROM ch)
SELECT d.chunk_id AS subject, ent.id AS object, coalesce(list_filter(d.s, lambda x: contains(lower(x), lower(ent.name)))[1], '') AS evidence_sentence FROM d JOIN en USING (c) JOIN ent USING (id) WHERE ent.name IS NOT NULL""",
    "rewritten_triples": f"WITH {G._ENT}, m AS (SELECT id, min(id) OVER (PARTITION BY coalesce(type, ''), lower(name)) AS k FROM ent WHERE name IS NOT NULL) SELECT pos, coalesce(a.k, subject) AS subject, coalesce(b.k, object) AS object, coalesce(evidence_sentence, '') AS evidence_sentence, coalesce(source_chunk_id, '') AS source_chunk_id FROM triples t LEFT JOIN m a ON a.id = subject LEFT JOIN m b ON b.id = object",
    "upserted_edges": f"WITH {G._TRI} SELECT subject, object, string_agg(DISTINCT predicate, ';' ORDER BY predicate) AS predicates, count(DISTINCT nullif(source_chunk_id, '')) AS chunks, count(DISTINCT predicate) FILTER (pos % 2 = 1) + count(DISTINCT predicate) FILTER (pos % 2 = 0) AS weight FROM tri GROUP BY subject, object",
    "fallback_names": f"WITH {_FALL} SELECT item_id, name FROM nm",
    "fallback_edges": f"""WITH {_FALL}, s AS (SELECT item_id, unnest(p) AS s, generate_subscripts(p, 1) - 1 AS j FROM (SELECT item_id, string_split_regex(regexp_replace(passage, '([.!?])\\s+', '\\1' || chr(1), 'g'), '\\x{{1}}') AS p FROM eval_items WHERE passage IS NOT NULL)),
h AS (SELECT s.item_id, j, name AS subject, lead(name) OVER (PARTITION BY s.item_id, j ORDER BY i) AS object FROM s JOIN nm ON nm.item_id = s.item_id AND contains(lower(s.s), nm.low)) SELECT * FROM h WHERE object IS NOT NULL""",
    "cluster_assignments": f"""WITH RECURSIVE {_near(_DOCS, 'pos', 'content')}, q AS (SELECT comp.*, length(content) AS n, count(*) OVER (PARTITION BY c) AS size FROM comp JOIN src USING (pos)),
cp AS (SELECT content, min(pos) AS first, count(*) AS k FROM src GROUP BY content), best AS (SELECT a, max(s) AS s FROM l GROUP BY a)
SELECT pos::VARCHAR AS record_id, CASE WHEN size > 1 THEN 'dup-' || min(pos::VARCHAR) OVER (PARTITION BY c) END AS cluster_id, first_value(pos::VARCHAR) OVER (PARTITION BY c ORDER BY q.n DESC, pos::VARCHAR) AS canonical_id,
  size > 1 AND pos::VARCHAR <> first_value(pos::VARCHAR) OVER (PARTITION BY c ORDER BY q.n DESC, pos::VARCHAR) AS is_duplicate, round(CASE WHEN q.k > 1 THEN 1.0 ELSE best.s END, 6) AS similarity FROM q LEFT JOIN best ON best.a = q.rep""",
    "deduplicated": f"WITH RECURSIVE {_near(_DOCS, 'pos', 'content')} {_KEPT}",
    "layered_dedup": f"WITH RECURSIVE {_near('SELECT doc_id AS pos, text AS content FROM documents JOIN embeddings ON doc_id = vec_id WHERE text IS NOT NULL', 'pos', 'content')}, kept AS ({_KEPT}), {_cosine('SELECT vec_id AS id, embedding AS v FROM embeddings WHERE vec_id IN (SELECT pos FROM kept)', 0.42)} SELECT id AS pos FROM cl QUALIFY row_number() OVER (PARTITION BY c ORDER BY id::VARCHAR) = 1",
    "semantic_kept": f"WITH RECURSIVE {_cosine('SELECT vec_id AS id, embedding AS v FROM embeddings', 0.42)} SELECT id AS vec_id FROM cl QUALIFY row_number() OVER (PARTITION BY c ORDER BY id::VARCHAR) = 1",
    "semantic_review": """WITH p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE s >= 0.4),
n AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 20), m AS (SELECT a, b, s FROM n UNION SELECT b, a, s FROM n)
SELECT a AS record_id, b AS matched_record_id, round(s, 4) AS similarity FROM m QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) = 1""",
    "multi_hop_qa": f"""{_PATHS}, nn AS (SELECT id, any_value(name) AS name FROM node GROUP BY id), q AS (SELECT *, list_sort(c) AS cs FROM path WHERE len(n) > 2 AND len(list_distinct(list_transform(c, lambda x: {_SCORE.format("'source:' || x")}))) < 2),
lab AS (SELECT st, n, list(coalesce(nn.name, k.id) ORDER BY k.i) AS labels FROM (SELECT st, n, unnest(n) AS id, generate_subscripts(n, 1) AS i FROM q) k LEFT JOIN nn ON nn.id = k.id GROUP BY st, n)
SELECT array_to_string(q.n, '|') AS nodes, len(ps) AS hops, 'Starting from ' || labels[1] || ' and following ' || array_to_string(list_transform(ps, lambda x: replace(x, '_', ' ')), ' → ') || ', what is reached?' AS question, labels[-1] AS answer,
  array_to_string(list_transform(range(1, len(ps) + 1), lambda i: labels[i] || ' ' || replace(ps[i], '_', ' ') || ' ' || labels[i + 1]), ' → ') AS path, CASE WHEN len(cs) > 0 THEN 'source:' || cs[1] ELSE 'path:' || array_to_string(q.n, '|') END AS group_id FROM q JOIN lab ON lab.st = q.st AND lab.n = q.n""",
    "sft_samples": f"""{_PATHS}, s AS (SELECT DISTINCT 1 AS hops, subject || '|' || predicate || '|' || object AS sample FROM tri UNION ALL SELECT len(ps), array_to_string(list_transform(range(1, len(ps) + 1), lambda i: n[i] || '|' || ps[i] || '|' || n[i + 1]), ';') FROM path WHERE len(ps) > 1)
SELECT hops, sample FROM s QUALIFY row_number() OVER (PARTITION BY hops ORDER BY sha256('42:' || sample), sample) <= CASE hops WHEN 2 THEN 40 ELSE 30 END""",
    "grouped_sides": f"WITH g AS (SELECT DISTINCT _group_id FROM qa_items WHERE _group_id IS NOT NULL), t AS (SELECT _group_id, {_SCORE.format('_group_id')} AS t, sha256('42:' || _group_id) AS h, count(*) OVER () AS n FROM g), k AS (SELECT *, count(*) FILTER (t) OVER () AS tests FROM t) SELECT _group_id, CASE WHEN n < 2 THEN 'train' WHEN tests = 0 AND h = (SELECT max(h) FROM k) THEN 'test' WHEN tests = n AND h = (SELECT min(h) FROM k) THEN 'train' WHEN t THEN 'test' ELSE 'train' END AS side FROM k",
    "question_validation": """WITH t AS (SELECT source_chunk_id AS id, pos, subject, object, lag(subject) OVER w AS ps, lag(object) OVER w AS po, lag(pos) OVER w AS before FROM triples WHERE source_chunk_id IS NOT NULL WINDOW w AS (PARTITION BY source_chunk_id ORDER BY pos)),
u AS (SELECT id, count(DISTINCT pos) AS n, count(*) FILTER (object IS NULL) AS unknown, count(*) FILTER (before IS NOT NULL AND NOT (subject IN (ps, po) OR object IN (ps, po))) AS apart FROM t GROUP BY id),
a AS (SELECT source_chunk_id AS id, coalesce(trim(max(evidence_sentence)), '') AS q, coalesce(trim(min(evidence_sentence)), '') AS a FROM triples WHERE source_chunk_id IS NOT NULL GROUP BY 1)
SELECT id, CASE WHEN q = '' OR a = '' THEN 'missing_question_or_answer' WHEN n < 2 THEN 'question_does_not_use_two_edges' WHEN unknown > 0 THEN 'unknown_used_edge_id' WHEN apart > 0 THEN 'used_edges_do_not_form_an_ordered_path' END AS reason FROM a JOIN u USING (id)""",
    "audit_duplicates": _WITH_DUP,
    "audit_overall": "SELECT round(avg(h), 1) AS overall_health_score, CASE WHEN round(avg(h), 1) >= 80 THEN 'excellent' WHEN round(avg(h), 1) >= 60 THEN 'good' WHEN round(avg(h), 1) >= 40 THEN 'fair' ELSE 'poor' END AS verdict FROM (" + " UNION ALL ".join(f"SELECT health_score::DOUBLE AS h FROM ({q})" for q in (*_AUDITS.values(), _WITH_DUP)) + ")",
    "audit_database": f"""{G._G}, pt AS (SELECT s.type AS st, predicate, o.type AS ot, count(*) AS n FROM tri JOIN node s ON s.id = subject JOIN node o ON o.id = object WHERE upper(predicate) <> 'MENTIONS' GROUP BY 1, 2, 3 ORDER BY n DESC, st NULLS FIRST, predicate, ot NULLS FIRST LIMIT 100),
cm AS (SELECT coalesce(sum(n) FILTER (st = 'DATE' AND ot IN ('PERSON', 'ORG', 'GPE')), 0) AS v, sum(n) AS n FROM pt), nm AS (SELECT id, type, lower(name) AS n, list_distinct(list_transform(range(1, greatest(length(name) - 2, 1) + 1), lambda i: substring(lower(name), i, 3))) AS g FROM node WHERE name IS NOT NULL AND type IS NOT NULL),
dp AS (SELECT DISTINCT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b FROM nm a JOIN nm b ON a.type = b.type AND a.id <> b.id AND a.n <> b.n AND contains(b.n, a.n) WHERE len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) >= 0.85),
un AS (SELECT subject AS a, object AS b FROM tri UNION SELECT object, subject FROM tri), f AS (SELECT DISTINCT id FROM node ORDER BY sha256(id), id LIMIT 50), h1 AS (SELECT DISTINCT f.id AS s, un.b AS o FROM f JOIN un ON un.a = f.id), h2 AS (SELECT s, o FROM h1 UNION SELECT h1.s, un.b FROM h1 JOIN un ON un.a = h1.o), h3 AS (SELECT s, o FROM h2 UNION SELECT h2.s, un.b FROM h2 JOIN un ON un.a = h2.o)
SELECT cm.v AS violations, round((cm.n - cm.v) / cm.n, 4) AS compliance_rate, (SELECT count(*) FROM dp) AS duplicate_pairs, round((SELECT count(*) FROM h2 WHERE s <> o) / ((SELECT count(*) FROM f) * ((SELECT count(*) FROM node) - 1)), 4) AS reachable_2hop, round((SELECT count(*) FROM h3 WHERE s <> o) / ((SELECT count(*) FROM f) * ((SELECT count(*) FROM node) - 1)), 4) AS reachable_3hop FROM cm""",
    "sft_overall": f"""WITH q AS (SELECT DISTINCT item_id, question, answer, coalesce(evidence, '') AS evidence FROM qa_items WHERE question IS NOT NULL AND answer IS NOT NULL),
i AS (SELECT evidence, list_filter(list_distinct({G._w('lower(question)')}), lambda x: NOT list_contains({G._STOP}, x)) AS i, {G._w('lower(answer)')} AS r, {G._w('answer')} AS w FROM q),
m AS (SELECT round(avg((len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '^\\p{{Lu}}') AND NOT contains(lower(evidence), lower(x)))) = 0)::INT), 3) AS faithfulness, round(avg(CASE WHEN len(i) > 0 THEN len(list_intersect(i, r)) / len(i) ELSE 0.5 END), 3) AS answer_relevancy, 0.5 AS factual_correctness FROM i),
b AS (SELECT unnest(list_transform(range(1, len(w)), lambda k: w[k] || '_' || w[k + 1])) AS b FROM (SELECT {G._w('lower(question)')} AS w FROM q) WHERE len(w) > 1), d AS (SELECT round(count(DISTINCT b) / count(*), 3) AS semantic_diversity FROM b)
SELECT faithfulness, answer_relevancy, factual_correctness::DOUBLE AS factual_correctness, semantic_diversity, round((faithfulness + answer_relevancy + factual_correctness::DOUBLE + semantic_diversity) / 4, 3) AS overall_score FROM m, d""",
    "model_ranking": f"WITH m AS ({G.SQL['answer_metrics']}), u AS (UNPIVOT (SELECT type, accuracy::DOUBLE AS accuracy, hallucination_rate::DOUBLE AS hallucination_rate, consistency::DOUBLE AS consistency, words::DOUBLE AS words FROM m) ON accuracy, hallucination_rate, consistency, words INTO NAME metric VALUE value) SELECT metric, type AS model, value, rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'hallucination_rate' THEN value ELSE -value END) AS place FROM u",
    "scored_pages": "SELECT doc_id, text, least(10.0, length(text) / 100)::DOUBLE AS score FROM documents WHERE doc_id IS NOT NULL AND length(text) >= 900",
    "listed_urls": "SELECT DISTINCT source_domain AS seed, url FROM documents WHERE url IS NOT NULL AND source_domain IS NOT NULL",
    "extracted_relations": f"""WITH {G._ENT}, t AS (SELECT pos, subject, object, predicate, a.name AS s, b.name AS o, coalesce(evidence_sentence, '') AS e FROM triples JOIN ent a ON a.id = subject JOIN ent b ON b.id = object WHERE source_chunk_id IS NOT NULL AND a.name IS NOT NULL AND b.name IS NOT NULL),
n AS (SELECT pos, lower(trim(n)) AS n, min(id) AS id FROM (SELECT pos, s AS n, subject AS id FROM t UNION ALL SELECT pos, o, object FROM t) GROUP BY 1, 2),
d AS (SELECT t.*, x.id AS a, y.id AS b, list_filter(list_transform(string_split_regex(regexp_replace(e, '([.!?]){T.WS}+', '\\1' || chr(1), 'g'), '[\\x{{1}}\\r\\n]+'), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> '') AS l FROM t JOIN n x ON x.pos = t.pos AND x.n = lower(trim(upper(s))) JOIN n y ON y.pos = t.pos AND y.n = lower(trim(o)))
SELECT pos, a AS subject, lower(regexp_replace(trim(predicate), '\\s+', '_', 'g')) AS predicate, b AS object, coalesce(list_filter(l, lambda x: contains(lower(x), lower(s)) AND contains(lower(x), lower(o)))[1], '') AS evidence FROM d WHERE a <> b""",
    "sentence_relations": f"""WITH {G._ENT}, r(h, o, p, i) AS (VALUES {", ".join(str((*x, i)) for i, x in enumerate(extract.RELATIONS))}),
t AS (SELECT pos, least(subject, object) AS a, greatest(subject, object) AS b, list_filter(list_transform(string_split_regex(regexp_replace(evidence_sentence, '([.!?]){T.WS}+', '\\1' || chr(1), 'g'), '[\\x{{1}}\\r\\n]+'), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> '') AS l FROM triples WHERE evidence_sentence IS NOT NULL AND subject <> object),
hh AS (SELECT pos, a, b, coalesce(x.type, 'ENTITY') AS ta, coalesce(y.type, 'ENTITY') AS tb, list_filter(l, lambda s: contains(lower(s), lower(x.name)) AND contains(lower(s), lower(y.name)))[1] AS evidence FROM t JOIN ent x ON x.id = a JOIN ent y ON y.id = b WHERE x.name IS NOT NULL AND y.name IS NOT NULL),
m AS (SELECT hh.*, (SELECT arg_min({{'p': p, 'f': hh.ta = r.h AND hh.tb = r.o}}, i) FROM r WHERE (hh.ta = r.h AND hh.tb = r.o) OR (hh.ta = r.o AND hh.tb = r.h)) AS x FROM hh WHERE evidence IS NOT NULL),
y AS (SELECT pos, evidence, coalesce(x.p, CASE WHEN ta = tb THEN 'related_to' ELSE 'associated_with' END) AS p, CASE WHEN coalesce(x.f, true) THEN a ELSE b END AS s, CASE WHEN coalesce(x.f, true) THEN b ELSE a END AS o FROM m)
SELECT pos, CASE WHEN p IN {G._SYM} AND o < s THEN o ELSE s END AS subject, p AS predicate, CASE WHEN p IN {G._SYM} AND o < s THEN s ELSE o END AS object, evidence FROM y""",
    "graph_file": f"SELECT predicate, count(*) AS n, count(*) FILTER (pos % 2 = 0 AND coalesce(evidence_sentence, '') <> '') AS with_evidence FROM triples WHERE subject IS NOT NULL AND predicate IS NOT NULL AND object IS NOT NULL AND upper(predicate) NOT IN {graph.STRUCTURAL!s} GROUP BY predicate",
    "pair_file": "SELECT type, count(*) AS n, count(answer) AS answered FROM (SELECT DISTINCT item_id, question, answer, type FROM qa_items) WHERE item_id % 10 <> 0 AND question IS NOT NULL GROUP BY type",
    "raw_documents": r"SELECT doc_id::VARCHAR AS source, md5(text) AS md5 FROM documents WHERE regexp_matches(text, '[^\s\x{b}]')",
    "stored_graph": "WITH o AS (SELECT subject, predicate, object, min(pos) AS pos FROM triples WHERE object IS NOT NULL GROUP BY 1, 2, 3) SELECT subject AS source, object AS target, string_agg(predicate, ';' ORDER BY pos) AS predicates, count(*) AS relations FROM o GROUP BY 1, 2",
    "encyclopedia": r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[^\s\x{b}]') AND regexp_matches(concat_ws(' ', title, substring(text, 1, 2000)), '(?i)(?:river|mill)') ORDER BY doc_id LIMIT 100",
    "repeated_marks": "SELECT DISTINCT name, nfc_normalize(replace(name, 'e', 'e' || chr(769)) || ' a' || chr(803) || chr(771)) AS repaired FROM entities WHERE name IS NOT NULL",
    "sentence_spans": f"""WITH p AS (SELECT item_id, string_split(regexp_replace(passage, '([.!?…])({T.WS}+)', '\\1' || chr(1) || '\\2' || chr(1), 'g'), chr(1)) AS p FROM eval_items WHERE passage IS NOT NULL),
x AS (SELECT item_id, unnest(p) AS t, generate_subscripts(p, 1) AS k, p FROM p), y AS (SELECT item_id, t, k, coalesce(list_sum(list_transform(p[1 : k - 1], lambda z: length(z))), 0)::INT AS start FROM x)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY k) - 1)::INT AS i, start, (start + length(t))::INT AS "end", t AS sentence FROM y WHERE k % 2 = 1 AND t <> ''""",
    "routed_pages": "SELECT doc_id, CASE WHEN regexp_matches(url, '^https?://([^/]*\\.)?gov\\.example(/|$)') THEN 'portal' WHEN regexp_matches(url, '^https?://([^/]*\\.)?org\\.example(/|$)') THEN 'article' ELSE 'general' END AS extractor FROM documents WHERE url IS NOT NULL",
}
SQL["clean_vietnamese"] = text_queries.SQL["clean_text"].replace("SELECT doc_id, md5(", "SELECT doc_id, md5(nfc_normalize(").replace(") AS clean_md5 FROM b", ")) AS md5 FROM b WHERE doc_id IN (SELECT doc_id FROM documents WHERE regexp_matches(text, '" + T.NOT_WS + "'))")
