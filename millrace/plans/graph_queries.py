"""Queries of deduplication, extraction, resolution, graph, audit and dataset operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chunking, datasets, dedup, extract, graph, metrics, resolve
from millrace.session import table

#: A small ontology for the schema audit.
RULES = (("located_in", "ORG", "GPE"), ("works_at", "PERSON", "ORG"), ("authored_by", "WORK_OF_ART", "PERSON"), ("participated_in", "PERSON", "EVENT"))
_KINDS = {"PER": "PERSON", "ORGANIZATION": "ORG", "LOCATION": "GPE", "WORK": "WORK_OF_ART"}


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each node as (id, name, type, aliases, description, confidence, source)."""
    e = graph.latest(table(spark, sf_dir, "entities"), "node_id", "updated_at", "name")
    kind = F.col("label")
    for k, v in _KINDS.items():
        kind = F.when(F.col("label") == k, v).otherwise(kind)
    return e.select(F.col("node_id").alias("id"), "name", kind.alias("type"), F.col("mentions").alias("aliases"), "description", "confidence", "source")


def _triples(spark, sf_dir):
    return graph.normalize_triples(table(spark, sf_dir, "triples"))


def _graph(spark, sf_dir):
    e, t = _entities(spark, sf_dir), _triples(spark, sf_dir)
    edges = graph.build_edges(t)
    return graph.build_nodes(e, edges), edges, e, t


def exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(table(spark, sf_dir, "source_documents").where("content is not null"), "content", F.col("pos")).select("pos", "doc_id")


def exact_clusters(spark, sf_dir):
    d = table(spark, sf_dir, "source_documents").where("content is not null")
    return dedup.exact_clusters(d, "pos", "content", F.length("content").cast("double"))


def jaccard_pairs(spark, sf_dir):
    d = table(spark, sf_dir, "source_documents").where("content is not null").select("pos", T.word_shingles(F.col("content"), 5).alias("s"))
    return dedup.set_pairs(d, "pos", "s", 0.8).select("a", "b", F.round("similarity", 6).alias("similarity"))


def near_dup_clusters(spark, sf_dir):
    return dedup.near_dup_clusters(table(spark, sf_dir, "source_documents").select("pos", "content"), "pos", "content", 0.8)


def simhash_signatures(spark, sf_dir):
    return dedup.simhash_signatures(table(spark, sf_dir, "source_documents"), "pos", "content").select(F.col("id").alias("pos"), "signature")


def simhash_dedup(spark, sf_dir):
    return dedup.simhash_dedup(table(spark, sf_dir, "source_documents"), "pos", "content", 3).select(F.col("id").alias("pos"))


def ngram_greedy_dedup(spark, sf_dir):
    return dedup.ngram_dedup(table(spark, sf_dir, "source_documents"), "pos", "content", 0.8).select(F.col("id").alias("pos"))


def cosine_search(spark, sf_dir):
    """Vectors whose id is divisible by 20 against all."""
    v = table(spark, sf_dir, "embeddings")
    return dedup.cosine_pairs(v, "vec_id", "embedding", 0.3, F.col("vec_id") % 20 == 0).select("a", "b", F.round("similarity", 4).alias("similarity"))


def semantic_clusters(spark, sf_dir):
    from millrace.operators.components import connected_components

    pairs = dedup.cosine_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.42)
    return connected_components(pairs).select(F.col("node").alias("vec_id"), F.col("root").alias("cluster"))


def line_frequency(spark, sf_dir):
    return dedup.line_frequency(table(spark, sf_dir, "documents"), "doc_id", "text").where("pages > 1")


def frequent_lines_dropped(spark, sf_dir):
    return dedup.drop_frequent_lines(table(spark, sf_dir, "documents"), "doc_id", "text", 0.01).select("doc_id", "content_hash", F.col("n").cast("long").alias("n"))


def normalized_triples(spark, sf_dir):
    return _triples(spark, sf_dir).select("pos", "subject", "predicate", "object")


def distinct_facts(spark, sf_dir):
    t = table(spark, sf_dir, "triples").where("object is not null")
    return t.groupBy(F.lower("subject").alias("subject"), F.lower("predicate").alias("predicate"), F.lower("object").alias("object")).agg(F.min("pos").alias("pos"))


def distinct_questions(spark, sf_dir):
    q = table(spark, sf_dir, "qa_items").where("question is not null")
    first = q.groupBy(F.lower(T.strip(F.col("question"))).alias("q")).agg(F.min_by(F.struct("item_id", "answer"), "item_id").alias("r"))
    return first.where(T.strip(F.col("r.answer")) != "").select("r.item_id")


def fixed_chunks(spark, sf_dir):
    return chunking.explode_chunks(table(spark, sf_dir, "documents"), "doc_id", "text", chunking.fixed_chunks).select("doc_id", "idx", "tokens", "chars")


def sentence_chunks(spark, sf_dir):
    return chunking.explode_chunks(table(spark, sf_dir, "documents"), "doc_id", "text", lambda t: chunking.sentence_chunks(t, 60, 10)).select("doc_id", "idx", "tokens", "chars")


def token_budget_records(spark, sf_dir):
    return chunking.budget_records(table(spark, sf_dir, "source_documents").dropDuplicates(["pos"]), "pos", "content", lambda t: len(t.split()), 64).select("pos", "record_id", "start", "end", "tokens")


def shard_plan(spark, sf_dir):
    r = table(spark, sf_dir, "source_documents").select("pos", T.token_count(F.col("content")).alias("tokens"))
    return chunking.shard_plan(r, "pos", "tokens", 2000).select(F.col("record").cast("long").alias("pos"), "lane", "shard", "tokens")


def token_balance(spark, sf_dir):
    """The delivered training items, trimmed to the token volume of the other splits."""
    q = table(spark, sf_dir, "qa_items").where("question is not null").groupBy("item_id", "split").agg(F.min(T.regex_token_count(F.concat_ws("\n", "question", F.coalesce("answer", F.lit(""))))).cast("long").alias("n"))
    budget = q.where("split <> 'train'").agg(F.sum("n")).first()[0] or 0
    return chunking.running_balance(q.where("split = 'train'").select("item_id", "n"), "item_id", "n", budget)


def regex_entities(spark, sf_dir):
    return extract.regex_entities(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", F.lower("name").alias("name"), "label")


def inferred_relations(spark, sf_dir):
    """The relation that the labels of each triple's ends suggest."""
    n = _entities(spark, sf_dir).select("id", F.coalesce("type", F.lit("ENTITY")).alias("type"))
    t = _triples(spark, sf_dir).join(n.select(F.col("id").alias("subject"), F.col("type").alias("st")), "subject").join(n.select(F.col("id").alias("object"), F.col("type").alias("ot")), "object")
    return t.select("pos", extract.infer_relation(F.col("subject"), F.col("st"), F.col("object"), F.col("ot")).alias("r")).select("pos", "r.*")


def delimited_records(spark, sf_dir):
    """Replies made of entity rows, parsed back."""
    e = _entities(spark, sf_dir).where("name is not null")
    rec = F.concat(F.lit('("entity"<|>"'), "name", F.lit('"<|>"'), F.coalesce("type", F.lit("ENTITY")), F.lit('"<|>"'), F.coalesce("description", F.lit("")), F.lit('")'))
    replies = e.select("id", F.concat(rec, F.lit("##"), rec, F.lit("<|COMPLETE|>")).alias("reply"))
    return extract.delimited_records(replies, "id", "reply")[0].select("id", "name", "type", "description")


def merged_descriptions(spark, sf_dir):
    return extract.merged_descriptions(table(spark, sf_dir, "triples").where("object is not null"), "subject", "object").select("subject", "object", F.col("descriptions").cast("long").alias("descriptions"), F.md5("description").alias("md5"))


def text_facts(spark, sf_dir):
    return extract.extract_facts(table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"), "doc_id", "text")


def bio_spans(spark, sf_dir):
    """Tags made from capitalised words, grouped to spans."""
    d = table(spark, sf_dir, "qa_items").where("question is not null").select("item_id", "question").distinct()
    w = d.select("item_id", F.posexplode(T.words(F.col("question"))).alias("i", "word"))
    return extract.bio_spans(w.withColumn("tag", F.when(F.col("word").rlike("^[A-Z][a-z]+"), "I-NAME").otherwise("O")), "item_id", "i", "word", "tag").select("item_id", F.col("start").cast("long").alias("start"), "text")


def entity_resolution(spark, sf_dir):
    e = _numbered(spark, sf_dir)
    return resolve.resolve_strings(e, 0.6)


def _numbered(spark, sf_dir):
    e = _entities(spark, sf_dir)
    return e.select(F.conv(F.substring(F.md5("id"), 1, 15), 16, 10).cast("long").alias("pos"), "id", "name", F.coalesce("type", F.lit("")).alias("type"), "aliases", "source", "description", "confidence")


def entity_clusters(spark, sf_dir):
    e = _numbered(spark, sf_dir)
    return resolve.merge_clusters(e, resolve.resolve_strings(e, 0.6)).select("canonical_pos", "name", "members")


def id_map(spark, sf_dir):
    e = _numbered(spark, sf_dir)
    return resolve.id_mapping(e, resolve.merge_clusters(e, resolve.resolve_strings(e, 0.6)))


def incremental_match(spark, sf_dir):
    e = _numbered(spark, sf_dir)
    return resolve.match_stored(e.where("pos % 4 = 0"), e.where("pos % 4 <> 0").select(F.col("pos").alias("id"), "name", "type"), 0.6)


def graph_nodes(spark, sf_dir):
    return _graph(spark, sf_dir)[0]


def graph_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1].select("subject", "object", F.array_join("predicates", ";").alias("predicates"), F.size("source_texts").cast("long").alias("texts"), F.array_join("source_chunk_ids", ";").alias("chunks"), "description", F.col("weight").cast("long").alias("weight"))


def next_edges(spark, sf_dir):
    c = table(spark, sf_dir, "triples").where("source_chunk_id is not null").select("source_chunk_id").distinct()
    c = c.select("source_chunk_id", F.substring_index("source_chunk_id", "#", 1).alias("parent"), F.substring_index("source_chunk_id", "#", -1).cast("int").alias("i"))
    return graph.next_edges(c, "parent", "i", "source_chunk_id")


def part_of_counts(spark, sf_dir):
    c = table(spark, sf_dir, "triples").where("source_chunk_id is not null")
    return c.groupBy(F.substring_index("source_chunk_id", "#", 1).alias("doc_id")).agg(F.countDistinct("source_chunk_id").alias("chunks"), F.count("*").alias("triples"))


def degree_stats(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return graph.degrees(n, e)


def label_histogram(spark, sf_dir):
    return _graph(spark, sf_dir)[0].groupBy("type").agg(F.count("*").alias("n"))


def weak_components(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return graph.weak_components(n, e)


def pagerank(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return graph.pagerank(n, e)


def ontology_check(spark, sf_dir):
    """Predicates outside the ontology, with their number."""
    rules = spark.createDataFrame(RULES, "predicate string, domain string, range string")
    return _triples(spark, sf_dir).join(F.broadcast(rules), "predicate", "left_anti").groupBy("predicate").agg(F.count("*").alias("n"))


def audit_orphans(spark, sf_dir):
    n, e, ent, _ = _graph(spark, sf_dir)
    return metrics.orphan_audit(n, e)


def audit_density(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return metrics.density_audit(n, e)


def audit_schema(spark, sf_dir):
    n, _, _, t = _graph(spark, sf_dir)
    return metrics.schema_audit(t, n, spark.createDataFrame(RULES, "predicate string, domain string, range string"))


def audit_hops(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return metrics.hop_audit(n, e)


def similar_names(spark, sf_dir):
    """Distinct names whose character trigrams are alike, in lower case."""
    e = _entities(spark, sf_dir).select(F.lower(F.trim("name")).alias("name")).distinct().where("length(name) >= 3")
    d = e.select("name", F.array_distinct(T.char_ngrams(F.col("name"), 3)).alias("s"))
    return dedup.set_pairs(d, "name", "s", 0.85).select("a", "b", F.round("similarity", 6).alias("similarity"))


def kg_quality(spark, sf_dir):
    n, e, ent, t = _graph(spark, sf_dir)
    r = metrics.graph_quality(ent, table(spark, sf_dir, "triples"), n, e)
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


def coverage_scores(spark, sf_dir):
    """How far the triples of the first half of the records cover those of all."""
    ent, t = _entities(spark, sf_dir), table(spark, sf_dir, "triples").where("object is not null")
    nm = ent.select("id", "name")
    named = t.join(nm.select(F.col("id").alias("subject"), F.col("name").alias("s")), "subject").join(nm.select(F.col("id").alias("object"), F.col("name").alias("o")), "object").select("pos", "s", "predicate", "o")
    facts = named.select(F.col("s").alias("subject"), "predicate", F.col("o").alias("object"))
    return metrics.fact_coverage(facts, ent.where("confidence > 0.5").select("name"), named.where("pos % 2 = 0").select("s", F.col("predicate").alias("p"), "o"))


def _answers(spark, sf_dir):
    """Items as predictions: the stored answer against the smallest answer of the same question."""
    q = table(spark, sf_dir, "qa_items").where("question is not null and answer is not null").select("item_id", "question", "answer", "type").distinct()
    e = q.groupBy("question").agg(F.min("answer").alias("expected"))
    return q.join(e, "question")


def token_f1(spark, sf_dir):
    return _answers(spark, sf_dir).select("item_id", F.round(metrics.token_f1(F.col("expected"), F.col("answer")), 6).alias("f1"))


def answer_metrics(spark, sf_dir):
    a = _answers(spark, sf_dir)
    n = F.size(T.words(F.col("answer")))
    return a.groupBy("type").agg(F.round(F.avg(metrics.token_f1(F.col("expected"), F.col("answer"))), 4).alias("accuracy"), F.round(F.avg(metrics.hallucinated(F.col("question"), F.col("expected"), F.col("answer")).cast("double")), 4).alias("hallucination_rate"), F.round(metrics.length_consistency(n), 4).alias("consistency"), F.round(F.avg(n), 4).alias("words"))


def sft_scores(spark, sf_dir):
    q = table(spark, sf_dir, "qa_items").where("question is not null and answer is not null").select("item_id", "question", "answer", "evidence").distinct()
    return q.select("item_id", F.round(metrics.relevancy(F.col("question"), F.col("answer")), 6).alias("relevancy"), metrics.faithful(F.coalesce("evidence", F.lit("")), F.col("answer")).alias("faithful"))


def bigram_diversity(spark, sf_dir):
    b = metrics.bigrams(table(spark, sf_dir, "qa_items").where("question is not null").select("item_id", "question").distinct(), "question")
    return b.agg(F.count("*").alias("distinct_bigrams"), F.sum("n").alias("bigrams"), F.round(F.count("*") / F.sum("n"), 6).alias("diversity"))


def source_counts(spark, sf_dir):
    """Accepted audit rows of every record, zero where there are none."""
    d = table(spark, sf_dir, "source_documents").where("doc_id is not null").select("doc_id").distinct()
    a = table(spark, sf_dir, "source_audit").where("decision = 'accepted'").groupBy("doc_id").agg(F.count("*").alias("n"))
    return d.join(a, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n"))


def curation_report(spark, sf_dir):
    a = table(spark, sf_dir, "source_audit")
    return a.groupBy("decision").agg(F.count("*").alias("n"), F.min("word_count").alias("least"), F.max("word_count").alias("most"), F.round(F.avg("char_count"), 4).alias("mean_chars"))


def grouped_split(spark, sf_dir):
    q = table(spark, sf_dir, "qa_items").select("item_id", F.coalesce("_group_id", F.lit("")).alias("g")).distinct()
    return q.select("item_id", datasets.hash_split(F.col("g"), 0.2).alias("split"))


def single_hop_qa(spark, sf_dir):
    e = _entities(spark, sf_dir)
    return datasets.single_hop(table(spark, sf_dir, "triples").where("object is not null"), e.select("id", "name"))


def true_false_qa(spark, sf_dir):
    n, _, _, t = _graph(spark, sf_dir)
    return datasets.true_false(t, n, t)


def two_hop_paths(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return datasets.two_hop_paths(e, n.orderBy("id").limit(200))


def comparison_pairs(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return datasets.comparison_pairs(n, e).select("type", "a", "b", F.array_join("shared", ";").alias("shared"))


def knowledge_edges(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    return datasets.knowledge_edges(e, n).select("id", "source", "target")


def khop_subgraphs(spark, sf_dir):
    n, e, *_ = _graph(spark, sf_dir)
    k = datasets.knowledge_edges(e, n).withColumn("loss", F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    return datasets.khop_subgraphs(k)


def version_status(spark, sf_dir):
    """The records against themselves with every seventh changed or missing."""
    d = table(spark, sf_dir, "source_documents").where("doc_id is not null and content is not null").select("doc_id", "content", "pos")
    return graph.version_status(d.where("pos % 7 <> 1"), d.where("pos % 7 <> 2").select("doc_id", F.when(F.col("pos") % 7 == 3, F.concat("content", F.lit("!"))).otherwise(F.col("content")).alias("content")), "doc_id", "content")


def replaced_documents(spark, sf_dir):
    """Edges left after the chunks of every fifth record went."""
    n, e, _, t = _graph(spark, sf_dir)
    gone = t.where("pos % 5 = 0 and source_chunk_id is not null").select(F.col("source_chunk_id").alias("chunk_id")).distinct()
    kept, _ = graph.replace_documents(e, n, gone)
    return kept.select("subject", "object", F.array_join("source_chunk_ids", ";").alias("chunks"))


def graph_search(spark, sf_dir):
    """The nodes whose name contains a string, the best connected first."""
    n, e, *_ = _graph(spark, sf_dir)
    hit = n.where(F.contains(F.lower("name"), F.lit("museum")))
    return hit.join(graph.degrees(n, e), "id").withColumn("degree", F.col("out_degree") + F.col("in_degree")).orderBy(F.desc("degree"), "id").limit(25).select("id", "name", "degree")


def chunk_linkage(spark, sf_dir):
    t = table(spark, sf_dir, "triples").where("source_chunk_id is not null")
    return t.groupBy(F.substring_index("source_chunk_id", "#", 1).alias("doc_id")).agg(F.array_join(F.array_sort(F.collect_set("source_chunk_id")), ";").alias("chunks"), F.count("*").alias("triples"))


NAMES = (
    "exact_dedup exact_clusters jaccard_pairs near_dup_clusters simhash_signatures simhash_dedup ngram_greedy_dedup cosine_search semantic_clusters line_frequency frequent_lines_dropped normalized_triples distinct_facts "
    "distinct_questions fixed_chunks sentence_chunks token_budget_records shard_plan token_balance regex_entities inferred_relations delimited_records merged_descriptions text_facts bio_spans entity_resolution "
    "entity_clusters id_map incremental_match graph_nodes graph_edges next_edges part_of_counts degree_stats label_histogram weak_components pagerank ontology_check audit_orphans audit_density audit_schema audit_hops similar_names "
    "kg_quality coverage_scores token_f1 answer_metrics sft_scores bigram_diversity source_counts curation_report grouped_split single_hop_qa true_false_qa two_hop_paths comparison_pairs knowledge_edges khop_subgraphs version_status "
    "replaced_documents graph_search chunk_linkage"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

_ENT = """ent AS (SELECT node_id AS id, r.name AS name, CASE r.label WHEN 'PER' THEN 'PERSON' WHEN 'ORGANIZATION' THEN 'ORG' WHEN 'LOCATION' THEN 'GPE' WHEN 'WORK' THEN 'WORK_OF_ART' ELSE r.label END AS type, r.mentions AS aliases, r.description AS description, r.confidence AS confidence, r.source AS source
FROM (SELECT node_id, arg_max({'name': name, 'label': label, 'mentions': mentions, 'description': description, 'confidence': confidence, 'source': source}, {'u': updated_at, 'n': name}) AS r FROM entities WHERE node_id IS NOT NULL GROUP BY node_id))"""
_SYM = str(graph.SYMMETRIC)
_TRI = f"""tri AS (SELECT min(pos) AS pos, subject, predicate, object, source_chunk_id, description, confidence, arg_min(coalesce(evidence_sentence, ''), pos) AS evidence_sentence FROM (
  SELECT pos, CASE WHEN predicate IN {_SYM} AND object < subject THEN object ELSE subject END AS subject, predicate, CASE WHEN predicate IN {_SYM} AND object < subject THEN subject ELSE object END AS object, evidence_sentence, source_chunk_id, description, confidence
  FROM triples WHERE subject IS NOT NULL AND object IS NOT NULL AND predicate IS NOT NULL AND (subject <> object OR predicate IN {graph.STRUCTURAL!s})) GROUP BY ALL_KEYS)""".replace("GROUP BY ALL_KEYS", "GROUP BY subject, predicate, object, source_chunk_id, description, confidence")
_PRED = """edge AS (SELECT subject, object, list(DISTINCT predicate) AS predicates, count(DISTINCT predicate) AS weight FROM tri GROUP BY subject, object)"""
_NODE = """node AS (SELECT id, name, type FROM ent UNION ALL SELECT x.id, x.id, 'ENTITY' FROM (SELECT subject AS id FROM edge UNION SELECT object FROM edge) x WHERE x.id NOT IN (SELECT id FROM ent))"""
_G = f"WITH {_ENT}, {_TRI}, {_PRED}, {_NODE}"
_REACH = """, und AS (SELECT subject AS a, object AS b FROM edge UNION SELECT object, subject FROM edge)"""
_RULES = ", ".join(str(r) for r in RULES)
_WORDS = f"list_filter(string_split_regex({{c}}, '{T.WS}+'), lambda x: x <> '')"


def _w(c: str) -> str:
    return _WORDS.replace("{c}", c)


_F1 = f"""WITH q AS (SELECT DISTINCT item_id, question, answer, type FROM qa_items WHERE question IS NOT NULL AND answer IS NOT NULL),
e AS (SELECT question, min(answer) AS expected FROM q GROUP BY question),
p AS (SELECT q.*, expected, list_distinct({_w('lower(answer)')}) AS a, list_distinct({_w('lower(expected)')}) AS b, list_distinct({_w('lower(question)')}) AS k, len({_w('answer')}) AS n FROM q JOIN e USING (question)),
m AS (SELECT *, CASE WHEN regexp_replace(lower(answer), '^{T.WS}+|{T.WS}+$', '', 'g') = regexp_replace(lower(expected), '^{T.WS}+|{T.WS}+$', '', 'g') THEN 1.0 WHEN len(a) + len(b) = 0 THEN 0 ELSE 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) END AS f1,
  CASE WHEN len(a) > 0 THEN len(list_filter(a, lambda x: NOT list_contains(list_concat(b, k), x))) / len(a) > 0.3 ELSE false END AS h FROM p)"""
_STOP = str(list(metrics.STOPWORDS))
SQL: dict[str, str] = {
    "exact_dedup": "SELECT pos, doc_id FROM source_documents WHERE content IS NOT NULL QUALIFY row_number() OVER (PARTITION BY content ORDER BY pos) = 1",
    "exact_clusters": "WITH d AS (SELECT pos, content, count(*) OVER w AS n, min(pos) OVER w AS least FROM source_documents WHERE content IS NOT NULL WINDOW w AS (PARTITION BY content)) SELECT pos AS key, CASE WHEN n > 1 THEN 'dup-' || least END AS cluster_id, CASE WHEN n > 1 THEN least END AS canonical_id, n > 1 AND pos <> least AS is_duplicate FROM d",
    "jaccard_pairs": f"""WITH w AS (SELECT pos, {_w('lower(content)')} AS w FROM source_documents WHERE content IS NOT NULL),
s AS (SELECT pos, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], chr(31))))) AS s FROM w),
r AS (SELECT min(pos) AS pos, s FROM s GROUP BY s), x AS (SELECT pos, len(s) AS n, unnest(s) AS g FROM r),
p AS (SELECT a.pos AS a, b.pos AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.pos < b.pos GROUP BY a.pos, b.pos)
SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM p WHERE c / (na + nb - c) >= 0.8 - 1e-12""",
    "near_dup_clusters": f"""WITH RECURSIVE w AS (SELECT pos, {_w('lower(content)')} AS w FROM source_documents WHERE content IS NOT NULL),
s AS (SELECT pos, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], chr(31))))) AS s FROM w),
r AS (SELECT min(pos) AS rep, s FROM s GROUP BY s), x AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM r),
p AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep GROUP BY a.rep, b.rep),
l AS (SELECT a, b FROM p WHERE c / (na + nb - c) >= 0.8 - 1e-12 UNION SELECT b, a FROM p WHERE c / (na + nb - c) >= 0.8 - 1e-12),
reach(a, b) AS (SELECT rep, rep FROM r UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
SELECT s.pos, c.component, count(*) OVER (PARTITION BY c.component) AS size FROM s JOIN r ON s.s = r.s JOIN c ON c.rep = r.rep""",
    "cosine_search": "SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3",
    "line_frequency": "SELECT line, count(*) AS pages FROM (SELECT DISTINCT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents WHERE text IS NOT NULL) WHERE length(line) >= 4 GROUP BY line HAVING count(*) > 1",
    "frequent_lines_dropped": """WITH x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
f AS (SELECT trim(line) AS l FROM x WHERE length(trim(line)) >= 4 GROUP BY 1 HAVING count(DISTINCT doc_id) >= greatest(2, floor((SELECT count(*) FROM documents WHERE text IS NOT NULL) * 0.01))),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM x WHERE trim(line) NOT IN (SELECT l FROM f) GROUP BY doc_id)
SELECT d.doc_id, sha256(coalesce(k.t, '')) AS content_hash, length(coalesce(k.t, '')) AS n FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id WHERE d.text IS NOT NULL""",
    "normalized_triples": f"WITH {_TRI} SELECT pos, subject, predicate, object FROM tri",
    "distinct_facts": "SELECT lower(subject) AS subject, lower(predicate) AS predicate, lower(object) AS object, min(pos) AS pos FROM triples WHERE object IS NOT NULL GROUP BY 1, 2, 3",
    "distinct_questions": f"SELECT r.item_id AS item_id FROM (SELECT arg_min({{'item_id': item_id, 'answer': answer}}, item_id) AS r FROM qa_items WHERE question IS NOT NULL GROUP BY lower(regexp_replace(question, '^{T.WS}+|{T.WS}+$', '', 'g'))) WHERE regexp_replace(r.answer, '^{T.WS}+|{T.WS}+$', '', 'g') <> ''",
    "regex_entities": r"""SELECT doc_id, name, label FROM (SELECT doc_id, lower(e.name) AS name, arg_min(e.label, e.i) AS label FROM (
SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), lambda x: {'name': x, 'label': 'CONTACT', 'i': 1})) AS e FROM documents WHERE text IS NOT NULL
UNION ALL SELECT doc_id, unnest(list_transform(regexp_extract_all(text, 'https?://[^\s<>"]+'), lambda x: {'name': x, 'label': 'URL', 'i': 2})) FROM documents WHERE text IS NOT NULL
UNION ALL SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '\b([A-Z][a-z]+(?: [A-Z][a-z]+)+)(?:$|[^\pL\pM\pN_])', 1), lambda x: {'name': x, 'label': 'NAMED_ENTITY', 'i': 3})) FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2)""",
    "merged_descriptions": "WITH d AS (SELECT subject, object, list_sort(list(DISTINCT description)) AS d FROM triples WHERE object IS NOT NULL AND description IS NOT NULL AND description <> '' GROUP BY 1, 2) SELECT subject, object, len(d) AS descriptions, md5(array_to_string(d, ' ')) AS md5 FROM d",
    "delimited_records": f"WITH {_ENT} SELECT id, name, upper(coalesce(type, 'ENTITY')) AS type, regexp_replace(coalesce(description, ''), '^{T.WS}+|{T.WS}+$', '', 'g') AS description FROM ent WHERE name IS NOT NULL",
    "graph_nodes": f"{_G} SELECT id, name, type FROM node",
    "graph_edges": f"""WITH {_TRI}, p AS (SELECT subject, object, 1 AS k, predicate AS v, min(pos) AS pos FROM tri GROUP BY ALL UNION ALL SELECT subject, object, 2, evidence_sentence, min(pos) FROM tri WHERE evidence_sentence <> '' GROUP BY ALL UNION ALL SELECT subject, object, 3, source_chunk_id, min(pos) FROM tri WHERE source_chunk_id IS NOT NULL AND source_chunk_id <> '' GROUP BY ALL)
SELECT p.subject, p.object, string_agg(v, ';' ORDER BY pos) FILTER (k = 1) AS predicates, count(*) FILTER (k = 2) AS texts, coalesce(string_agg(v, ';' ORDER BY pos) FILTER (k = 3), '') AS chunks, any_value(coalesce(d, '')) AS description, count(*) FILTER (k = 1) AS weight
FROM p LEFT JOIN (SELECT subject, object, arg_max(description, pos) AS d FROM tri WHERE description <> '' GROUP BY 1, 2) t ON p.subject = t.subject AND p.object = t.object GROUP BY p.subject, p.object""",
    "next_edges": "WITH c AS (SELECT DISTINCT source_chunk_id AS c FROM triples WHERE source_chunk_id IS NOT NULL) SELECT c AS subject, n AS object FROM (SELECT c, lead(c) OVER (PARTITION BY string_split(c, '#')[1] ORDER BY string_split(c, '#')[-1]::INT) AS n FROM c) WHERE n IS NOT NULL",
    "part_of_counts": "SELECT string_split(source_chunk_id, '#')[1] AS doc_id, count(DISTINCT source_chunk_id) AS chunks, count(*) AS triples FROM triples WHERE source_chunk_id IS NOT NULL GROUP BY 1",
    "chunk_linkage": "SELECT string_split(source_chunk_id, '#')[1] AS doc_id, string_agg(DISTINCT source_chunk_id, ';' ORDER BY source_chunk_id) AS chunks, count(*) AS triples FROM triples WHERE source_chunk_id IS NOT NULL GROUP BY 1",
    "degree_stats": f"{_G} SELECT id, (SELECT count(*) FROM edge WHERE subject = id) AS out_degree, (SELECT count(*) FROM edge WHERE object = id) AS in_degree FROM node",
    "label_histogram": f"{_G} SELECT type, count(*) AS n FROM node GROUP BY type",
    "ontology_check": f"WITH {_TRI} SELECT predicate, count(*) AS n FROM tri WHERE predicate NOT IN {tuple(r[0] for r in RULES)} GROUP BY predicate",
    "audit_orphans": f"{_G}, o AS (SELECT id, type, id NOT IN (SELECT subject FROM edge UNION SELECT object FROM edge) AS o FROM node), r AS (SELECT avg(o::INT) AS r, count(*) FILTER (o) AS n, count(*) FILTER (o AND coalesce(type, '') IN ('Chunk', 'Document')) AS c FROM o) SELECT n AS orphan_count, round(r, 4) AS orphan_rate, n - c AS entity_orphans, c AS chunk_orphans, round(greatest(0, 100 - r * 300), 1) AS health_score, CASE WHEN r > 0.3 THEN 'red' WHEN r > 0.1 THEN 'yellow' ELSE 'green' END AS flag FROM r",
    "audit_density": f"{_G}, r AS (SELECT n, m / (n * (n - 1)) AS d FROM (SELECT count(*) AS n FROM node), (SELECT count(*) AS m FROM edge)) SELECT round(d, 6) AS density, round(CASE WHEN d < 0.005 THEN d * 2000 WHEN d <= 0.2 THEN 100 ELSE greatest(0, 100 - (d - 0.2) * 500) END, 1) AS health_score, CASE WHEN d < 0.005 THEN 'red' WHEN d > 0.2 THEN 'yellow' ELSE 'green' END AS flag FROM r",
    "audit_schema": f"""{_G}, rule(predicate, d, r) AS (VALUES {_RULES}), v AS (SELECT (s.type <> '' AND s.type <> rule.d)::INT AS x, (o.type <> '' AND o.type <> rule.r)::INT AS y FROM tri LEFT JOIN rule ON tri.predicate = rule.predicate LEFT JOIN node s ON s.id = tri.subject LEFT JOIN node o ON o.id = tri.object),
c AS (SELECT sum(coalesce(x, 0) + coalesce(y, 0))::BIGINT AS violations, 1 - violations / count(*) AS c FROM v) SELECT violations, round(c, 4) AS compliance_rate, round(c * 100, 1) AS health_score, CASE WHEN c < 0.8 THEN 'red' WHEN c < 0.95 THEN 'yellow' ELSE 'green' END AS flag FROM c""",
    "audit_hops": f"""{_G}, st AS (SELECT id FROM node ORDER BY id LIMIT 200), h1 AS (SELECT DISTINCT st.id AS s, object AS o FROM st JOIN edge ON subject = st.id),
h2 AS (SELECT DISTINCT s, object AS o FROM h1 JOIN edge ON subject = o), h12 AS (SELECT * FROM h1 UNION SELECT * FROM h2), h3 AS (SELECT DISTINCT s, object AS o FROM h2 JOIN edge ON subject = o),
r AS (SELECT (SELECT count(*) FROM h12) / (n * (n - 1)) AS p2, (SELECT count(*) FROM (SELECT * FROM h12 UNION SELECT * FROM h3)) / (n * (n - 1)) AS p3 FROM (SELECT count(*) AS n FROM st))
SELECT round(p2, 4) AS reachable_2hop, round(p3, 4) AS reachable_3hop, round(least(100, (p2 + p3) / 2 * 200), 1) AS health_score, CASE WHEN (p2 + p3) / 2 < 0.1 THEN 'red' WHEN (p2 + p3) / 2 < 0.3 THEN 'yellow' ELSE 'green' END AS flag FROM r""",
    "similar_names": f"""WITH {_ENT}, n AS (SELECT DISTINCT lower(trim(name)) AS name FROM ent), s AS (SELECT name, list_distinct(list_transform(range(1, length(name) - 1), lambda i: substring(name, i, 3))) AS s FROM n WHERE length(name) >= 3),
r AS (SELECT min(name) AS name, s FROM (SELECT name, list_sort(s) AS s FROM s) GROUP BY s), x AS (SELECT name, len(s) AS n, unnest(s) AS g FROM r), p AS (SELECT a.name AS a, b.name AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.name < b.name GROUP BY 1, 2)
SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM p WHERE c / (na + nb - c) >= 0.85 - 1e-12""",
    "token_f1": f"{_F1} SELECT item_id, round(f1, 6) AS f1 FROM m",
    "answer_metrics": f"{_F1} SELECT type, round(avg(f1), 4) AS accuracy, round(avg(h::INT), 4) AS hallucination_rate, round(greatest(0, 1 - coalesce(stddev_pop(n) / nullif(avg(n), 0), 0)), 4) AS consistency, round(avg(n), 4) AS words FROM m GROUP BY type",
    "sft_scores": f"""WITH q AS (SELECT DISTINCT item_id, question, answer, evidence FROM qa_items WHERE question IS NOT NULL AND answer IS NOT NULL),
i AS (SELECT item_id, answer, evidence, list_filter(list_distinct({_w('lower(question)')}), lambda x: NOT list_contains({_STOP}, x)) AS i, {_w('lower(answer)')} AS r, {_w('answer')} AS w FROM q)
SELECT item_id, round(CASE WHEN len(i) > 0 THEN len(list_intersect(i, r)) / len(i) ELSE 0.5 END, 6) AS relevancy,
  len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '^\\p{{Lu}}') AND NOT contains(lower(coalesce(evidence, '')), lower(x)))) = 0 AS faithful FROM i""",
    "bigram_diversity": f"""WITH q AS (SELECT DISTINCT item_id, question FROM qa_items WHERE question IS NOT NULL), w AS (SELECT {_w('lower(question)')} AS w FROM q), b AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])) AS b FROM w WHERE len(w) > 1)
SELECT count(DISTINCT b) AS distinct_bigrams, count(*) AS bigrams, round(count(DISTINCT b) / count(*), 6) AS diversity FROM b""",
    "source_counts": "SELECT d.doc_id, count(a.doc_id) AS n FROM (SELECT DISTINCT doc_id FROM source_documents WHERE doc_id IS NOT NULL) d LEFT JOIN source_audit a ON a.doc_id = d.doc_id AND a.decision = 'accepted' GROUP BY 1",
    "curation_report": "SELECT decision, count(*) AS n, min(word_count) AS least, max(word_count) AS most, round(avg(char_count), 4) AS mean_chars FROM source_audit GROUP BY decision",
    "single_hop_qa": f"""WITH {_ENT}, t AS (SELECT t.pos, a.name AS s, replace(predicate, '_', ' ') AS r, b.name AS o FROM triples t JOIN ent a ON t.subject = a.id JOIN ent b ON t.object = b.id WHERE upper(predicate) NOT IN {graph.STRUCTURAL!s})
SELECT pos, 0 AS k, 'What does ' || s || ' ' || r || '?' AS question, o AS answer FROM t UNION ALL SELECT pos, 1, 'Who or what ' || r || ' ' || o || '?', s FROM t UNION ALL SELECT pos, 2, 'How are ' || s || ' and ' || o || ' related?', s || ' ' || r || ' ' || o FROM t""",
    "two_hop_paths": f"{_G}, st AS (SELECT id FROM node ORDER BY id LIMIT 200) SELECT st.id AS a, x.object AS b, y.object AS c FROM st JOIN edge x ON x.subject = st.id AND x.object <> st.id JOIN edge y ON y.subject = x.object AND y.object <> y.subject WHERE y.object <> st.id QUALIFY row_number() OVER (PARTITION BY st.id ORDER BY x.object, y.object) <= 20",
    "comparison_pairs": f"""{_G}{_REACH}, top AS (SELECT id, type FROM (SELECT DISTINCT id, type FROM node WHERE type IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY type ORDER BY id) <= 10), n AS (SELECT DISTINCT type, id, b AS n FROM top JOIN und ON und.a = id)
SELECT x.type, x.id AS a, y.id AS b, array_to_string(list_sort(list(DISTINCT x.n))[1:5], ';') AS shared FROM n x JOIN n y ON x.type = y.type AND x.n = y.n AND x.id < y.id GROUP BY 1, 2, 3""",
    "version_status": """WITH d AS (SELECT doc_id, content, pos FROM source_documents WHERE doc_id IS NOT NULL AND content IS NOT NULL), a AS (SELECT doc_id, max(sha256(content)) AS h FROM d WHERE pos % 7 <> 1 GROUP BY 1), b AS (SELECT doc_id, max(sha256(CASE WHEN pos % 7 = 3 THEN content || '!' ELSE content END)) AS h FROM d WHERE pos % 7 <> 2 GROUP BY 1)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'new' WHEN b.doc_id IS NULL THEN 'absent' WHEN a.h = b.h THEN 'unchanged' ELSE 'replaced' END AS status FROM a FULL JOIN b ON a.doc_id = b.doc_id""",
    "replaced_documents": f"""WITH {_TRI}, gone AS (SELECT DISTINCT source_chunk_id AS c FROM tri WHERE pos % 5 = 0 AND source_chunk_id IS NOT NULL), e AS (SELECT DISTINCT subject, object FROM tri), p AS (SELECT subject, object, source_chunk_id AS v, min(pos) AS pos FROM tri WHERE source_chunk_id IS NOT NULL AND source_chunk_id <> '' GROUP BY ALL),
k AS (SELECT subject, object, string_agg(v, ';' ORDER BY pos) FILTER (v NOT IN (SELECT c FROM gone)) AS chunks, count(*) AS n FROM p GROUP BY 1, 2) SELECT e.subject, e.object, coalesce(chunks, '') AS chunks FROM e LEFT JOIN k ON e.subject = k.subject AND e.object = k.object WHERE k.n IS NULL OR chunks IS NOT NULL""",
    "graph_search": f"{_G} SELECT id, name, (SELECT count(*) FROM edge WHERE subject = id) + (SELECT count(*) FROM edge WHERE object = id) AS degree FROM node WHERE contains(lower(name), 'museum') ORDER BY degree DESC, id LIMIT 25",
    "weak_components": f"{_G.replace('WITH', 'WITH RECURSIVE', 1)}{_REACH}, reach(a, b) AS (SELECT id, id FROM node UNION SELECT reach.a, und.b FROM reach JOIN und ON reach.b = und.a) SELECT a AS id, min(b) AS component FROM reach GROUP BY a",
    "grouped_split": "SELECT DISTINCT item_id, CASE WHEN ('0x' || substring(sha256('42:' || coalesce(_group_id, '')), 1, 13))::BIGINT / 4503599627370496.0 < 0.2 THEN 'test' ELSE 'train' END AS split FROM qa_items",
    "knowledge_edges": f"""{_G}, d AS (SELECT subject, object, arg_max(description, pos) FILTER (description <> '') AS description FROM tri GROUP BY 1, 2)
SELECT 'edge:' || substring(sha256(subject || chr(31) || object || chr(31) || description), 1, 20) AS id, subject AS source, object AS target FROM d WHERE description IS NOT NULL""",
    "inferred_relations": f"""WITH {_ENT}, {_TRI}, r(h, o, p, i) AS (VALUES {", ".join(str((*x, i)) for i, x in enumerate(extract.RELATIONS))}),
t AS (SELECT tri.pos, subject AS s, object AS o, coalesce(a.type, 'ENTITY') AS st, coalesce(b.type, 'ENTITY') AS ot FROM tri JOIN ent a ON a.id = subject JOIN ent b ON b.id = object),
m AS (SELECT t.pos, t.s, t.o, st, ot, arg_min({{'p': r.p, 'f': r.h = st AND r.o = ot}}, r.i) AS x FROM t LEFT JOIN r ON (r.h = st AND r.o = ot) OR (r.h = ot AND r.o = st) GROUP BY ALL),
y AS (SELECT pos, coalesce(x.p, CASE WHEN st = ot THEN 'related_to' ELSE 'associated_with' END) AS p, CASE WHEN coalesce(x.f, true) THEN s ELSE o END AS a, CASE WHEN coalesce(x.f, true) THEN o ELSE s END AS b FROM m)
SELECT pos, CASE WHEN p IN {_SYM} AND b < a THEN b ELSE a END AS subject, p AS predicate, CASE WHEN p IN {_SYM} AND b < a THEN a ELSE b END AS object FROM y""",
    "token_balance": rf"""WITH RECURSIVE q AS (SELECT item_id, split, min(len(regexp_extract_all(question || chr(10) || coalesce(answer, ''), '[\pL\pN_]+|[^\pL\pN_\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ]'))) AS n FROM qa_items WHERE question IS NOT NULL GROUP BY 1, 2),
budget AS (SELECT coalesce(sum(n), 0) AS b FROM q WHERE split <> 'train'), t AS (SELECT item_id, n, row_number() OVER (ORDER BY item_id) AS i FROM q WHERE split = 'train'),
f(i, used, kept) AS (SELECT 1::BIGINT, n::BIGINT, true FROM t WHERE i = 1 UNION ALL SELECT t.i, CASE WHEN f.used < b AND f.used + n <= b THEN f.used + n ELSE f.used END, f.used < b AND f.used + n <= b FROM f JOIN t ON t.i = f.i + 1, budget)
SELECT item_id, n FROM t JOIN f USING (i) WHERE kept""",
    "coverage_scores": rf"""WITH {_ENT}, k AS (SELECT *, {{kg}} AS kn FROM ent), t AS (SELECT t.pos, a.kn AS a, lower(predicate) AS p, b.kn AS b FROM triples t JOIN k a ON t.subject = a.id JOIN k b ON t.object = b.id),
n AS (SELECT DISTINCT kn FROM k WHERE confidence > 0.5), h AS (SELECT DISTINCT a, p, b FROM t WHERE pos % 2 = 0), u AS (SELECT a, b FROM h UNION SELECT b, a FROM h),
f AS (SELECT *, (a, p, b) IN (SELECT (a, p, b) FROM h) AS e, (a, b) IN (SELECT (a, b) FROM u) AS c, a IN (SELECT kn FROM n) AND b IN (SELECT kn FROM n) AS m FROM t)
SELECT count(*) AS facts, count(*) FILTER (e) AS exact, count(*) FILTER (c) AS connected, count(*) FILTER (m) AS mentioned, round(0.5 * avg(e::INT) + 0.3 * avg(c::INT) + 0.2 * avg(m::INT), 4) AS coverage FROM f""".replace("{{kg}}", "{kg}").replace("{kg}", rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), '^{T.WS}+|{T.WS}+$', '', 'g'), '^(?:the|a|an){T.WS}+', ''), '[,;:.!?\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ]+$', ''), '{T.WS}+', ' ', 'g'), '^{T.WS}+|{T.WS}+$', '', 'g')"),
    "kg_quality": f"""{_G.replace('WITH', 'WITH RECURSIVE', 1)}{_REACH}, reach(a, b) AS (SELECT id, id FROM node UNION SELECT reach.a, und.b FROM reach JOIN und ON reach.b = und.a), comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY a),
e AS (SELECT avg((coalesce(name, '') <> '')::INT) AS hn, avg((coalesce(type, '') <> '')::INT) AS ht, avg((coalesce(len(aliases), 0) > 0)::INT) AS ha, avg((coalesce(type, '') IN ('', 'UNKNOWN') OR coalesce(len(aliases), 0) = 0)::INT) AS miss,
  avg((coalesce(type, '') NOT IN ('', 'ENTITY', 'UNKNOWN', 'NAMED_ENTITY', 'CONCEPT'))::INT) AS lab, avg((coalesce(type, '') NOT IN ('ENTITY', 'UNKNOWN', 'Chunk', 'Document'))::INT) AS mean, avg((coalesce(description, '') <> '')::INT) AS des, 1 - count(DISTINCT lower(name)) / count(*) AS dup FROM ent),
t AS (SELECT avg((subject IS NULL OR object IS NULL OR subject NOT IN (SELECT id FROM node) OR object NOT IN (SELECT id FROM node))::INT) AS loose, 1 - count(DISTINCT coalesce(subject, '') || chr(31) || coalesce(predicate, '') || chr(31) || coalesce(object, '')) / count(*) AS dup, avg((coalesce(subject, '') = '' OR coalesce(predicate, '') = '' OR coalesce(object, '') = '')::INT) AS bad FROM triples),
n AS (SELECT avg((type IS NULL OR type IN ('UNKNOWN', ''))::INT) AS un, count(*) AS n FROM node), g AS (SELECT max(k) AS big FROM (SELECT count(*) AS k FROM comp GROUP BY c)),
r AS (SELECT (hn + ht + ha) / 3 AS completeness, ((1 - loose) + (1 - un)) / 2 AS consistency, (e.dup + t.dup) / 2 AS duplication_level, miss AS missing_information, bad AS format_errors, lab AS labeling_quality, 0.4 + 0.2 * big / n.n + 0.2 * mean + 0.2 * des AS reusability FROM e, t, n, g)
SELECT round(completeness, 6) AS completeness, round(consistency, 6) AS consistency, round(duplication_level, 6) AS duplication_level, round(missing_information, 6) AS missing_information, round(format_errors, 6) AS format_errors, round(labeling_quality, 6) AS labeling_quality, round(reusability, 6) AS reusability,
  round((completeness + consistency + labeling_quality + reusability + 1 - duplication_level + 1 - format_errors + 1 - missing_information) / 7, 6) AS overall FROM r""",
    "bio_spans": f"""WITH q AS (SELECT DISTINCT item_id, {_w('question')} AS w FROM qa_items WHERE question IS NOT NULL), x AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM q),
g AS (SELECT *, i - row_number() OVER (PARTITION BY item_id ORDER BY i) AS g FROM x WHERE regexp_matches(word, '^[A-Z][a-z]+')) SELECT item_id, min(i) AS start, string_agg(word, ' ' ORDER BY i) AS text FROM g GROUP BY item_id, g""",
    "incremental_match": f"""WITH {_ENT}, e AS (SELECT ('0x' || substring(md5(id), 1, 15))::BIGINT AS pos, coalesce(type, '') AS type, list_distinct({_w('lower(name)')}) AS s FROM ent),
p AS (SELECT a.pos, b.pos AS id, len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) AS sim FROM e a JOIN e b ON a.type = b.type AND a.pos % 4 = 0 AND b.pos % 4 <> 0 WHERE len(list_intersect(a.s, b.s)) > 0),
m AS (SELECT pos, arg_max({{'id': id, 'sim': sim}}, {{'s': sim, 'n': -id}}) AS m FROM p WHERE sim >= 0.6 GROUP BY pos)
SELECT e.pos, m.m.id AS stored_id, m.m.sim AS similarity FROM e LEFT JOIN m ON e.pos = m.pos WHERE e.pos % 4 = 0""",
    "semantic_clusters": """WITH RECURSIVE l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.42),
reach(a, b) AS (SELECT a, a FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a) SELECT a AS vec_id, min(b) AS cluster FROM reach GROUP BY a""",
}


# Folds as recursion over rows in order: each row joins or leaves the list of kept ones by its earlier neighbours.
_KEEP = """ord AS (SELECT pos, row_number() OVER (ORDER BY pos) AS i FROM base), nb AS (SELECT b, list(a) AS l FROM near GROUP BY b), seq AS (SELECT ord.i, ord.pos, coalesce(nb.l, []) AS l FROM ord LEFT JOIN nb ON nb.b = ord.pos),
fold(i, pos, canon, kept) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, []::BIGINT[] UNION ALL
  SELECT seq.i, seq.pos, coalesce(list_min(list_intersect(fold.kept, seq.l)), seq.pos), CASE WHEN len(list_intersect(fold.kept, seq.l)) = 0 THEN list_append(fold.kept, seq.pos) ELSE fold.kept END FROM fold JOIN seq ON seq.i = fold.i + 1)"""
_NUM = f"{_ENT}, num AS (SELECT ('0x' || substring(md5(id), 1, 15))::BIGINT AS pos, id, name, coalesce(type, '') AS type, aliases, confidence, list_distinct({_w('lower(name)')}) AS t FROM ent)"
_RESOLVED = f"""WITH RECURSIVE {_NUM}, base AS (SELECT pos FROM num), near AS (SELECT a.pos AS a, b.pos AS b FROM num a JOIN num b ON a.type = b.type AND a.pos < b.pos WHERE len(a.t) > 0 AND len(b.t) > 0 AND len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) >= 0.6 - 1e-12), {_KEEP},
res AS (SELECT pos, canon FROM fold WHERE i > 0)"""
_MERGED = f"""{_RESOLVED}, cluster AS (SELECT canon, arg_max(name, {{'c': coalesce(confidence, 0), 'l': coalesce(length(name), -1), 'p': -num.pos}}) AS name, arg_max(type, {{'c': coalesce(confidence, 0), 'l': coalesce(length(name), -1), 'p': -num.pos}}) AS type, count(*) AS members FROM num JOIN res USING (pos) GROUP BY canon)"""
SQL |= {
    "entity_resolution": f"{_RESOLVED} SELECT pos, canon AS canonical_pos FROM res",
    "entity_clusters": f"{_MERGED} SELECT canon AS canonical_pos, name, members FROM cluster",
    "id_map": f"""{_MERGED}, al AS (SELECT canon, lower(a) AS k FROM (SELECT canon, unnest(aliases) AS a FROM num JOIN res USING (pos)) WHERE a IS NOT NULL UNION SELECT canon, lower(name) FROM cluster),
ix AS (SELECT type, k, max(canon) AS id FROM al JOIN cluster USING (canon) GROUP BY 1, 2) SELECT num.pos, coalesce(ix.id, num.pos) AS id FROM num LEFT JOIN ix ON ix.type = num.type AND ix.k = lower(num.name)""",
    "shard_plan": f"""WITH RECURSIVE r AS (SELECT pos, coalesce(len({_w('content')}), 0)::BIGINT AS tokens FROM source_documents), o AS (SELECT *, row_number() OVER (ORDER BY sha256(':' || pos)) AS i FROM r),
f(i, pos, tokens, shard, used) AS (SELECT i, pos, tokens, 0, tokens FROM o WHERE i = 1 UNION ALL SELECT o.i, o.pos, o.tokens, CASE WHEN f.used > 0 AND f.used + o.tokens > 2000 THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.used > 0 AND f.used + o.tokens > 2000 THEN o.tokens ELSE f.used + o.tokens END FROM f JOIN o ON o.i = f.i + 1)
SELECT pos, 0 AS lane, shard, tokens FROM f""",
    "pagerank": f"""{_G.replace('WITH', 'WITH RECURSIVE', 1)}, w AS (SELECT subject AS s, object AS o, weight::DOUBLE / sum(weight) OVER (PARTITION BY subject) AS p FROM edge), n AS (SELECT DISTINCT id FROM node), m AS (SELECT count(*)::DOUBLE AS m FROM n),
pr(k, id, rank, delta) AS (SELECT 0, id, 1.0::DOUBLE / m, 1e9::DOUBLE FROM n, m UNION ALL SELECT k + 1, id, fresh, sum(abs(fresh - rank)) OVER () FROM (
  SELECT pr.k, pr.id, pr.rank, 0.15 / m + 0.85 * (coalesce(x.x, 0) + d.d / m) AS fresh FROM pr LEFT JOIN (SELECT w.o, sum(w.p * q.rank) AS x FROM w JOIN pr q ON w.s = q.id GROUP BY w.o) x ON x.o = pr.id, (SELECT coalesce(sum(rank), 0) AS d FROM pr WHERE id NOT IN (SELECT s FROM w)) d, m WHERE pr.delta >= 1e-4 * m AND pr.k < 100))
SELECT id, round(rank, 6) AS rank FROM pr WHERE k = (SELECT max(k) FROM pr)""",
}
