"""Queries of text functions and filters over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.unicode import html_to_text, stable_ids, unicode_repair
from millrace.operators.graph import latest
from millrace.operators.quality import quality_profile
from millrace.session import table
from millrace.sources import web


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text is not null")


def clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.clean_english(F.col("text"))).alias("clean_md5"))


def curation_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.curation_spaces(F.col("text"))).alias("text_md5"))


def repaired_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.length(unicode_repair("text")).alias("n"), F.md5(unicode_repair("text")).alias("md5"))


def token_counts(spark, sf_dir):
    c = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", T.token_count(c).cast("long").alias("tokens"), T.regex_token_count(c).cast("long").alias("regex_tokens"), F.greatest(T.regex_token_count(c), F.lit(1)).cast("long").alias("qa_tokens"))


def char_ngrams_count(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.size(F.array_distinct(T.char_ngrams(F.col("text"), 3))).cast("long").alias("trigrams"), F.size(T.char_ngrams(F.col("text"), 4)).cast("long").alias("fourgrams"))


def word_shingles_count(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.size(T.word_shingles(F.col("text"), 5)).cast("long").alias("shingles"))


def sentence_split(spark, sf_dir):
    s = T.sentences(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(s).cast("long").alias("sentences"), F.md5(F.array_join(s, "|")).alias("md5"))


def page_stats(spark, sf_dir):
    c = F.col("text")
    u = T.unique_chars(c)
    return _docs(spark, sf_dir).select("doc_id", u.cast("long").alias("unique_chars"), F.round(F.coalesce(F.try_divide(u.cast("double"), F.length(c)), F.lit(0.0)), 6).alias("density"), F.round(T.unique_line_ratio(c), 6).alias("unique_line_ratio"))


def page_gates(spark, sf_dir):
    return _docs(spark, sf_dir).where(web.page_gates(F.col("text"), least_unique=40)).select("doc_id")


def page_kinds(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.content_type(F.col("url"), F.col("text")).alias("kind"))


def article_urls(spark, sf_dir):
    """Addresses on hosts with and without a rule, made of page numbers, at depths 0 and 1."""
    d = table(spark, sf_dir, "documents").where("url is not null").select("doc_id", F.element_at(F.split("url", "/"), -1).alias("tail"))
    site = F.element_at(F.array(*[F.lit(x) for x in ("https://www.tuoitre.vn/the-gioi/", "https://vnexpress.net/the-gioi/", "https://mof.gov.vn/", "https://other.example/")]), (F.col("doc_id") % 4 + 1).cast("int"))
    url = F.concat(site, F.lit("bai-"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, ".htm").when(F.col("doc_id") % 3 == 1, ".html").otherwise("/x"))
    depth = (F.col("doc_id") % 5 > 0).cast("int")
    return d.select("doc_id", url.alias("url"), T.is_article(url, depth).alias("article"))


def furniture_lines(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.drop_furniture(F.col("text"))).alias("md5"))


def boilerplate_removed(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.drop_boilerplate(F.col("text"))).alias("md5"))


def topic_filter(spark, sf_dir):
    t = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.substring("text", 1, 2000))
    return _docs(spark, sf_dir).where(t.rlike("(?iu)(?:harvest|mùa|railway|thuế)")).select("doc_id")


def relation_types(spark, sf_dir):
    return table(spark, sf_dir, "triples").groupBy(T.sanitize_relation(F.col("predicate")).alias("relation")).agg(F.count("*").alias("n"))


def entity_acronyms(spark, sf_dir):
    e = table(spark, sf_dir, "entities").select("node_id", "name").distinct()
    return e.select("node_id", "name", T.acronym(F.col("name")).alias("acronym"), T.compact(F.col("name")).alias("compact"), T.kg_name(F.col("name")).alias("kg_name"))


def provenance_keys(spark, sf_dir):
    m = T.provenance(F.col("metadata"))
    return table(spark, sf_dir, "source_documents").select("pos", F.coalesce(F.size(m), F.lit(-1)).cast("long").alias("entries"), F.element_at(m, "title").alias("title"), F.element_at(m, "url").alias("url"), F.element_at(m, "license").alias("license"))


def record_ids(spark, sf_dir):
    """Ids that occur again get the start of their content's hash, then their position, as a suffix."""
    d = table(spark, sf_dir, "source_documents").where("doc_id is not null")
    first = d.groupBy("doc_id").agg(F.min("pos").alias("first"))
    h = F.substring(F.sha2(F.coalesce("content", F.lit("")), 256), 1, 8)
    return d.join(first, "doc_id").select("pos", F.when(F.col("pos") == F.col("first"), F.col("doc_id")).otherwise(F.concat_ws("-", "doc_id", h)).alias("record_id"))


def entity_snippets(spark, sf_dir):
    docs = table(spark, sf_dir, "source_documents").where("content is not null").select("doc_id", "content").distinct()
    e = table(spark, sf_dir, "entities").select("node_id", "name", "source").distinct()
    return e.join(docs, F.col("source") == F.col("doc_id")).select("node_id", "name", T.snippet(F.col("content"), F.col("name")).alias("snippet"))


def evidence_lookup(spark, sf_dir):
    """The first sentence of a record with both ends of each of its triples."""
    t = table(spark, sf_dir, "triples").where("object is not null and source_chunk_id is not null").select("pos", "subject", "object", F.substring_index("source_chunk_id", "#", 1).alias("doc_id"))
    names = latest(table(spark, sf_dir, "entities"), "node_id", "updated_at", "name").select("node_id", "name")
    docs = table(spark, sf_dir, "source_documents").where("content is not null").select("doc_id", "content").distinct()
    t = t.join(names.select(F.col("node_id").alias("subject"), F.col("name").alias("s")), "subject").join(names.select(F.col("node_id").alias("object"), F.col("name").alias("o")), "object").join(docs, "doc_id")
    return t.select("pos", T.evidence_for(T.evidence_sentences(F.col("content")), F.col("s"), F.col("o")).alias("evidence"))


def edge_ids(spark, sf_dir):
    return table(spark, sf_dir, "triples").select("pos", T.edge_id(F.col("subject"), F.col("object"), F.col("description")).alias("edge_id"))


def entity_ids(spark, sf_dir):
    e = table(spark, sf_dir, "entities").select("label", "name").distinct()
    return e.select("label", "name", stable_ids("entity")(F.coalesce("label", F.lit("")), F.col("name")).alias("id"))


def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").select("pos", F.sha2("content", 256).alias("content_hash"))


def chat_lines(spark, sf_dir):
    q = table(spark, sf_dir, "qa_items").where("question is not null and answer is not null").select("item_id", "question", "answer").distinct()
    return q.where(T.strip(F.col("answer")) != "").select("item_id", F.md5(T.chat_text(F.col("question"), F.col("answer"))).alias("md5"))


def json_salvage(spark, sf_dir):
    """Replies that are a JSON object, have one in prose or in a fence, or break off, read back."""
    q = table(spark, sf_dir, "qa_items").select("item_id", "type", "hops").distinct()
    body, k = F.to_json(F.struct("type", "hops")), F.col("item_id") % 4
    reply = F.when(k == 0, body).when(k == 1, F.concat(F.lit("Here it is: "), body, F.lit(" Done."))).when(k == 2, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(F.concat(F.lit("So: "), F.regexp_replace(body, "\\}$", "")))
    return q.select("item_id", F.get_json_object(T.json_block(reply), "$.type").alias("type"), F.get_json_object(T.json_block(reply), "$.hops").cast("int").alias("hops"))


def html_pages(spark, sf_dir):
    """Pages made of a record's title and text, read back as text."""
    d = _docs(spark, sf_dir).where("title is not null")
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><title>"), esc(F.col("title")), F.lit("</title><script>x()</script></head><body><p>"), F.replace(esc(F.col("text")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p></body></html>"))
    return d.select("doc_id", html_to_text(page).alias("h")).select("doc_id", "h.title", F.length("h.text").alias("n"))


def quality_profiles(spark, sf_dir):
    d = table(spark, sf_dir, "source_documents").select("pos", "content", F.element_at("metadata", "lang").alias("lang"))
    p = quality_profile(F.col("content"), F.coalesce("lang", F.lit("en")))
    d = d.where("content is not null").select("pos", p.alias("p")).select("pos", "p.*")
    return d.select("pos", F.round("score", 6).alias("score"), F.col("char_count").cast("long").alias("char_count"), F.col("word_count").cast("long").alias("word_count"), F.round("symbol_ratio", 6).alias("symbol_ratio"), F.round("repeated_line_ratio", 6).alias("repeated_line_ratio"), F.array_join("rejection_reasons", ";").alias("rejections"), F.array_join("review_flags", ";").alias("flags"))


def quality_filter(spark, sf_dir):
    d = table(spark, sf_dir, "source_documents").where("content is not null")
    return d.where(F.size(quality_profile(F.col("content"), F.lit("en"))["rejection_reasons"]) == 0).select("pos")


def quality_report(spark, sf_dir):
    """Reasons and flags over all records, with their number."""
    d = quality_profiles(spark, sf_dir)
    each = d.select(F.explode(F.filter(F.split(F.concat_ws(";", "rejections", "flags"), ";"), lambda x: x != "")).alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n"))


NAMES = (
    "clean_text curation_text repaired_text token_counts char_ngrams_count word_shingles_count sentence_split page_stats page_gates page_kinds article_urls furniture_lines boilerplate_removed "
    "topic_filter relation_types entity_acronyms provenance_keys record_ids entity_snippets evidence_lookup edge_ids entity_ids content_hashes chat_lines json_salvage html_pages quality_profiles quality_filter quality_report"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

_WS = T.WS
_STRIP = f"'^{_WS}+|{_WS}+$', '', 'g'"


def _words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{_WS}+'), lambda x: x <> '')"


_QUALITY = rf"""
WITH d AS (SELECT pos, content, coalesce(metadata['lang'], 'en') AS lang FROM source_documents WHERE content IS NOT NULL),
m AS (SELECT *, length(content) AS n, {_words('content')} AS w,
  len(regexp_extract_all(content, '[^\pL\pN\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ]')) AS sym,
  list_filter(list_transform(string_split_regex(content, '\r\n|[\n\r\x{{b}}\x{{c}}\x{{1c}}-\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> '') AS l FROM d),
p AS (SELECT *, sym / greatest(n, 1) AS sr, CASE WHEN len(l) > 1 THEN list_max(map_values(list_histogram(l))) / len(l) ELSE 0 END AS rep,
  list_filter(w, lambda x: regexp_full_match(x, '[\pL\pM]+')) AS alpha FROM m)
SELECT pos, round((least(n / 200, 1) + least(len(w) / 30, 1) + greatest(0, 1 - sr / 0.4) + greatest(0, 1 - rep)) / 4, 6) AS score, n AS char_count, len(w) AS word_count,
  round(sr, 6) AS symbol_ratio, round(rep, 6) AS repeated_line_ratio,
  concat_ws(';', CASE WHEN len(w) = 0 THEN 'empty_content' END, CASE WHEN contains(content, chr(65533)) THEN 'invalid_unicode_replacement' END, CASE WHEN n < 50 THEN 'too_short_characters' END, CASE WHEN len(w) < 10 THEN 'too_short_words' END) AS rejections,
  concat_ws(';', CASE WHEN sr > 0.4 THEN 'excessive_symbols' END, CASE WHEN rep > 0.3 AND len(l) > 1 THEN 'repeated_lines' END,
    CASE WHEN list_bool_or(list_transform(range(1, greatest(n - 8, 1)), lambda i: substring(content, i, 10) = repeat(substring(content, i, 1), 10))) THEN 'repeated_characters' END,
    CASE WHEN lang <> 'vi' AND len(alpha) > 20 AND len(list_filter(alpha, lambda x: length(x) <= 2)) / len(alpha) > 0.6 THEN 'short_token_gibberish' END) AS flags
FROM p"""
SQL: dict[str, str] = {
    "token_counts": rf"SELECT doc_id, len({_words('text')}) AS tokens, len(regexp_extract_all(text, '[\pL\pN_]+|[^\pL\pN_\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ]')) AS regex_tokens, greatest(len(regexp_extract_all(text, '[\pL\pN_]+|[^\pL\pN_\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ]')), 1) AS qa_tokens FROM documents WHERE text IS NOT NULL",
    "clean_text": rf"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, {_STRIP}), '\r\n?', chr(10), 'g'), '[\t\f\x{{b}} ]+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, regexp_replace(regexp_replace(t, ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM a)
SELECT doc_id, md5(regexp_replace(replace(replace(translate(t, '“”‘’–', '""''''-'), '—', '--'), '…', '...'), '[\x{{0}}-\x{{8}}\x{{b}}\x{{c}}\x{{e}}-\x{{1f}}\x{{7f}}-\x{{9f}}]', '', 'g')) AS clean_md5 FROM b""",
    "curation_text": rf"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[\x{{0}}-\x{{8}}\x{{b}}-\x{{1f}}\x{{7f}}-\x{{9f}}]', '', 'g') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[\t ]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), {_STRIP})) AS text_md5 FROM a""",
    "char_ngrams_count": "SELECT doc_id, len(list_distinct(list_transform(range(1, greatest(length(text) - 2, 1) + 1), lambda i: substring(text, i, 3)))) AS trigrams, greatest(length(text) - 3, 1) AS fourgrams FROM documents WHERE text IS NOT NULL",
    "word_shingles_count": f"""WITH w AS (SELECT doc_id, {_words('lower(text)')} AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], chr(31))))) AS shingles FROM w""",
    "sentence_split": rf"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(text, '([.!?…]){_WS}+', '\1' || chr(1), 'g'), '[\x{{1}}\r\n]+'), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(s) AS sentences, md5(array_to_string(s, '|')) AS md5 FROM s""",
    "page_stats": f"""WITH p AS (SELECT doc_id, length(text) AS n, len(list_distinct(list_filter(string_split(text, ''), lambda x: x <> ''))) AS u, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, {_STRIP})), lambda x: length(x) > 5) AS l FROM documents WHERE text IS NOT NULL)
SELECT doc_id, u AS unique_chars, round(CASE WHEN n > 0 THEN u / n ELSE 0 END, 6) AS density, round(CASE WHEN len(l) > 0 THEN len(list_distinct(l)) / len(l) ELSE 0 END, 6) AS unique_line_ratio FROM p""",
    "page_gates": "WITH p AS (SELECT doc_id, length(text) AS n, len(list_distinct(list_filter(string_split(text, ''), lambda x: x <> ''))) AS u FROM documents WHERE text IS NOT NULL) SELECT doc_id FROM p WHERE n >= 50 AND u >= 40 AND u >= 0.01 * n",
    "page_kinds": "SELECT doc_id, CASE WHEN length(text) < 200 THEN 'landing_page' " + " ".join("WHEN " + " OR ".join(f"contains(lower(coalesce(url, '')), '{p}')" for p in ps) + f" THEN '{k}'" for ps, k in ((T.DATASET_URLS, "dataset"), (T.LEGAL_URLS, "legal_document"), (T.ARTICLE_URLS, "article"))) + " WHEN " + " + ".join(f"contains(lower(text), '{g}')::INT" for g in T.GOVERNMENT) + " >= 3 THEN 'government_document' ELSE 'web_page' END AS kind FROM documents WHERE text IS NOT NULL",
    "article_urls": """WITH d AS (SELECT doc_id, '/' || CASE WHEN doc_id % 4 < 2 THEN 'the-gioi/' ELSE '' END || 'bai-' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.htm' WHEN 1 THEN '.html' ELSE '/x' END AS p FROM documents WHERE url IS NOT NULL)
SELECT doc_id, ['https://www.tuoitre.vn', 'https://vnexpress.net', 'https://mof.gov.vn', 'https://other.example'][doc_id % 4 + 1] || p AS url,
  doc_id % 5 = 0 OR CASE doc_id % 4 WHEN 0 THEN regexp_matches(p, '/[a-z-]+/[a-z0-9-]+\\.htm$') WHEN 1 THEN regexp_matches(p, '/[a-z-]+/[a-z0-9-]+-[0-9]+\\.html') ELSE true END AS article FROM d""",
    "topic_filter": "SELECT doc_id FROM documents WHERE text IS NOT NULL AND regexp_matches(lower(concat_ws(' ', coalesce(title, ''), substring(text, 1, 2000))), 'harvest|mùa|railway|thuế')",
    "relation_types": "SELECT upper(regexp_replace(regexp_replace(predicate, '[^A-Za-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g')) AS relation, count(*) AS n FROM triples GROUP BY 1",
    "entity_acronyms": rf"""SELECT DISTINCT node_id, name, CASE WHEN len(regexp_extract_all(lower(name), '[\pL\pN_]+')) >= 2 THEN array_to_string(list_transform(regexp_extract_all(lower(name), '[\pL\pN_]+'), lambda x: substring(x, 1, 1)), '') ELSE '' END AS acronym,
regexp_replace(lower(name), '[^\pL\pN_]', '', 'g') AS compact,
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), {_STRIP}), '^(?:the|a|an){_WS}+', ''), '[,;:.!?\s\x{{b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ]+$', ''), '{_WS}+', ' ', 'g'), {_STRIP}) AS kg_name FROM entities""",
    "provenance_keys": f"""SELECT pos, coalesce(len(list_filter(map_entries(metadata), lambda e: e.key IN {T.PROVENANCE} AND e.value IS NOT NULL AND trim(e.value) <> '')), -1) AS entries,
CASE WHEN trim(metadata['title']) <> '' THEN metadata['title'] END AS title, CASE WHEN trim(metadata['url']) <> '' THEN metadata['url'] END AS url, CASE WHEN trim(metadata['license']) <> '' THEN metadata['license'] END AS license FROM source_documents""",
    "record_ids": "SELECT pos, CASE WHEN pos = min(pos) OVER (PARTITION BY doc_id) THEN doc_id ELSE doc_id || '-' || substring(sha256(coalesce(content, '')), 1, 8) END AS record_id FROM source_documents WHERE doc_id IS NOT NULL",
    "entity_snippets": f"""SELECT e.node_id, e.name, CASE WHEN instr(lower(content), lower(name)) > 0 THEN regexp_replace(substring(content, greatest(instr(lower(content), lower(name)) - 60, 1), instr(lower(content), lower(name)) + length(name) + 60 - greatest(instr(lower(content), lower(name)) - 60, 1)), {_STRIP}) ELSE '' END AS snippet
FROM (SELECT DISTINCT node_id, name, source FROM entities) e JOIN (SELECT DISTINCT doc_id, content FROM source_documents WHERE content IS NOT NULL) d ON e.source = d.doc_id""",
    "evidence_lookup": rf"""WITH n AS (SELECT node_id, arg_max(name, {{'u': updated_at, 'n': name}}) AS name FROM entities GROUP BY node_id),
d AS (SELECT DISTINCT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(content, '([.!?]){_WS}+', '\1' || chr(1), 'g'), '[\x{{1}}\r\n]+'), lambda x: regexp_replace(x, {_STRIP})), lambda x: x <> '') AS s FROM source_documents WHERE content IS NOT NULL)
SELECT t.pos, coalesce(list_filter(d.s, lambda x: contains(lower(x), lower(a.name)) AND contains(lower(x), lower(b.name)))[1], '') AS evidence
FROM triples t JOIN n a ON t.subject = a.node_id JOIN n b ON t.object = b.node_id JOIN d ON d.doc_id = string_split(t.source_chunk_id, '#')[1]""",
    "edge_ids": "SELECT pos, substring(sha256(coalesce(subject, '') || chr(31) || coalesce(object, '') || chr(31) || coalesce(description, '')), 1, 20) AS edge_id FROM triples",
    "content_hashes": "SELECT pos, sha256(content) AS content_hash FROM source_documents",
    "chat_lines": f"SELECT DISTINCT item_id, md5('### Question:' || chr(10) || regexp_replace(question, {_STRIP}) || chr(10) || chr(10) || '### Answer:' || chr(10) || regexp_replace(answer, {_STRIP})) AS md5 FROM qa_items WHERE question IS NOT NULL AND answer IS NOT NULL AND regexp_replace(answer, {_STRIP}) <> ''",
    "json_salvage": "SELECT DISTINCT item_id, CASE WHEN item_id % 4 < 3 THEN type END AS type, CASE WHEN item_id % 4 < 3 THEN hops END AS hops FROM qa_items",
    "quality_profiles": _QUALITY,
    "quality_filter": _QUALITY.replace("SELECT pos, round((least", "SELECT pos FROM (SELECT pos, round((least") + ") WHERE rejections = ''",
    "quality_report": f"SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter(string_split(concat_ws(';', rejections, flags), ';'), lambda x: x <> '')) AS reason FROM ({_QUALITY})) GROUP BY reason",
    "repaired_text": "SELECT doc_id, length(nfc_normalize(text)) AS n, md5(nfc_normalize(text)) AS md5 FROM documents WHERE text IS NOT NULL",
    "furniture_lines": f"""WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, {_STRIP})) >= 3 AND regexp_replace(x, {_STRIP}) NOT IN {T.FURNITURE!s} AND NOT regexp_matches(regexp_replace(x, {_STRIP}), '^({'|'.join(T.FURNITURE_STARTS)})') AND NOT regexp_matches(regexp_replace(x, {_STRIP}), '^\\d{{2}}/\\d{{2}}/\\d{{4}}$|^\\d{{2,4}}$')) AS l FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(regexp_replace(regexp_replace(array_to_string(l, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), {_STRIP})) AS md5 FROM l""",
}
