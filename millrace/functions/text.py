"""Text functions as column expressions; whole-stage code, no Python.

Blanks are Unicode blanks everywhere. Null in, null out, unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One blank, as a regular expression that Java and RE2 read alike.
WS = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\pZ]"
NOT_WS = r"[^\s\x{b}\x{1c}-\x{1f}\x{85}\pZ]"
#: A letter, digit or underscore.
WORD = r"[\pL\pN_]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once per row, however often body (or a lambda in it) uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without blanks at both ends."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def words(c: Column) -> Column:
    """Non-blank runs, in order; an empty array for a blank text."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def clean_english(c: Column) -> Column:
    """Line structure kept, blanks collapsed, typographic quotes, dashes and ellipses plain, control characters gone."""
    c = F.regexp_replace(strip(c), r"\r\n?", "\n")
    c = F.regexp_replace(c, r"[\t\f\x{b} ]+", " ")
    c = F.regexp_replace(F.regexp_replace(c, " *\n *", "\n"), "\n{3,}", "\n\n")
    c = F.translate(c, "“”‘’–", "\"\"''-")
    c = F.replace(F.replace(c, F.lit("—"), F.lit("--")), F.lit("…"), F.lit("..."))
    return F.regexp_replace(c, r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}-\x{9f}]", "")


def curation_spaces(c: Column) -> Column:
    """The curation form of an already composed text: control characters go, quotes and dashes stay."""
    c = F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"[\x{0}-\x{8}\x{b}-\x{1f}\x{7f}-\x{9f}]", "")
    c = F.regexp_replace(F.regexp_replace(c, r"[\t ]+", " "), " *\n *", "\n")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def char_ngrams(c: Column, n: int) -> Column:
    """All substrings of n characters in order; a shorter text is its only one."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - F.lit(n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))


def word_shingles(c: Column, n: int = 5) -> Column:
    """Distinct runs of n lower-case words joined by U+001F; fewer words make one run, none the empty string."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - F.lit(n - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(n)), "\x1f"))
    return let(words(F.lower(c)), lambda w: F.array_distinct(runs(w)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays without repeats; 0 where both are empty."""
    return let(F.size(F.array_intersect(a, b)), lambda both: F.coalesce(F.try_divide(both.cast("double"), F.size(a) + F.size(b) - both), F.lit(0.0)))


def sentences(c: Column) -> Column:
    """Sentences of the chunker: cut after . ! ? … before blanks, and at line ends."""
    parts = F.split(c, f"(?<=[.!?…]){WS}+|[\r\n]+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def evidence_sentences(c: Column) -> Column:
    """Sentences of the relation extractor: cut after . ! ? before blanks, and at line ends."""
    parts = F.split(c, f"(?<=[.!?]){WS}+|[\r\n]+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def evidence_for(parts: Column, a: Column, b: Column) -> Column:
    """The first sentence that contains both names in any case, else the empty string."""
    hit = F.filter(parts, lambda s: F.contains(F.lower(s), F.lower(a)) & F.contains(F.lower(s), F.lower(b)))
    return F.coalesce(F.get(hit, F.lit(0)), F.lit(""))


def token_count(c: Column) -> Column:
    """Number of non-blank runs."""
    return F.size(words(c))


def regex_token_count(c: Column) -> Column:
    """Number of words and single signs."""
    return F.regexp_count(c, F.lit(f"{WORD}+|[^\\pL\\pN_\\s\\x{{b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]"))


def snippet(text: Column, name: Column, width: int = 60) -> Column:
    """The text around the first occurrence of a name in any case; empty if there is none."""
    at = F.instr(F.lower(text), F.lower(name))
    start = F.greatest(at - F.lit(width), F.lit(1))
    return F.when(at > 0, strip(F.substring(text, start, at + F.length(name) + F.lit(width) - start))).otherwise(F.lit(""))


def sanitize_relation(c: Column) -> Column:
    """An identifier: other characters become underscores, none at the ends, upper case."""
    return F.upper(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9_]", "_"), "^_+|_+$", ""))


def compact(c: Column) -> Column:
    """Lower case, word characters only."""
    return F.regexp_replace(F.lower(c), "[^\\pL\\pN_]", "")


def acronym(c: Column) -> Column:
    """First letters of at least two words, in lower case; empty for fewer."""
    w = F.regexp_extract_all(F.lower(c), F.lit(f"{WORD}+"), F.lit(0))
    return F.when(F.size(w) >= 2, F.array_join(F.transform(w, lambda x: F.substring(x, 1, 1)), "")).otherwise(F.lit(""))


def kg_name(c: Column) -> Column:
    """A name for comparison: lower case, no leading article, no closing punctuation, single blanks."""
    c = F.regexp_replace(strip(F.lower(c)), f"^(?:the|a|an){WS}+", "")
    c = F.regexp_replace(c, r"[,;:.!?\s\x{b}\x{1c}-\x{1f}\x{85}\pZ]+$", "")
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def lines(c: Column, longer: int = 0) -> Column:
    """Trimmed lines of more than `longer` characters."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: F.length(x) > longer)


def unique_line_ratio(c: Column) -> Column:
    """Distinct over all lines of more than five characters; 0 without any."""
    return let(lines(c, 5), lambda x: F.coalesce(F.try_divide(F.size(F.array_distinct(x)).cast("double"), F.size(x)), F.lit(0.0)))


def unique_chars(c: Column) -> Column:
    """Number of distinct characters."""
    return F.size(F.array_distinct(F.filter(F.split(c, ""), lambda x: x != "")))


# Lines of public portals that are page furniture.
FURNITURE = (
    "BẢN ĐỒ HÀNH CHÍNH", "Các trang thành phần", "Tiếng chuông", "English 中文", "English", "Trang chủ Báo Điện tử Chính Phủ",
    "© Cục Thông tin và Truyền thông Chính phủ", "Tài liệu đính kèm", "TẬP TIN", "CỔNG DỊCH VỤ CÔNG QUỐC GIA", "Dịch vụ công trực tuyến",
    "Thủ tục hành chính", "Phản ánh kiến nghị", "Xây dựng chính sách", "GÓP Ý DỰ THẢO", "Tải xuống", "Xem toàn văn", "Xem các góp ý", "Gửi góp ý",
    "Gửi phản ánh, kiến nghị", "Tham vấn chính sách", "Chính sách mới", "THÔNG CÁO BÁO CHÍ", "CÁC TRANG THÀNH PHẦN", "Báo Điện tử Chính Phủ",
    "Cổng Thông tin điện tử Chính phủ",
)
# How such lines begin.
FURNITURE_STARTS = ("Số ký hiệu", "Ngày ban hành", "Trích yếu", "/CĐ-TTg", "/VPCP-", "/QĐ-TTg", "/NĐ-CP", "/NQ-CP", "/CT-TTg", "/TB-VPCP", "/QĐ-UBND", "/BTC-")


def drop_furniture(c: Column) -> Column:
    """Without short lines, furniture lines, bare dates and bare page numbers."""
    def keep(line: Column) -> Column:
        s = strip(line)
        bad = (F.length(s) < 3) | s.isin(*FURNITURE) | s.rlike(r"^\d{2}/\d{2}/\d{4}$") | s.rlike(r"^\d{2,4}$")
        for p in FURNITURE_STARTS:
            bad = bad | s.startswith(p)
        return ~bad

    return strip(F.regexp_replace(F.array_join(F.filter(F.split(c, "\n"), keep), "\n"), "\n{3,}", "\n\n"))


# Repeated fragments of public portals.
BOILERPLATE = (
    r"(?:Hà Nội|Lai Châu|Điện Biên|Sơn La|Phú Thọ|Lào Cai|Tuyên Quang|Thái Nguyên|Cao Bằng|Lạng Sơn|Quảng Ninh|Bắc Ninh|Tp Hải Phòng|Tp Huế|Tp Đà Nẵng|Tp Hồ Chí Minh|Tp Cần Thơ)\s*\d{2}°\s*-\s*\d{2}°",
    r"(?s)©\s*Cục Thông tin và Truyền thông Chính phủ\s*Cục trưởng:.*?(?=\n\n|\z)",
    r"(?s)Ghi rõ nguồn\s*'Cổng Thông tin điện tử Chính phủ'.+",
    r"(?s)RadEditor\s*-\s*HTML WYSIWYG Editor\..*?(?=RadEditor's Modules)",
    r"(?s)RadEditor's Modules\s*-.*?(?=\n\n|\z)",
    r"(?s)RadEditor\s*-\s*please enable JavaScript.*?(?=\n|\z)",
    r"(?m)^\s*English\s*$",
    r"(?m)^\s*(?:Trang chủ|Báo Điện tử Chính Phủ)\s*$",
    r"(?s)CỔNG\s*\nDỊCH VỤ CÔNG\s*\nQUỐC GIA.*?(?=Chính sách mới|\n\n|\z)",
    r"(?s)GÓP Ý DỰ THẢO\s*\n.*?(?=\n\n[A-Z]|\z)",
)


def drop_boilerplate(c: Column) -> Column:
    """Repeated fragments give way to a blank, then runs of blanks (line ends too) to one."""
    for p in BOILERPLATE:
        c = F.regexp_replace(c, p, " ")
    return strip(F.regexp_replace(c, f"{WS}{{2,}}", " "))


# Parts of addresses and words of public documents.
DATASET_URLS = ("/dataset", "/data/", "/open-data", "/du-lieu", "/so-lieu")
LEGAL_URLS = ("/thu-tuc", "/van-ban", "/law/", "/legal", "/nghi-dinh", "/thong-tu", "/quyet-dinh")
ARTICLE_URLS = ("/news/", "/tin-tuc", "/tin-", "/article", "/bai-viet", "/thoi-su", "/xa-hoi")
GOVERNMENT = ("chính phủ", "thủ tướng", "bộ trưởng", "quốc hội", "nghị định", "thông tư", "quyết định", "công văn")


def content_type(url: Column, text: Column) -> Column:
    """Kind of a page from its length, address and words; a null address has no signals."""
    u, t = F.lower(F.coalesce(url, F.lit(""))), F.lower(text)
    any_of = lambda parts: F.greatest(*[F.contains(u, F.lit(p)) for p in parts])
    hits = sum((F.contains(t, F.lit(k)).cast("int") for k in GOVERNMENT), F.lit(0))
    return F.when(F.length(text) < 200, "landing_page").when(any_of(DATASET_URLS), "dataset").when(any_of(LEGAL_URLS), "legal_document").when(any_of(ARTICLE_URLS), "article").when(hits >= 3, "government_document").otherwise("web_page")


# Addresses of article pages by host.
ARTICLES = {"tuoitre.vn": r"/[a-z-]+/[a-z0-9-]+\.htm$", "vnexpress.net": r"/(?:tin-tuc-24h|[a-z-]+/[a-z0-9-]+-\d+\.html)", "mof.gov.vn": r"/(?:tin-tuc|van-ban|thong-tin|hoi-dap|.*)"}


def is_article(url: Column, depth: Column) -> Column:
    """Whether an address may be an article: the start page, hosts without a rule, or a match of the host's rule."""
    host = F.regexp_replace(F.parse_url(url, F.lit("HOST")), r"^www\.", "")
    out = F.lit(True)
    for h, p in ARTICLES.items():
        out = F.when(host == h, F.parse_url(url, F.lit("PATH")).rlike(p)).otherwise(out)
    return F.when(depth == 0, True).otherwise(out)


def json_block(c: Column) -> Column:
    """A JSON text out of a reply: fences dropped, the whole if it parses, else its outermost braces."""
    body = F.regexp_replace(strip(c), r"^```(?:json)?\s*|\s*```$", "")
    return F.when(F.try_parse_json(body).isNotNull(), body).otherwise(F.nullif(F.regexp_extract(body, r"(?s)\{.*\}", 0), F.lit("")))


def chat_text(question: Column, answer: Column) -> Column:
    """A conversation as plain text with literal role markers."""
    return F.concat(F.lit("### Question:\n"), strip(question), F.lit("\n\n### Answer:\n"), strip(answer))


#: Metadata keys that travel with a document.
PROVENANCE = ("title", "url", "source_domain", "license", "scraped_at", "lang", "dataset_name", "upload_date")


def provenance(metadata: Column) -> Column:
    """The entries of a metadata map that travel with a document, blank ones dropped."""
    return F.map_filter(metadata, lambda k, v: k.isin(*PROVENANCE) & v.isNotNull() & (F.trim(v) != ""))


def edge_id(*parts: Column) -> Column:
    """Twenty hexadecimal digits of the parts joined by U+001F; null parts count as empty."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 20)


def clean_vietnamese(c: Column) -> Column:
    """clean_english, then composed with repeated marks dropped."""
    from millrace.functions.unicode import unicode_repair

    return unicode_repair(clean_english(c))


def clean_batch(docs: DataFrame, text: str, language: str = "en") -> DataFrame:
    """The documents with a text, in its clean form for a language; null and blank ones are dropped before any work."""
    clean = clean_vietnamese if language == "vi" else clean_english
    return docs.where(F.col(text).rlike(NOT_WS)).withColumn(text, clean(F.col(text)))


def sentence_spans(c: Column) -> Column:
    """array<struct<start,end>>: half-open character spans of sentences, cut at blanks after . ! ? …; blanks between aren't in any span."""
    marked = F.regexp_replace(c, f"(?<=[.!?…])({WS}+)", "\x01$1\x01")
    parts = F.split(marked, "\x01")
    # every second part is a gap; positions are running sums of lengths
    at = F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("i"), F.array().cast("array<struct<start:int,end:int>>").alias("out")), lambda a, p: F.struct((a["n"] + F.length(p)).cast("int").alias("n"), (a["i"] + 1).alias("i"), F.when((a["i"] % 2 == 0) & (p != ""), F.concat(a["out"], F.array(F.struct(a["n"].alias("start"), (a["n"] + F.length(p)).cast("int").alias("end"))))).otherwise(a["out"]).alias("out")), lambda a: a["out"])
    return F.when(c.isNotNull(), at)


def routed(url: Column, routes: dict[str, Column], default: Column) -> Column:
    """The value of the first route whose host is the url's host or above it, else the default: site-specific extractors beside a general one."""
    host = F.lower(F.regexp_replace(F.parse_url(url, F.lit("HOST")), r"^www\.", ""))
    out = default
    for site, value in reversed(routes.items()):
        out = F.when((host == site) | host.endswith("." + site), value).otherwise(out)
    return out


def label_mask(prompt_tokens: Column, answer_tokens: Column, most: int) -> Column:
    """Token labels of a training pair cut at `most` tokens: -100 for the prompt, the answer's own; null where no answer token is left."""
    labels = F.slice(F.concat(F.transform(prompt_tokens, lambda t: F.lit(-100).cast("int")), answer_tokens), 1, most)
    return F.when(F.exists(labels, lambda x: x != -100), labels)
