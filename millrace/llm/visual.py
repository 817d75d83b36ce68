"""One consistent form for text that looks the same but is stored with other characters.

Characters that can't change stay as they are; every other one, with the marks that follow it, is a
cluster. Distinct clusters are exploded to positioned code points, joined with broadcast tables of
decompositions and look-alikes, their marks ordered by combining class, and recomposed; strings are
rebuilt from their positioned pieces. Both tables come from rules over the Unicode character database,
so their size is fixed, and only distinct clusters, not texts, go through them.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.fold import LOOKALIKES
from millrace.session import cut

#: Characters that stand for themselves: ASCII, composed Latin letters but look-alikes, quotes, common scripts without case of their own.
STABLE = r"\x{21}-\x{7e} \n\x{a1}-\x{a7}\x{a9}-\x{ac}\x{ae}\x{b0}\x{b1}\x{b6}\x{b7}\x{bb}-\x{cf}\x{d1}-\x{ef}\x{f1}-\x{130}\x{134}-\x{13e}\x{141}-\x{148}\x{14a}-\x{17e}\x{18f}-\x{1c3}\x{1cd}-\x{1f0}\x{1f4}-\x{24f}\x{1e00}-\x{1e99}\x{1e9e}-\x{1eff}\x{2018}-\x{201f}\x{2020}-\x{2022}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{3400}-\x{9fff}\x{ac00}-\x{d7a3}"
#: Marks and characters without a glyph, which belong to the character before.
MARKS = r"\p{M}\x{ad}\x{34f}\x{61c}\x{115f}\x{1160}\x{17b4}\x{17b5}\x{180b}-\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}\x{ffa0}\x{fff9}-\x{fffb}\x{e0001}\x{e0020}-\x{e007f}"
CLUSTER = f"[^{STABLE}][{MARKS}]*|[{STABLE}][{MARKS}]+"
_HIDDEN = (0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x180F), *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF, 0xFFA0, *range(0xFFF9, 0xFFFC), 0xE0001, *range(0xE0020, 0xE0080), *range(0xE0100, 0xE01F0))
#: Code points with properties of their own: all planes that hold letters, and the tags and selectors of plane 14.
_POINTS = (*range(0x32000), *range(0xE0000, 0xE0200))
_BLANKS = (0x09, 0x0B, 0x0C, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
_HYPHENS = (*range(0x2010, 0x2016), 0x2043, 0x2212, 0xFE58, 0xFE63, 0xFF0D, 0x1806, 0x2E3A)
#: Compatibility forms that look like what they stand for; raised, circled or stacked ones don't.
_LIKE = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<small>")
_CUT = "\uffff"
_NONE = "\uffff"


def _class(java: str) -> str:
    """A character class in Python's notation; marks as the rule finds them."""
    marks = "".join(f"{chr(a)}-{chr(b)}" for a, b in _MARK_RANGES)
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m.group(1), 16))), java).replace(r"\p{M}", marks)


def _mark_ranges() -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for n in _POINTS:
        if unicodedata.category(chr(n))[0] == "M":
            if out and out[-1][1] == n - 1:
                out[-1][1] = n
            else:
                out.append([n, n])
    return [(a, b) for a, b in out]


_MARK_RANGES = _mark_ranges()


@F.pandas_udf(T.BooleanType())
def needs_form(s: pd.Series) -> pd.Series:
    """Whether a text holds anything but stable characters; a regular expression in C over whole batches."""
    odd = re.compile(f"[^{_class(STABLE)}]")
    return s.map(lambda x: x is not None and odd.search(x) is not None).astype(bool)


def _parts(c: str) -> str:
    """A code point, decomposed and with look-alikes replaced."""
    n = ord(c)
    if n in _HIDDEN or (unicodedata.category(c) == "Cc" and n not in (0x09, 0x0A, 0x0B, 0x0C)):
        return ""
    if n in _BLANKS:
        return " "
    if n in _HYPHENS:
        return "-"
    if c in LOOKALIKES:
        return unicodedata.normalize("NFD", LOOKALIKES[c])
    d = unicodedata.decomposition(c)
    if not d or (d[0] == "<" and d.split(" ")[0] not in _LIKE):
        return c
    return "".join(_parts(chr(int(x, 16))) for x in d.split(" ") if x[0] != "<")


def mapping() -> list[tuple[str, list[str]]]:
    """(character, code points) of every character that changes; Hangul syllables, composed and stable, are left out."""
    return [(chr(n), list(p)) for n in _POINTS if not 0xD800 <= n < 0xE000 and not 0xAC00 <= n < 0xD7A4 and (p := _parts(chr(n))) != chr(n)]


def classes() -> list[tuple[str, int]]:
    """(mark, order): combining class, vowel signs before tone signs of the same class."""
    return [(chr(n), 2 * unicodedata.combining(chr(n)) + (n not in (0x302, 0x306, 0x31B))) for n in _POINTS if unicodedata.combining(chr(n))]


def composites() -> dict[str, str]:
    """Pairs of code points and the letter they make up."""
    out = {}
    for n in _POINTS:
        d = unicodedata.decomposition(chr(n))
        if d and d[0] != "<" and " " in d and len(unicodedata.normalize("NFC", chr(n))) == 1 and unicodedata.normalize("NFC", chr(n)) == chr(n):
            out["".join(chr(int(x, 16)) for x in d.split(" "))] = chr(n)
    return out


def cluster_forms(spark: SparkSession, clusters: DataFrame) -> DataFrame:
    """(cluster, form) of distinct clusters."""
    maps = spark.createDataFrame(mapping(), "ch string, parts array<string>")
    order = spark.createDataFrame(classes(), "part string, class int")
    points = clusters.select("cluster", F.posexplode(F.filter(F.split("cluster", ""), lambda x: x != "")).alias("pos", "ch"))
    parts = points.join(F.broadcast(maps), "ch", "left").select("cluster", "pos", F.posexplode(F.coalesce("parts", F.array("ch"))).alias("sub", "part"))
    parts = parts.join(F.broadcast(order), "part", "left").withColumn("class", F.coalesce("class", F.lit(0)))
    w = Window.partitionBy("cluster").orderBy("pos", "sub").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("starter", F.sum((F.col("class") == 0).cast("int")).over(w))
    # repeated marks of one letter count once
    marks = parts.groupBy("cluster", "starter", "class", "part").agg(F.min(F.struct("pos", "sub")).alias("at"))
    each = marks.groupBy("cluster", "starter").agg(F.transform(F.sort_array(F.collect_list(F.struct("class", "at", "part"))), lambda x: x["part"]).alias("parts"))
    pairs = F.from_json(F.lit(json.dumps(composites())), "map<string,string>")
    # recompose: each mark joins the letter so far if the pair has a composite, else it stays behind
    fold = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.struct(F.col("parts")[0].alias("base"), F.lit("").alias("rest")), lambda a, m: F.when(F.element_at(pairs, F.concat(a["base"], m)).isNotNull() & (a["rest"] == ""), F.struct(F.element_at(pairs, F.concat(a["base"], m)).alias("base"), a["rest"].alias("rest"))).otherwise(F.struct(a["base"].alias("base"), F.concat(a["rest"], m).alias("rest"))), lambda a: F.concat(a["base"], a["rest"]))
    letters = each.select("cluster", "starter", fold.alias("form"))
    whole = letters.groupBy("cluster").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("starter", "form"))), lambda x: x["form"]), "").alias("form"))
    return clusters.join(whole, "cluster", "left").select("cluster", F.coalesce("form", F.lit("")).alias("form"))


def visual_forms(texts: DataFrame, text: str) -> DataFrame:
    """The rows of texts with a column `form`: the text in its consistent form, whole.

    Blanks of any kind become one kind, as do hyphens; characters without a glyph and blanks before a
    line end go. Null stays null, an empty text empty. Repeated texts are rebuilt once each; other
    columns are kept as they are; a column named form is replaced.
    """
    spark = texts.sparkSession
    dirty = texts.select(F.col(text).alias("_text")).where(needs_form("_text")).select(F.xxhash64("_text").alias("_id"), F.hash("_text").alias("_jd"), "_text").dropDuplicates(["_id", "_jd"])
    pieces = cut(dirty.select("_id", "_jd", F.posexplode(F.split(F.regexp_replace(F.regexp_replace("_text", r"\r\n?", "\n"), f"({CLUSTER})", f"{_CUT}$1{_CUT}"), _CUT)).alias("pos", "piece")).where("piece <> ''"))
    odd = pieces.select(F.col("piece").alias("cluster")).where(F.col("cluster").rlike(f"^(?:{CLUSTER})$")).distinct()
    forms = cut(cluster_forms(spark, odd))
    built = pieces.join(forms, F.col("piece") == F.col("cluster"), "left").groupBy("_id", "_jd").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("form", "piece").alias("p")))), lambda x: x["p"]), "").alias("_built"))
    clean = lambda c: F.regexp_replace(c, r"[ ]+(?=\n|\z)", "")
    # stable texts pass without a shuffle; only rebuilt ones are joined
    odd_rows = texts.where(needs_form(text)).withColumn("_id", F.xxhash64(text)).withColumn("_jd", F.hash(text)).join(built, ["_id", "_jd"], "left")
    odd_rows = odd_rows.withColumn("form", clean(F.coalesce("_built", F.col(text)))).drop("_id", "_jd", "_built")
    return texts.where(~needs_form(text)).withColumn("form", clean(F.col(text))).unionByName(odd_rows)


def look_alikes(texts: DataFrame, kind: str, key: str, text: str) -> DataFrame:
    """(kind, key_a, key_b): pairs of keys of one kind whose texts have one form but aren't stored alike.

    Each pair once, the smaller key first. Null keys and null or blank texts are left out; rows that
    repeat count once; copies stored alike aren't pairs of each other.
    """
    slim = texts.select(F.col(kind).cast("string").alias("kind"), F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).where("key is not null and text is not null")
    stored = visual_forms(slim, "text").where(F.col("form").rlike(r"\S")).select("kind", "key", F.unhex(F.md5("text")).alias("stored"), F.unhex(F.md5("form")).alias("form")).distinct()
    stored = cut(stored)
    stored = stored.withColumn("kind", F.coalesce("kind", F.lit(_NONE)))
    several = stored.groupBy("kind", "form").agg(F.min("stored").alias("x"), F.max("stored").alias("y")).where("x <> y").select("kind", "form")
    own = stored.join(several, ["kind", "form"], "left_semi")
    # ways of storing one form meet first, keys after that: copies stored alike never meet each other
    ways = own.select("kind", "form", "stored").distinct()
    a, b = ways.select("kind", "form", F.col("stored").alias("sa")), ways.select("kind", "form", F.col("stored").alias("sb"))
    pair = a.join(b, ["kind", "form"]).where("sa < sb")
    left, right = own.select("kind", "form", F.col("stored").alias("sa"), F.col("key").alias("x")), own.select("kind", "form", F.col("stored").alias("sb"), F.col("key").alias("y"))
    out = pair.join(left, ["kind", "form", "sa"]).join(right, ["kind", "form", "sb"]).where("x <> y")
    return out.select(F.nullif("kind", F.lit(_NONE)).alias("kind"), F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()
