"""Quality profile of a text as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import let, strip, words

#: Fixed thresholds: reject below, flag above.
MIN_CHARS, MIN_WORDS, MAX_SYMBOLS, MAX_REPEATED, MAX_SHORT = 50, 10, 0.4, 0.3, 0.6


def quality_profile(text: Column, language: Column) -> Column:
    """A struct of score, counts, ratios, rejection reasons and review flags.

    Rejections: blank, a replacement character, too few characters or words. Flags: symbols, repeated
    lines, a character ten times in a row, and, but for Vietnamese, many tokens of one or two letters.
    """
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"), strip), lambda x: x != "")
    base = F.struct(F.length(text).alias("n"), words(text).alias("w"), lines.alias("lines"), F.regexp_count(text, F.lit(r"[^\pL\pN\s\x{b}\x{1c}-\x{1f}\x{85}\pZ]")).alias("signs"), language.alias("language"), F.contains(text, F.lit("\ufffd")).alias("lost"), text.rlike(r"(?s)(.)\1{9,}").alias("run"))
    return let(base, lambda b: let(_measures(b), lambda m: _judged(b, m)))


def _measures(b: Column) -> Column:
    # sorted lines bring equal ones together: the longest run is the most frequent line
    def count(acc: Column, x: Column) -> Column:
        now = F.when(acc["last"] == x, acc["now"] + 1).otherwise(1)
        return F.struct(x.alias("last"), now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("now"), F.lit(0).alias("most"))
    most = F.aggregate(F.array_sort(b["lines"]), start, count, lambda acc: acc["most"])
    alpha = F.filter(b["w"], lambda x: x.rlike(r"^[\pL\pM]+$"))
    short = let(alpha, lambda a: F.struct(F.size(a).alias("n"), F.size(F.filter(a, lambda x: F.length(x) <= 2)).alias("short")))
    repeated = F.when(F.size(b["lines"]) > 1, most / F.size(b["lines"])).otherwise(0.0)
    return F.struct((b["signs"] / F.greatest(b["n"], F.lit(1))).alias("symbols"), repeated.alias("repeated"), short.alias("short"))


def _judged(b: Column, m: Column) -> Column:
    n, w, symbols, repeated = b["n"], b["w"], m["symbols"], m["repeated"]
    short = F.when(m["short"]["n"] > 0, m["short"]["short"] / m["short"]["n"]).otherwise(0.0)
    named = lambda *rules: F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in rules]), lambda x: x.isNotNull())
    score = (F.least(n / 200, F.lit(1.0)) + F.least(F.size(w) / 30, F.lit(1.0)) + F.greatest(F.lit(0.0), 1 - symbols / MAX_SYMBOLS) + F.greatest(F.lit(0.0), 1 - repeated)) / 4
    return F.struct(
        score.alias("score"), n.alias("char_count"), F.size(w).alias("word_count"), symbols.alias("symbol_ratio"), repeated.alias("repeated_line_ratio"),
        F.when(b["language"] != "vi", short).alias("short_token_ratio"),
        named(("empty_content", F.size(w) == 0), ("invalid_unicode_replacement", b["lost"]), ("too_short_characters", n < MIN_CHARS), ("too_short_words", F.size(w) < MIN_WORDS)).alias("rejection_reasons"),
        named(("excessive_symbols", symbols > MAX_SYMBOLS), ("repeated_lines", (F.size(b["lines"]) > 1) & (repeated > MAX_REPEATED)), ("repeated_characters", b["run"]), ("short_token_gibberish", (b["language"] != "vi") & (m["short"]["n"] > 20) & (short > MAX_SHORT))).alias("review_flags"),
    )
