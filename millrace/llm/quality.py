"""Per-document text quality statistics and fixed-threshold rules.

Statistics are computed for whole batches with Arrow's vectorised string kernels: the texts of a batch
are cut into lines, every measure of a line is one kernel call over all lines, and sums per document
come from numpy. A line is prose by published kinds of rules (enough words, enough common words, few
symbols and digits, no bullet); a document is not natural prose when most of its characters stand in
lines that aren't, and every rule that fails is named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.fold import fold

# Common words, English then Vietnamese.
COMMON = (
    "the of and to in was were is that by for with had from its it as at on but not which this an are be been after before until "
    "since than so during their they he she his her or who when where while because about into over under between every some all most "
    "có và của các là được ở những trong cho từ một này không đã với vào khi thì mà bị do rằng như sau trước trên tới đến nhưng nên vì về còn "
    "vẫn mọi vài chỉ cùng khác gần hơn ấy đó nào cũng rồi lại phải qua để tại theo giữa lúc ra làm người nơi bằng dù rất ít ai mỗi cứ chưa"
).split()
#: Fixed thresholds. A line: least words (more where no sentence ends), least share of common words, most symbols and most digits a character.
LINE_WORDS, LINE_WRAPPED, LINE_COMMON, LINE_SYMBOLS, LINE_DIGITS = 4, 6, 0.09, 0.12, 0.25
#: A document: least share of characters in prose lines, most symbols a character, longest and shortest mean word, most characters in repeated lines.
PROSE, SYMBOLS, LONG, SHORT, REPEATED, BULLETS, COMMON_SHARE = 0.5, 0.3, 14.0, 2.2, 0.5, 0.6, 0.06
_BULLET = r"^(?:[*•◦▪‣·»>–—-]|\(?[0-9a-z]{1,3}[.)]|\|)\s*\S|\|.*\||^\{\||^\|"
_COMMON = r"(?:^|[^\pL\pM\pN])(?:" + "|".join(COMMON) + r")(?:$|[^\pL\pM\pN])"
FIELDS = (
    ("char_count", "long"), ("word_count", "long"), ("mean_word_length", "double"), ("symbol_ratio", "double"), ("repeated_line_ratio", "double"),
    ("line_count", "long"), ("ending_line_ratio", "double"), ("bullet_line_ratio", "double"), ("common_word_ratio", "double"), ("prose_share", "double"),
    ("is_prose", "boolean"), ("reasons", "array<string>"),
)


def statistics(texts: pa.Array) -> dict[str, np.ndarray | list]:
    """The measures of FIELDS for non-null texts."""
    n = len(texts)
    number = lambda a: pc.fill_null(a, 0).to_numpy(zero_copy_only=False).astype(float)
    chars = number(pc.utf8_length(texts))
    words = number(pc.count_substring_regex(texts, r"[^\s\x{1c}-\x{1f}\x{85}\pZ]+"))
    symbols = number(pc.count_substring_regex(texts, r"[^\pL\pN\s\x{1c}-\x{1f}\x{85}\pZ]"))
    blanks = number(pc.count_substring_regex(texts, r"[\s\x{1c}-\x{1f}\x{85}\pZ]"))
    folded = pa.array([fold(t) for t in texts.to_pylist()], pa.string())
    raw = pc.split_pattern_regex(pc.replace_substring_regex(texts, r"\r\n?|[\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]", "\n"), "\n")
    cut = pc.split_pattern_regex(pc.replace_substring_regex(folded, r"\r\n?|[\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]", "\n"), "\n")
    line, owner = pc.utf8_trim_whitespace(pc.list_flatten(cut)), pc.list_parent_indices(cut).to_numpy()
    own, own_at = pc.utf8_trim_whitespace(pc.list_flatten(raw)), pc.list_parent_indices(raw).to_numpy()
    size = number(pc.utf8_length(line))
    w = number(pc.count_substring_regex(line, r"[\pL\pM\pN]+"))
    spaced = pc.replace_substring_regex(line, r"([^\pL\pM\pN]+)", r"\1\1")
    common = number(pc.count_substring_regex(spaced, _COMMON))
    signs = number(pc.count_substring_regex(line, r"[^\pL\pM\pN\s\pZ]"))
    digits = number(pc.count_substring_regex(line, r"\pN"))
    ends = number(pc.cast(pc.match_substring_regex(line, r"[.!?…:;。！？][\"'”’»)\]]*$"), pa.int8()))
    bullet = number(pc.cast(pc.match_substring_regex(line, _BULLET), pa.int8()))
    safe = np.maximum(size, 1)
    prose = (w >= np.where(ends > 0, LINE_WORDS, LINE_WRAPPED)) & (common >= LINE_COMMON * w) & (signs <= LINE_SYMBOLS * safe) & (digits <= LINE_DIGITS * safe) & ((bullet == 0) | ((ends > 0) & (w >= 8)))
    total = lambda x: np.bincount(owner, x, n)
    # repeated lines, as stored: the most frequent non-blank line, and what repeats as read
    codes = pc.dictionary_encode(own).indices.to_numpy().astype(np.int64)
    full = number(pc.utf8_length(own)) > 0
    pair, times = np.unique(own_at[full].astype(np.int64) * (codes.max(initial=0) + 1) + codes[full], return_counts=True)
    most, lines_raw = np.zeros(n), np.bincount(own_at[full], minlength=n).astype(float)
    np.maximum.at(most, pair // (codes.max(initial=0) + 1), times)
    line_code = pc.dictionary_encode(line).indices.to_numpy().astype(np.int64)
    _, first = np.unique(owner.astype(np.int64) * (line_code.max(initial=0) + 1) + line_code, return_index=True)
    fresh = np.zeros(len(line), bool)
    fresh[first] = True
    repeated = total(np.where(fresh, 0, size))
    body = total(size)
    some, safe_body, wsum = body > 0, np.maximum(body, 1), np.maximum(total(w), 1)
    lines = total((size > 0).astype(float))
    share = total(np.where(prose & fresh, size, 0)) / safe_body
    mean = (chars - blanks) / np.maximum(words, 1)
    out = {
        "char_count": chars.astype(np.int64), "word_count": words.astype(np.int64), "mean_word_length": np.where(words > 0, mean, 0.0),
        "symbol_ratio": symbols / np.maximum(chars, 1), "repeated_line_ratio": np.where(lines_raw > 1, most / np.maximum(lines_raw, 1), 0.0),
        "line_count": lines.astype(np.int64), "ending_line_ratio": total(ends) / np.maximum(lines, 1), "bullet_line_ratio": total(bullet) / np.maximum(lines, 1),
        "common_word_ratio": total(common) / wsum, "prose_share": np.where(some, share, 0.0),
    }
    rules = (
        ("few_prose_characters", out["prose_share"] < PROSE), ("many_symbols", out["symbol_ratio"] > SYMBOLS), ("long_words", mean > LONG),
        ("short_words", mean < SHORT), ("repeated_lines", repeated > REPEATED * safe_body), ("bullets", out["bullet_line_ratio"] > BULLETS),
        ("few_common_words", out["common_word_ratio"] < COMMON_SHARE),
    )
    failed = [[name for name, bad in rules if bad[i]] if some[i] else ["blank"] for i in range(n)]
    out["reasons"] = failed
    # the share of prose decides; other rules only speak up where that share is slim
    out["is_prose"] = some & (out["prose_share"] >= PROSE) & (repeated <= REPEATED * safe_body)
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    for batch in batches:
        if not batch.num_rows:
            continue
        s = statistics(batch.column(1).cast(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s[f], kinds[t]) for f, t in FIELDS]], names=["key", *[f for f, _ in FIELDS]])


def quality_profiles(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, statistics..., is_prose, reasons): one row for each row of docs with a text.

    A word is a run of non-blanks; symbols are characters that are neither letters, digits nor
    blanks, per character; repeated_line_ratio is the share of the most frequent non-blank line among
    non-blank lines, 0 with fewer than two. Null texts have no row, blank ones the reason "blank" and
    is_prose false. Repeated rows are profiled repeatedly, null keys kept; texts are read whole; extra
    columns are ignored; an empty table gives an empty one.
    """
    slim = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")
    return slim.mapInArrow(_profile, "key string, " + ", ".join(f"{f} {t}" for f, t in FIELDS))
