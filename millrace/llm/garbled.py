"""Text read with the wrong character encoding: noisy-channel decoding.

A damaged token is written back to bytes by each encoding it may have been read with; a replacement
character is a lost byte, a wildcard. The bytes are read again as UTF-8 (or by the old table of a
Vietnamese font encoding), wildcards are filled from the words of the corpus whose bytes fit. What
every token can stand for is weighed by corpus word frequencies, and a Viterbi search over the tokens
of a page decides which stretch was damaged by which encoding, or by none.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

# Encodings that UTF-8 text is commonly misread with.
SINGLE = ("cp1252", "latin_1", "cp1258", "cp1250", "cp1251", "cp1253", "cp1254", "cp1255", "cp1256", "cp1257", "cp437", "cp850", "cp852", "cp866", "mac_roman", "iso8859_2", "iso8859_5", "iso8859_9", "iso8859_15", "koi8_r", "koi8_u")
MULTI = ("gb18030", "big5", "cp932", "euc_kr", "euc_jp")
# The letters of the TCVN3 font encoding, read as Latin-1, and what they stand for.
TCVN3 = dict(zip(
    "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉË®ÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞßãáâä«åèæçé¬êíëìîïóñòô­õøö÷ùúýûüþ¡¢§£¤¥¦",
    "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵĂÂĐÊÔƠƯ",
))
#: Encodings whose undefined bytes are at times dropped.
SHORT = ("cp1252", "latin_1", "cp1258")
#: Vietnamese letters beyond ASCII, as a character class for both Java and Python.
LETTERS = "\\u00c0-\\u00c3\\u00c8-\\u00ca\\u00cc\\u00cd\\u00d2-\\u00d5\\u00d9\\u00da\\u00dd\\u00e0-\\u00e3\\u00e8-\\u00ea\\u00ec\\u00ed\\u00f2-\\u00f5\\u00f9\\u00fa\\u00fd\\u0102\\u0103\\u0110\\u0111\\u0128\\u0129\\u0168\\u0169\\u01a0\\u01a1\\u01af\\u01b0\\u1ea0-\\u1ef9"
SIGNS = "\\u2010-\\u2014\\u2018-\\u201e\\u2026\\u2002-\\u200a\\u200b\\u202f\\u2060\\ufeff\\uff01-\\uff5e"
#: A page worth a look: a character that isn't plain text, or a letter right before a typographic sign.
LOOK = f"[^\\u0000-\\u007f\\u0300-\\u036f{LETTERS}{SIGNS}]|[\\u00c0-\\u00ff\\u0102\\u0103\\u0110\\u0111][\\u2013\\u2014\\u2018-\\u201e\\u2026]"
_LOOK = re.compile(LOOK)
_SPLIT = re.compile("([ \t\r\n\f\v]+)")
_WORD = re.compile(r"[^\W\d_]+")
_LOST = "\ufffd"
_FINE = re.compile("^[\x20-\x7e\u00a0-\u017f\u01a0\u01a1\u01af\u01b0\u02c6-\u02dc\u0300-\u036f\u1ea0-\u1ef9\u2002-\u200d\u2010-\u2026\u2030\u2039\u203a\u20ac\u2122\u2190-\u22ff\ufeff]*$")
#: Bytes of readings that a worker remembers, about; rows of a batch it hands on; pages it rebuilds at once.
_CACHE, _ROWS, _PAGES = 64 << 20, 20_000, 256
#: Log-probability of changing from one encoding to another between tokens.
SWITCH, MISSING = -3.0, -30.0


def _table(codec: str) -> dict[str, int]:
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


class Channels:
    """What a token may have been, by encoding."""

    def __init__(self) -> None:
        self.tables = {c: _table(c) for c in SINGLE}
        self.known: dict[str, list[tuple[str, str, bool]]] = {}
        self.held = 0

    def to_bytes(self, codec: str, token: str) -> list[int | None] | None:
        """The bytes of a token, None for a lost one; None if the encoding can't have made it."""
        if codec in self.tables:
            t = self.tables[codec]
            out = [None if c == _LOST else t.get(c, -1) for c in token]
            return None if -1 in out else out
        out = []
        for part in re.split(f"({_LOST})", token):
            if part == _LOST:
                out.append(None)
            else:
                try:
                    out += part.encode(codec)
                except UnicodeEncodeError:
                    return None
        return out

    @staticmethod
    def gaps(raw: list[int]) -> str | None:
        """A byte pattern with wildcards where UTF-8 sequences stop short: bytes that were dropped silently."""
        out, i, short = [], 0, False
        while i < len(raw):
            b = raw[i]
            need = 0 if b < 0x80 else 1 if 0xC2 <= b <= 0xDF else 2 if 0xE0 <= b <= 0xEF else -1
            if need < 0:
                return None
            out.append(f"{b:02x}")
            i += 1
            for _ in range(need):
                if i < len(raw) and 0x80 <= raw[i] <= 0xBF:
                    out.append(f"{raw[i]:02x}")
                    i += 1
                else:
                    out.append(".")
                    short = True
        return "".join(out) if short else None

    def read(self, token: str) -> list[tuple[str, str, bool]]:
        """(channel, text or byte pattern, whether the bytes alone prove damage) for a token."""
        hit = self.known.get(token)
        if hit is not None:
            return hit
        out: list[tuple[str, str, bool]] = []
        lost = _LOST in token
        plain = token.isascii()
        for codec in () if plain else (*SINGLE, *MULTI):
            raw = self.to_bytes(codec, token)
            if raw is None:
                continue
            if None in raw:
                known = [b for b in raw if b is not None and b > 127]
                if all(b > 127 for b in known) and (not known or codec == "cp1252" or codec in MULTI or any(b >= 0xC2 for b in known)):
                    out.append((codec, "".join("." if b is None else f"{b:02x}" for b in raw), True))
                continue
            try:
                text = bytes(raw).decode("utf-8")
            except UnicodeDecodeError:
                if codec in SHORT and (gaps := self.gaps(raw)):
                    out.append((codec, gaps, False))
                continue
            if text == token or (codec in self.tables and len(text) == len(token)):
                continue
            twice = None
            if not text.isascii():
                again = self.to_bytes(codec, text) or self.to_bytes("cp1252", text)
                if again and None not in again:
                    try:
                        twice = bytes(again).decode("utf-8")
                    except UnicodeDecodeError:
                        pass
            if twice is not None and twice != text and _FINE.match(twice):
                out.append((f"{codec}+", twice, True))
            elif _FINE.match(text):
                out.append((codec, text, True))
        if lost:
            out.append(("lost", "".join("." if c == _LOST else "".join(f"{b:02x}" for b in c.encode()) for c in token), True))
        elif not plain and any(c in TCVN3 for c in token):
            text = "".join(TCVN3.get(c, c) for c in token)
            if all(c.isascii() or c in TCVN3 for c in token) and (any(c.isascii() and c.isalpha() for c in token) or sum(c in TCVN3 for c in token) > 1):
                out.append(("tcvn3", text, False))
        if self.held > _CACHE:
            self.known.clear()
            self.held = 0
        self.known[token] = out
        self.held += 250 + len(token) + sum(150 + len(text) for _, text, _ in out)
        return out


def skeleton(word: str) -> str:
    """A word with every stretch beyond ASCII replaced by a star."""
    return re.sub("[^\x00-\x7f]+", "*", word)


def fits(pattern: str, word: str) -> bool:
    """Whether the UTF-8 bytes of a word, or its characters where each lost sign was one, fit a byte pattern."""
    wild = re.compile(b"".join(b"[\x80-\xff]{1,2}" if x == "." else re.escape(bytes.fromhex(x)) for x in re.findall(r"\.|[0-9a-f]{2}", pattern)), re.DOTALL)
    if wild.fullmatch(word.encode()):
        return True
    return bool(re.fullmatch("".join("[^\x00-\x7f]" if x == "." else re.escape(chr(int(x, 16))) for x in re.findall(r"\.|[0-9a-f]{2}", pattern)), word))


_EDGE = re.compile("^([^\\w\ufffd\u0080-\uffff]*)(.*?)([^\\w\ufffd\u0080-\uffff]*)$", re.DOTALL)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    channels = Channels()
    look = re.compile(LOOK)
    names = ["page", "i", "token", "channel", "text", "sure", "lost", "skeleton", "words", "own", "n"]
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64())
    packed = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=names)
    for batch in batches:
        rows, usual = [], Counter()
        for page, text in ((p.as_py(), t.as_py()) for p, t in zip(batch.column(0), batch.column(1))):
            if text.isascii():
                continue
            usual.update(_WORD.findall(text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)))
            if not look.search(text):
                continue
            mine, worth = [], False
            for i, token in enumerate(_SPLIT.split(text)):
                if token.isascii():
                    continue
                own = _WORD.findall(unicodedata.normalize("NFC", token).lower())
                for channel, read, sure in channels.read(token):
                    lost = _LOST in token or (not sure and channel in SHORT)
                    worth = worth or sure or (channel == "tcvn3" and bool(_LOOK.search(token)))
                    if lost:
                        core = _EDGE.match(token).group(2)
                        rest = [(c, p) for c, p, _ in channels.read(core)] if core != token else [(channel, read)]
                        read = next((p for c, p in rest if c == channel), read)
                        # the encoding's own view of the token gives the skeleton
                        mine.append((page, i, token, channel, read, sure, True, skeleton(core.lower().replace("\u0130", "i")), [], own, None))
                    else:
                        mine.append((page, i, token, channel, read, sure, False, None, _WORD.findall(unicodedata.normalize("NFC", read).lower()), own, None))
            if worth:
                rows += mine
            while len(rows) >= _ROWS:
                yield packed(rows[:_ROWS])
                del rows[:_ROWS]
        small: Counter = Counter()
        for w, n in usual.items():
            if not w.isascii():
                small[w.lower()] += n
        rows += [(None, None, w, None, None, None, None, None, None, None, n) for w, n in small.items()]
        yield packed(rows)


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        token, pattern, word = (batch.column(i).to_pylist() for i in range(3))
        keep = [fits(p, w) for p, w in zip(pattern, word)]
        out = []
        for t, w, k in zip(token, word, keep):
            if k:
                lead, core, tail = _EDGE.match(t).groups()
                out.append(lead + (w.capitalize() if core[:1].isascii() and core[:1].isupper() else w) + tail)
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(out, pa.string()), batch.column(3).filter(keep), batch.column(4).filter(keep)], names=["token", "pattern", "w", "channel", "n"])


def viterbi(tokens: list[dict], total: float) -> list[tuple[int, str, str | None]]:
    """(place, channel, text or None where nothing fits) of the damaged tokens.

    tokens: place i, sure, raw (the token's own log-frequency), options {channel: (text, score)}.
    """
    states = ["", *sorted({c for t in tokens for c in t["options"]})]
    best, back = {s: 0.0 if s == "" else SWITCH for s in states}, []  # back: by token, the best state before and, as bits, the states that stay
    for t in tokens:
        emit = {s: t["options"][s][1] if s in t["options"] else MISSING for s in states}
        emit[""] = 2 * MISSING if t["sure"] else t["raw"]
        top = max(best, key=lambda s: best[s])
        new, stays = {}, 0
        for k, s in enumerate(states):
            stay = best[s] >= best[top] + SWITCH
            stays |= stay << k
            new[s] = (best[s] if stay else best[top] + SWITCH) + emit[s]
        back.append((top, stays))
        best = new
    s = max(best, key=lambda k: best[k])
    path, bit = [], {s: 1 << k for k, s in enumerate(states)}
    for t, (top, stays) in zip(reversed(tokens), reversed(back)):
        path.append((t, s))
        s = s if stays & bit[s] else top
    out = []
    for t, s in reversed(path):
        if not t["sure"] and (s == "" or s not in t["options"]):
            continue
        text = t["options"][s][0] if s in t["options"] else max(t["options"].values(), key=lambda x: x[1])[0] if t["options"] else None
        out.append((t["i"], s, text))
    return out


def _decode(total: float):
    """Rows in order of page and place; only the tokens of one page are held at once, equal options once."""
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
    packed = lambda out: pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=["page", "i", "channel", "text"])

    def token(i: int, rows: list[tuple], alike: dict) -> dict:
        options: dict[str, tuple[str, float]] = {}
        for channel, _, _, text, score in sorted(rows, key=lambda r: (r[0], -(r[4] or 0), r[3] or "")):
            if text is not None and (channel not in options or options[channel][1] < score):
                options[channel] = (text, score)
        return {"i": i, "sure": any(r[1] for r in rows), "raw": rows[0][2], "options": alike.setdefault(tuple(options.items()), options)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        flat = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for page, rows in groupby(flat, key=lambda r: r[0]):
            alike: dict = {}
            tokens = [token(i, [r[2:] for r in same], alike) for i, same in groupby(rows, key=lambda r: r[1])]
            out += [(page, *x) for x in viterbi(tokens, total)]
            if len(out) >= _ROWS:
                yield packed(out)
                out = []
        yield packed(out)

    return run


def damaged_tokens(pages: DataFrame, page: str, text: str) -> DataFrame:
    """(page, i, channel, text): damaged tokens, with the encoding found and the restored token.

    i counts the pieces of the text cut at ASCII blanks, blanks included. text is null where lost bytes
    fit no word of the corpus. page must be a unique BIGINT; null pages and null or blank texts are
    left out; texts are read whole; extra columns are ignored; an empty table gives none.
    Frequencies are of words with letters beyond ASCII, over all pages (others hold none); lost bytes are
    filled with any such word of Latin letters that fits, the most frequent first.
    """
    slim = pages.select(F.col(page).cast("long").alias("page"), F.col(text).cast("string").alias("text")).where("page is not null and text is not null")
    # one pass over the pages: what tokens may have been, and how often each word occurs, counted per batch
    both = cut(slim.mapInArrow(_candidates, "page long, i int, token string, channel string, text string, sure boolean, lost boolean, skeleton string, words array<string>, own array<string>, n long"))
    found = both.where("n is null").drop("n")
    words = cut(both.where("n is not null").groupBy(F.col("token").alias("w")).agg(F.sum("n").alias("n")))
    total = float(words.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0])
    log = lambda n, more: F.log((F.coalesce(n, F.lit(0)) + F.lit(more)) / F.lit(total + 1))
    # how usual the token is as it stands
    tokens = found.select("token", "own").distinct()
    raw = tokens.select("token", F.explode_outer("own").alias("w")).join(words, "w", "left").groupBy("token").agg(F.min(F.when(F.col("w").rlike("[^\\x00-\\x7f]"), log(F.col("n"), 0.1))).alias("raw"))
    raw = raw.select("token", F.coalesce("raw", F.lit(math.log(0.1 / (total + 1)))).alias("raw"))
    # how usual the restored token is
    whole = found.where("not lost").select("token", "channel", "text", "words").distinct()
    scored = whole.select("token", "channel", "text", F.explode_outer("words").alias("w")).join(words, "w", "left").groupBy("token", "channel", "text").agg(F.min(F.when(F.col("w").rlike("[^\\x00-\\x7f]"), log(F.col("n"), 0.5))).alias("score"))
    # lost bytes: corpus words with the same skeleton and a length that the pattern allows, whose bytes fit
    holes = found.where("lost").select("token", "channel", F.col("text").alias("pattern"), "skeleton").distinct()
    gone = F.expr("length(pattern) - length(replace(pattern, '.', ''))")
    holes = holes.withColumn("gone", gone).withColumn("kept", F.expr("(length(pattern) - gone) div 2"))
    holes = holes.withColumn("bytes", F.explode(F.expr("sequence(kept + gone, 2 * kept + 3 * gone)"))).drop("gone", "kept")
    mold = words.where(F.col("w").rlike("^[a-z\\u00df-\\u00f6\\u00f8-\\u024f\\u1e00-\\u1eff]+$")).select("w", "n", F.regexp_replace("w", "[^\\x00-\\x7f]+", "*").alias("skeleton"), F.octet_length("w").alias("bytes"))
    filled = holes.join(mold, ["skeleton", "bytes"]).select("token", "pattern", "w", "channel", "n").mapInArrow(_fill, "token string, pattern string, w string, channel string, n long")
    filled = filled.groupBy("token", "channel").agg(F.max_by("w", F.struct("n", "w")).alias("text"), F.max("n").alias("n")).select("token", "channel", "text", log(F.col("n"), 0.5).alias("score"))
    options = scored.union(filled)
    rows = found.select("page", "i", "token", "channel", "sure").distinct().join(raw, "token").join(options, ["token", "channel"], "left")
    rows = rows.select("page", "i", "channel", "sure", "raw", "text", F.coalesce("score", F.lit(math.log(0.5 / (total + 1)))).alias("score")).repartition("page").sortWithinPartitions("page", "i")
    return rows.mapInArrow(_decode(total), "page long, i int, channel string, text string")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(k, _PAGES) for b in batches for k in range(0, b.num_rows, _PAGES)):
        out, open_ = [], []
        for text, fixes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            parts = _SPLIT.split(text)
            for f in fixes:
                if f["text"] is not None:
                    parts[f["i"]] = f["text"]
            out.append("".join(parts))
            open_.append(sum(f["text"] is None for f in fixes))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(open_, pa.int32())], names=["page", "restored", "unrestored"])


def restored_pages(pages: DataFrame, page: str, text: str) -> DataFrame:
    """(page, restored, unrestored): every damaged page with its text as far as it can be restored, and the number of damaged tokens that can't."""
    fixes = damaged_tokens(pages, page, text).groupBy("page").agg(F.sort_array(F.collect_list(F.struct("i", "text"))).alias("fixes"))
    slim = pages.select(F.col(page).cast("long").alias("page"), F.col(text).cast("string").alias("text"))
    return slim.join(fixes, "page").select("page", "text", "fixes").mapInArrow(_rebuild, "page long, restored string, unrestored int")
