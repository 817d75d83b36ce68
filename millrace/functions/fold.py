"""Text "as read": case, punctuation, spacing, invisible characters, accent encoding, width
and look-alike letters set aside.

Null reads as the empty string. Texts of any length are folded whole.
"""

from __future__ import annotations

import re
import unicodedata

# Letters of other alphabets that look like a Latin letter, by code point.
LOOKALIKES = {
    # Cyrillic, small
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "ү": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ӓ": "ä",
    # Cyrillic, capital
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ӏ": "I", "Ԛ": "Q",
    "Ԝ": "W", "Ѵ": "V",
    # Greek, small
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "γ": "y",
    "ϲ": "c", "ϳ": "j",
    # Greek, capital
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
    # Armenian, and Latin letters that stand in for others
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i",
    "ð": "đ", "Ð": "Đ", "Ɖ": "Đ", "ɖ": "đ",
}
_LOOK = str.maketrans(LOOKALIKES)
_LOOK_RE = re.compile("[" + "".join(LOOKALIKES) + "]")
#: Characters without a glyph of their own.
_HIDDEN = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb]")
#: Anything beyond ASCII, Latin letters already composed and plain typographic signs.
_ODD = re.compile("[^\x00-\x7f\u00c0-\u00cf\u00d1-\u00ef\u00f1-\u0130\u0134-\u017e\u0180-\u0188\u018a-\u01c3\u01cd-\u01f0\u1e00-\u1eff\u2010-\u2014\u2018-\u201f\u2022]")
_MARKS = re.compile("[\u0300-\u036f]{2,}")
_MARK = re.compile("[\u0300-\u036f]")
_WORDS = re.compile(r"[^\W_]+")
#: Vowel signs come before tone signs, as in composed letters.
_FIRST = {"\u031b": 0, "\u0306": 1, "\u0302": 1}


def _order(m: re.Match) -> str:
    kept = dict.fromkeys(m.group())
    return "".join(sorted(kept, key=lambda c: _FIRST.get(c, 2)))


def compose(text: str) -> str:
    """NFC, with repeated accents dropped and vowel signs put before tone signs."""
    out = unicodedata.normalize("NFC", text)
    if _MARK.search(out):
        out = unicodedata.normalize("NFC", _MARKS.sub(_order, unicodedata.normalize("NFD", out)))
    return out


def fold(text: str | None) -> str:
    """The text as read, punctuation and spacing still in place."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    if _ODD.search(text):
        text = compose(_HIDDEN.sub("", unicodedata.normalize("NFKC", text)))
        if _LOOK_RE.search(text):
            text = compose(text.translate(_LOOK))
    return text.casefold()


def words(text: str | None) -> list[str]:
    """Runs of letters and digits of the text as read."""
    return _WORDS.findall(fold(text))


def as_read(text: str | None) -> str:
    """The text as read, words joined by one blank."""
    return " ".join(words(text))
