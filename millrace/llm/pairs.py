"""Defective question-answer and instruction-response pairs.

Copies are found by compression: an answer compressed with its question as a zstandard dictionary
shrinks to almost nothing if it only gives the question back. Languages are told by dictionaries of
function words and by script, refusals by a dictionary of phrases. Answers that break off are found by
a terminal-context model: how often the last two words of an answer end one, over all answers, against
how often they stand inside one.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.fold import fold, words
from millrace.session import cut

# Answers that only hold the place of one, as read.
PLACEHOLDERS = frozenset((
    "n a", "na", "none", "null", "nil", "nan", "no answer", "todo", "to do", "tbd", "tba", "tbc", "empty", "blank", "placeholder", "answer", "answer here", "your answer here", "insert answer here", "undefined", "unknown", "xxx", "lorem ipsum", "pending", "not available", "not applicable", "no response", "response",
    "chưa có câu trả lời", "không có câu trả lời", "chưa có", "trống", "bỏ trống", "để trống", "chưa trả lời", "không có", "câu trả lời", "điền câu trả lời", "đang cập nhật", "cập nhật sau", "chưa cập nhật",
))
# Phrases that decline to answer, as read.
REFUSALS = (
    r"(?:i|we) (?:can ?not|can t|could not|couldn t|won t|will not|am not able|m not able|am unable|m unable|are unable|must decline|have to decline|decline|regret that)\b",
    r"(?:unable|not able) to (?:answer|help|assist|respond|provide|discuss|comply|comment|reply)",
    r"(?:cannot|can t|can not) (?:answer|help|assist|respond|provide|discuss|comply|comment|reply|share)",
    r"(?:i d|i would) rather not (?:answer|say|respond|reply)", r"(?:won t|will not) be able to (?:answer|help|assist|respond|provide)",
    r"do(?: not|n t) have enough information", r"(?:no|any) way of answering", r"not (?:something|a question) i (?:am|can|may)", r"not (?:permitted|allowed) to (?:discuss|answer|talk|say|share|do|provide)",
    r"outside (?:what|of what) i (?:may|can)", r"(?:against|violate) my (?:guidelines|policy|policies|rules)", r"(?:not be|isn t|is not|wouldn t be) appropriate for me", r"something i must decline", r"must decline",
    r"as an? (?:language|ai|virtual|helpful)? ?(?:assistant|model|ai)\b", r"answering (?:would|is not|isn t)", r"beyond (?:my|the scope)", r"not comfortable (?:answering|discussing)", r"i m sorry but", r"i am sorry but",
    r"tôi (?:không|chưa|chẳng) (?:thể|có đủ|được phép|tiện|hỗ trợ|có quyền|biết câu trả lời|muốn trả lời)", r"(?:từ chối|miễn) trả lời", r"xin phép (?:từ chối|không|được từ chối)", r"ngoài (?:khả năng|phạm vi)", r"vượt quá (?:phạm vi|khả năng)",
    r"không hỗ trợ (?:nội dung|loại|câu hỏi|yêu cầu|chủ đề)", r"(?:là|với tư cách) một (?:trợ lý|mô hình)", r"không có đủ (?:thông tin|dữ liệu) để", r"không tiện trả lời", r"không được phép (?:cung cấp|bàn|trả lời|nói|tiết lộ|chia sẻ)", r"mong bạn thông cảm", r"rất tiếc (?:tôi|yêu cầu|câu hỏi|hệ thống|nội dung)", r"không thể (?:trả lời|giúp bạn|cung cấp|hỗ trợ)",
)
# Function words by language; words of two languages are left out.
FUNCTION = {
    "vi": "và của các là được ở những trong cho từ một này không có đã với vào khi thì mà bị do rằng như sau trước trên tới đến nhưng nên vì về còn vẫn mọi vài cùng khác gần ấy đó nào cũng rồi lại phải qua để theo người năm lần đầu nhất gì ai đâu bao nhiêu hãy mô tả câu viết đoạn giới thiệu giải thích nguồn nói tóm tắt lịch sử xin hỏi biết bạn",
    "en": "the of and to was were is that by for with had from its it as at on but not which this are be been after before until since than they their his her what who how about where most into in a few describe explain say says write short account reader summarise summarize history please tell me did does do you asked",
    "fr": "le la les des du et est dans pour avec par sur une aux cette qui au été sont pas plus leur selon",
    "es": "el los las del y en para con por una según que fue está como más su sus al lo año registro",
    "de": "der die das und ist mit von den dem ein eine wurde nach auf im zu nicht auch als sich bei laut jahr",
    "pt": "os as da do dos das em foi com uma segundo não mais ao à ou pelo pela são está ano",
    "id": "dan yang di dengan untuk adalah pada oleh ini itu dari ke dalam menurut tahun tersebut disebut",
    "it": "il gli della dei delle nel con per che è stato secondo una sono alla anno",
}
_OF: dict[str, set[str]] = {}
for _lang, _list in FUNCTION.items():
    for _w in _list.split():
        _OF.setdefault(_w, set()).add(_lang)
_REFUSE = re.compile(r"(?:^|\b)(?:" + "|".join(REFUSALS) + ")")
_SCRIPTS = (("zh", re.compile("[㐀-鿿]")), ("ja", re.compile("[぀-ヿ]")), ("ko", re.compile("[가-힯ᄀ-ᇿ]")), ("ru", re.compile("[а-яё]")), ("th", re.compile("[฀-๿]")), ("ar", re.compile("[؀-ۿ]")), ("el", re.compile("[α-ω]")), ("hi", re.compile("[ऀ-ॿ]")))
_VI = re.compile("[ăâđêôơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ]")
_END = re.compile(r"[.!?。？！]['\"”’»)\]]*$")
_BROKEN = re.compile(r"(?:…|\.\.\.|[,;:(\[{–—/&+-])$")


def language(tokens: list[str], text: str) -> tuple[str | None, int]:
    """(language, evidence) of folded words; None where nothing tells."""
    letters = max(1, sum(c.isalpha() for c in text))
    for lang, script in _SCRIPTS:
        if (n := len(script.findall(text))) > max(3, 0.1 * letters):
            return lang, n
    votes: dict[str, float] = {}
    for t in tokens:
        if (owners := _OF.get(t)):
            for lang in owners:
                votes[lang] = votes.get(lang, 0) + 1 / len(owners)
        elif _VI.search(t):
            votes["vi"] = votes.get("vi", 0) + 0.5
    if not votes:
        return None, 0
    best = max(votes, key=lambda k: (votes[k], k == "vi", k == "en"))
    return best, int(votes[best] + 0.5)


def in_order(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of words."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b):
            up = row[j + 1]
            row[j + 1] = left + 1 if x == y else max(up, row[j])
            left = up
    return row[-1]


def copied(question: str, answer: str) -> bool:
    """Whether compression with the question as dictionary leaves nothing of the answer."""
    q, a = words(question), words(answer)
    if len(a) < 2 or not q or 4 * len(a) < 3 * len(q):
        return False
    body = " ".join(a).encode()
    known = " ".join(q).encode()
    helped = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, dict_data=zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    small = len(helped.compress(body))
    if small > 0.5 * min(len(body), len(zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False).compress(body))) + 12:
        return False
    fresh = [w for w in a if w not in set(q)]
    return 10 * in_order(q, a) >= 9 * len(q) and len(fresh) <= max(2, len(a) // 8) and not any(any(c.isdigit() for c in w) for w in fresh)


def first_defect(question: str | None, answer: str | None, placeholders: Collection[str] = PLACEHOLDERS, refuse: re.Pattern = _REFUSE) -> str | None:
    """empty, refusal, copied_question or wrong_language, in this order, or None."""
    a = words(answer)
    text = " ".join(a)
    if not a or text in placeholders:
        return "empty"
    if refuse.search(text):
        return "refusal"
    if question and copied(question, answer):
        return "copied_question"
    q = words(question)
    shared = set(q) & set(a)
    own = [w for w in a if w not in shared or w in _OF]
    asked, sure = language(q, fold(question))
    # names of the question may be in any language: its function words decide, the longer half first
    said, evidence = language(own, fold(answer))
    if asked and said and said != asked and len(a) >= 5:
        votes = sum(1 for w in a if asked in _OF.get(w, ()))
        if said not in ("en", "vi", "fr", "es", "de", "pt", "id", "it") or (evidence >= 2 and evidence > 2 * votes):
            return "wrong_language"
    return None


def _context(tokens: list[str]) -> list[str]:
    return ["#" if any(c.isdigit() for c in t) else t for t in tokens]


def _read(placeholders: Collection[str], refuse: re.Pattern):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, q, a in zip(*(batch.column(i).to_pylist() for i in range(3))):
                defect = first_defect(q, a, placeholders, refuse)
                end = fold(a).strip()
                w = _context(words(a))
                ended = bool(_END.search(end)) and not end.endswith("...")
                rows.append((item, defect, ended, bool(_BROKEN.search(end)), w if defect is None else [], " ".join(words(q))))
            kinds = (pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=["item", "defect", "ended", "broken", "w", "asked"])

    return run


def defective_pairs(pairs: DataFrame, item: str, question: str, answer: str, least: float = 0.25, weight: int = 8, whole: float = 0.5, placeholders: Collection[str] = PLACEHOLDERS, refusals: Collection[str] = REFUSALS) -> DataFrame:
    """(item, defect): one row for each distinct item with a defective pair.

    A null, blank, wordless or placeholder answer is empty, whatever the question. A null or blank
    question has no language and nothing to copy. An answer without closing punctuation breaks off
    when it ends in an opening or joining sign, or when its last two words end less than `least` of
    the answers they occur in; the share is smoothed with that of the last but one word, which counts
    like `weight` occurrences. Answers of one or two words never break off in this way, nor those of up
    to five that answer several questions and are as a whole at least `whole` of all answers that begin
    with them. Null items are dropped; repeated rows count once; texts are read whole; extra columns
    are ignored. placeholders (as read) and refusals (regular expressions) may be given.
    """
    slim = pairs.select(F.col(item).cast("long").alias("item"), F.col(question).cast("string").alias("q"), F.col(answer).cast("string").alias("a")).where("item is not null").distinct()
    refuse = re.compile(r"(?:^|\b)(?:" + "|".join([*refusals, r"(?!)"]) + ")")
    read = cut(slim.mapInArrow(_read(frozenset(placeholders), refuse), "item long, defect string, ended boolean, broken boolean, w array<string>, asked string"))
    said = read.where("size(w) > 0")
    # contexts: two words in a row, and one word with whatever follows; made before they're exploded, so no row carries a text
    at = said.where("size(w) > 1").select(F.explode(F.expr("transform(sequence(1, size(w) - 1), i -> struct(concat(w[i - 1], ' ', w[i]) as two, w[i - 1] as before, ended and i = size(w) - 1 as end))")).alias("x")).select("x.*")
    pair = at.groupBy("two").agg(F.first("before").alias("before"), F.count("*").alias("n_two"), F.sum(F.col("end").cast("long")).alias("e_two"))
    pair = cut(pair)
    one = pair.groupBy("before").agg(F.sum("n_two").alias("n_before"), F.sum("e_two").alias("e_before"))
    open_rows = said.where("not ended").select("item", "broken", "asked", F.size("w").alias("n"), F.array_join("w", " ").alias("text"), F.expr("if(size(w) > 1, concat(w[size(w) - 2], ' ', w[size(w) - 1]), null)").alias("two"), F.expr("if(size(w) > 1, w[size(w) - 2], null)").alias("before"))
    few = open_rows.where("n between 3 and 5").groupBy("text").agg(F.countDistinct("asked").alias("alike"))
    begin = said.where("size(w) > 2").select("asked", F.explode(F.expr("transform(sequence(3, least(5, size(w))), k -> array_join(slice(w, 1, k), ' '))")).alias("text")).join(few.select("text"), "text", "left_semi").groupBy("text").agg(F.countDistinct("asked").alias("begin"))
    known = few.join(begin, "text").where(f"alike > 2 and alike >= {whole} * begin").select("text", F.lit(True).alias("known"))
    judged = open_rows.join(known, "text", "left").join(pair.drop("before"), "two", "left").join(one, "before", "left")
    p = (F.coalesce("e_two", F.lit(0)) + weight * F.coalesce(F.col("e_before") / F.col("n_before"), F.lit(0.0))) / (F.coalesce("n_two", F.lit(0)) + weight)
    broken = judged.where(F.col("broken") | ((F.col("n") > 2) & (p < least) & F.col("known").isNull())).select("item", F.lit("truncated").alias("defect"))
    named = read.where("defect is not null").select("item", "defect")
    return named.union(broken).distinct()
