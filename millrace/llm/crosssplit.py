"""Same or near-same question-answer records across splits: an edit-distance segment join.

Questions are compared as read, without lead-ins and with interchangeable question words brought to
one (tables of both are parameters); answers must be equal as read. An evaluation question is cut into
segments of Q characters, one below 2 Q into two halves. At most K edits destroy at most K of any K+1 segments, so its K+1 segments that occur least often in
training questions (with the same answer) are enough: each is matched against the training substrings
at positions shifted by at most K, and candidates are verified by banded dynamic programming.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.fold import as_read, words
from millrace.session import cut

Q, K = 5, 3
#: A slip of a word is seen at most this often: a few times by itself, and in this share of the word's questions.
SLIPS, SLIP_SHARE = 3, 0.05
# Phrases before a question that don't change what is asked.
LEAD_INS = ("please tell me", "could you tell me", "can you tell me", "tell me", "please", "question", "quick one", "quick question", "câu hỏi", "cho biết", "xin cho biết", "hãy cho biết", "xin hỏi", "cho hỏi", "xin vui lòng")
# Question words and particles that stand for one another.
SAME = {"what": "which", "gì": "nào", "mấy": "bao nhiêu", "đã": "", "vậy": "", "thế": "", "ạ": "", "please": "", "hãy": "", "tới": "đến", "bằng": "trong"}
# The same for phrases.
PHRASES = (("most closely", "closest"), ("recorded first", "first recorded"))


def asking(lead_ins: Iterable[str] = LEAD_INS, same: dict[str, str] = SAME, phrases: Iterable[tuple[str, str]] = PHRASES) -> Callable[[str | None], str]:
    """A function that brings questions to the form in which they are compared."""
    lead = re.compile(r"^(?:(?:" + "|".join([*map(re.escape, sorted(lead_ins, key=len, reverse=True)), r"(?!)"]) + r")\s+)+(?=\S)")

    def asked(question: str | None) -> str:
        text = lead.sub("", " ".join(words(question)))
        for old, new in phrases:
            text = text.replace(old, new)
        return " ".join(x for w in text.split(" ") if (x := same.get(w, w)))

    return asked


def _read(asked: Callable[[str | None], str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = [asked(x) for x in batch.column(2).to_pylist()]
            a = [as_read(x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(q, pa.string()), pa.array(a, pa.string())], names=["item", "train", "q", "a"])

    return run


def banded(a: str, b: str, k: int) -> int:
    """Edit distance of a and b, or k + 1 if it's more than k; a band of 2k + 1 cells a row."""
    if a == b:
        return 0
    n, m, big = len(a), len(b), k + 1
    if abs(n - m) > k:
        return big
    row = [d - k if 0 <= d - k <= m else big for d in range(2 * k + 1)]
    for i in range(1, n + 1):
        new, x = [], a[i - 1]
        for d in range(2 * k + 1):
            j = i + d - k
            if j < 0 or j > m:
                new.append(big)
            elif j == 0:
                new.append(min(i, big))
            else:
                up = row[d + 1] + 1 if d < 2 * k else big
                left = new[d - 1] + 1 if d else big
                new.append(min(row[d] + (x != b[j - 1]), up, left, big))
        if min(new) > k:
            return big
        row = new
    return min(row[m - n + k], big)


def word_changes(a: str, b: str, most: int = 2) -> list[tuple[str, str]] | None:
    """The words that differ, in pairs, if each can be a slip of the other; else None.

    A blank lost or gained inside a word is a slip too. Words with digits must be equal.
    """
    x, y = a.split(" "), b.split(" ")
    while x and y and x[0] == y[0]:
        x, y = x[1:], y[1:]
    while x and y and x[-1] == y[-1]:
        x, y = x[:-1], y[:-1]
    if len(x) != len(y):
        p, q = "".join(x), "".join(y)
        return [] if p == q or (x and y and banded(p, q, most) <= most and len(x) + len(y) <= 5 and not re.search(r"\d", p + q)) else None
    changes = [(p, q) for p, q in zip(x, y) if p != q]
    for p, q in changes:
        if any(c.isdigit() for c in p + q) or banded(p, q, most) > most or min(len(p), len(q)) < 2:
            return None
    return changes


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        said = [word_changes(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        keep = pa.array([c is not None for c in said], pa.bool_())
        changes = pa.array([[{"x": p, "y": q} for p, q in c] for c in said if c is not None], pa.list_(pa.struct([("x", pa.string()), ("y", pa.string())])))
        yield pa.RecordBatch.from_arrays([*[batch.column(i).filter(keep) for i in (0, 1, 4)], changes], names=["e", "t", "edits", "changes"])


def cross_split(records: DataFrame, item: str, question: str, answer: str, split: str, train: str = "train", asked: Callable[[str | None], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, members) between evaluation and training records.

    members(item, train, text): records by distinct question and answer; links(e, t, edits): texts e of
    evaluation and t of training that ask the same; copies aren't expanded into pairs. Records without
    a question as read, and those with null item or split, are left out. A null, blank or equal answer
    as read is the same answer. A question of n segments allows min(K, n - 1) edits, one of fewer than
    2 Q characters one, and equality always counts. Two different words aren't slips of each other when
    the rarer one occurs in more than SLIPS questions and a share SLIP_SHARE of the other's. Repeated
    rows count once; empty tables give empty results. asked brings questions to the form compared.
    """
    rows = records.select(F.col(item).cast("long").alias("item"), (F.col(split) == train).alias("train"), F.col(question).cast("string").alias("q"), F.col(answer).cast("string").alias("a")).where("item is not null and train is not null")
    read = rows.mapInArrow(_read(asked or asking()), "item long, train boolean, q string, a string").where("q <> ''")
    read = cut(read.select("item", "train", "q", F.xxhash64("a").alias("akey"), F.xxhash64("q", "a").alias("text")).distinct())
    texts = read.groupBy("text", "train").agg(F.first("q").alias("q"), F.first("akey").alias("akey"))
    evals, trains = texts.where("not train").drop("train"), texts.where("train").drop("train")
    # an answer that only one side has can't be shared: its texts are out before any substring is made
    shared = texts.groupBy("akey").agg(F.bool_or("train").alias("x"), F.bool_or(~F.col("train")).alias("y")).where("x and y").select("akey")
    evals, trains = cut(evals.join(shared, "akey", "left_semi")), cut(trains.join(shared, "akey", "left_semi"))
    # short questions are cut in halves; short training questions give substrings of every such length
    short = 2 * Q
    cuts = evals.where("length(q) > 1").withColumn("len", F.length("q")).withColumn("size", F.expr(f"if(len < {short}, len div 2, {Q})")).withColumn("n", F.expr("len div size"))
    cuts = cuts.select("text", "akey", "len", F.expr(f"if(len < {short}, 1, least({K}, n - 1))").alias("k"), F.explode(F.expr("transform(sequence(0, n - 1), i -> struct(i * size as pos, substring(q, i * size + 1, size) as part))")).alias("s")).select("text", "k", "len", "s.pos", F.xxhash64("akey", "s.part").alias("key"))
    sizes = F.expr(f"if(length(q) <= {short}, sequence(1, least({Q}, length(q))), array({Q}))")
    grams = trains.withColumn("len", F.length("q")).select("text", "q", "len", "akey", F.explode(sizes).alias("size")).where("len >= size")
    grams = grams.select("text", "len", "akey", F.explode(F.expr("transform(sequence(0, len - size), i -> struct(i as pos, substring(q, i + 1, size) as part))")).alias("s")).select("text", "len", "s.pos", F.xxhash64("akey", "s.part").alias("key"))
    wanted = cuts.select("key").distinct()
    grams = cut(grams.join(wanted, "key", "left_semi"))
    often = grams.groupBy("key").agg(F.count("*").alias("often"))
    rank = Window.partitionBy("text").orderBy(F.coalesce("often", F.lit(0)), "pos")
    chosen = cuts.join(often, "key", "left").withColumn("r", F.row_number().over(rank)).where("r <= k + 1 and often is not null")
    near = chosen.select(F.col("text").alias("e"), "k", F.col("len").alias("elen"), F.col("pos").alias("epos"), "key").join(grams.select(F.col("text").alias("t"), F.col("len").alias("tlen"), F.col("pos").alias("tpos"), "key"), "key").where("abs(epos - tpos) <= k and abs(elen - tlen) <= k and e <> t").select("e", "t", "k").distinct()
    found = near.join(evals.select(F.col("text").alias("e"), F.col("q").alias("x")), "e").join(trains.select(F.col("text").alias("t"), F.col("q").alias("y")), "t")
    # banded dynamic programming, in whole-stage code; K is the widest band
    found = found.withColumn("edits", F.levenshtein("x", "y", K)).where("edits between 0 and k").select("e", "t", "x", "y", "edits")
    found = cut(found.mapInArrow(_verify, "e long, t long, edits int, changes array<struct<x string, y string>>"))
    change = found.select("e", "t", F.explode("changes").alias("c")).select("e", "t", "c.x", "c.y")
    asked_words = change.select(F.explode(F.array("x", "y")).alias("word")).distinct()
    known = cut(texts.select("text", "q").distinct().select(F.explode(F.array_distinct(F.split("q", " "))).alias("word")).join(asked_words, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n")))
    both = change.join(known.select(F.col("word").alias("x"), F.col("n").alias("nx")), "x").join(known.select(F.col("word").alias("y"), F.col("n").alias("ny")), "y")
    false = both.where(f"least(nx, ny) > {SLIPS} + {SLIP_SHARE} * greatest(nx, ny)").select("e", "t").distinct()
    same = evals.select("text").join(trains.select("text"), "text").select(F.col("text").alias("e"), F.col("text").alias("t"), F.lit(0).alias("edits"))
    links = same.union(found.join(false, ["e", "t"], "left_anti").select("e", "t", "edits"))
    return cut(links), read.select("item", "train", "text").distinct()


def overlap_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(train_item, eval_item) for every link between records."""
    t = members.where("train").select(F.col("item").alias("train_item"), F.col("text").alias("t"))
    e = members.where("not train").select(F.col("item").alias("eval_item"), F.col("text").alias("e"))
    return links.join(e, "e").join(t, "t").where("train_item <> eval_item").select("train_item", "eval_item").distinct()


def overlap_report(links: DataFrame, members: DataFrame, records: DataFrame, item: str, split: str, source: str) -> DataFrame:
    """(split, source, items, exact, near): evaluation records with a copy in training, per split and source.

    Sources are trimmed and in lower case, blank or null ones together as null.
    """
    kind = links.groupBy("e").agg(F.min("edits").alias("edits"))
    hit = members.where("not train").join(kind, members["text"] == kind["e"]).groupBy("item").agg(F.min("edits").alias("edits"))
    named = records.select(F.col(item).alias("item"), F.col(split).alias("split"), F.nullif(F.lower(F.trim(F.col(source))), F.lit("")).alias("source")).distinct()
    return named.join(hit, "item").groupBy("split", "source").agg(F.countDistinct("item").alias("items"), F.countDistinct(F.when(F.col("edits") == 0, F.col("item"))).alias("exact"), F.countDistinct(F.when(F.col("edits") > 0, F.col("item"))).alias("near"))
