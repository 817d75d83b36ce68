import random
import unicodedata

from millrace.llm.visual import _parts, look_alikes, visual_forms

SCHEMA = "record_kind string, key string, text string, kind string, pos int, cluster string, note string"


def rows(spark, data):
    return spark.createDataFrame([(k, i, t, "x", 1, "y", "z") for k, i, t in data], SCHEMA)


def brute(t):
    s = unicodedata.normalize("NFD", "".join(unicodedata.normalize("NFD", _parts(c)) for c in t.replace("\r\n", "\n").replace("\r", "\n")))
    out, own = [], []
    for c in [*s, "\n"]:
        if unicodedata.combining(c):
            own += [c] * (c not in own)
            continue
        out += sorted(own, key=lambda m: (unicodedata.combining(m), m not in "\u0302\u0306\u031b"))
        out.append(c)
        own = []
    return "\n".join(x.rstrip(" ") for x in unicodedata.normalize("NFC", "".join(out[:-1])).split("\n"))


def test_forms_match_brute_force(spark):
    r = random.Random(2)
    alphabet = "abc Đđệễơ1-—\n" + "ａｂ！" + "̣́̂" + "​﻿  ­" + "аеОι" + "ﬁ…²" + "漢가\U0001d400"
    data = [("d", f"k{i}", "".join(r.choice(alphabet) for _ in range(r.randrange(1, 30)))) for i in range(300)]
    got = {x.key: x.form for x in visual_forms(rows(spark, data), "text").collect()}
    assert not [(t, got[k], brute(t)) for _, k, t in data if got[k] != brute(t)]


def test_pairs(spark):
    data = [("d", "a", "Lý Kim"), ("d", "b", unicodedata.normalize("NFD", "Lý Kim")), ("d", "c", "Lý Kim"), ("d", "d", "Lý Kim"), ("d", "e", "lý Kim"), ("d", "f", "Lý  Kim"), ("e", "g", "Lý Kim"), ("d", "h", "Ｌý Kim"), ("d", "i", "Lу́ Kim")]
    got = {(x.key_a, x.key_b) for x in look_alikes(rows(spark, data), "record_kind", "key", "text").collect()}
    same = ["a", "b", "c", "d", "h", "i"]
    assert got == {(x, y) for x in same for y in same if x < y} - {("a", "d")}


def test_edges(spark):
    data = [("d", "a", None), ("d", None, "x"), ("d", "b", ""), ("d", "c", "​"), ("d", "e", "  "), (None, "f", "é"), (None, "g", "é"), ("d", "h", "ａ" * 100_000), ("d", "i", "a" * 100_000), ("d", "i", "a" * 100_000)]
    assert {(x.kind, x.key_a, x.key_b) for x in look_alikes(rows(spark, data), "record_kind", "key", "text").collect()} <= {("d", "h", "i"), (None, "f", "g")}
    assert ("d", "h", "i") in {(x.kind, x.key_a, x.key_b) for x in look_alikes(rows(spark, data), "record_kind", "key", "text").collect()}
    assert look_alikes(rows(spark, []), "record_kind", "key", "text").count() == 0
    assert visual_forms(rows(spark, [("d", "a", None), ("d", "b", "")]), "text").select("form").collect() == [(None,), ("",)]


def test_characters_of_all_planes_and_many_marks(spark):
    rows = [("d", "a", "\U0002f800 x"), ("d", "b", "丽 x"), ("d", "c", "e" + "́" * 100_500 + "̖ y"), ("d", "e", "é̖ y"), ("d", "f", "z\U000e0041z"), ("d", "g", "zz")]
    got = {(r.key_a, r.key_b) for r in look_alikes(spark.createDataFrame(rows, "kind string, key string, text string"), "kind", "key", "text").collect()}
    assert got == {("a", "b"), ("c", "e"), ("f", "g")}
