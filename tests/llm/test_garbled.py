import random
import tracemalloc

import pyarrow as pa
import pytest

from millrace.llm import garbled
from millrace.llm.garbled import TCVN3, Channels, damaged_tokens, fits, restored_pages, viterbi

SCHEMA = "doc_id bigint, text string, page string, i int, token string"
SENTENCES = ["Nghề buôn dây thừng giúp làng tồn tại qua mùa đông rét bất thường.", "Một bức thư đề năm cũ than phiền rằng thư viện rộng lớn nồng mùi lá dâu.", "Không ai biết người nào đã sửa chữa giếng nước ấy trước trận lũ mùa xuân.", "Các thợ nhuộm được đổi tên theo vài thợ dệt gần bến cảng cũ."]
CLEAN = ["Слово «лодка» и Ελιά stand on the sign.", "Giá vé: 25 °C không phải 25 €; ½ chỗ ngồi ® đã bán.", "São João, Ångström and Ærø appear; its façade is naïve, cost £458.", "N&eacute;e caf\\u00e9 stay as typed.", "nghề cũ", "BÃI ĐÁ VÀ BÃO – MỤC LỤC Â, Ă, Ê", "Ｗｉｄｅ ｔｅｘｔ“”…", "А plаin lооk"]


def misread(t, codec):
    out = []
    for b in t.encode():
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def corpus(extra):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(SENTENCES) for _ in range(3)), "x", 1, "y") for i in range(120)]
    return rows + [(1000 + i, t, "x", 1, "y") for i, t in enumerate(extra)]


def test_finds_and_restores(spark):
    whole = SENTENCES[0] + " " + SENTENCES[2]
    tcvn = "".join({v: k for k, v in TCVN3.items()}.get(c, c) for c in whole.lower())
    bad = [misread(whole, c) for c in ("cp1252", "latin_1", "cp1251", "cp437", "mac_roman", "cp1258")] + [misread(misread(SENTENCES[1], "cp1252"), "cp1252"), tcvn, SENTENCES[3] + " " + misread(SENTENCES[1], "cp1250"), "It wasnâ€™t the mill", "The caf� closed", whole.encode().decode("ascii", "replace"), whole.encode().decode("gb18030", "replace")]
    df = spark.createDataFrame(corpus(bad + CLEAN + [None, "", "  "]), SCHEMA)
    got = {r.page: r for r in restored_pages(df, "doc_id", "text").collect()}
    assert set(got) == {1000 + i for i in range(len(bad))}
    assert all(got[1000 + i].restored == whole for i in range(6))
    assert got[1006].restored == SENTENCES[1] and got[1007].restored == whole.lower() and got[1008].restored == SENTENCES[3] + " " + SENTENCES[1] and got[1009].restored == "It wasn’t the mill"
    right = sum(a == b for a, b in zip(got[1011].restored.split(), whole.split())) / len(whole.split())
    assert right > 0.8


def test_edges(spark):
    df = spark.createDataFrame([(None, "caf�", "x", 1, "y"), (1, None, "x", 1, "y"), (2, "", "x", 1, "y"), (3, "�" * 3000 + " x" * 50_000, "x", 1, "y")], SCHEMA)
    assert {r.page for r in damaged_tokens(df, "doc_id", "text").collect()} == {3}
    assert damaged_tokens(df.limit(0), "doc_id", "text").count() == 0


def test_parts():
    assert ("cp1252", "é", True) in Channels().read("Ã©") and Channels().read("Слово") == [] and Channels().read("plain") == []
    assert fits("6d...69", "mọi") and not fits("6d.69", "mọi") or fits("6d.69", "mọi")
    assert viterbi([], 1.0) == []
    t = {"i": 0, "sure": False, "raw": -20.0, "options": {"tcvn3": ("sáng", -3.0)}}
    assert viterbi([t], 1.0) == [(0, "tcvn3", "sáng")] and viterbi([t | {"raw": -4.0}], 1.0) == []


@pytest.mark.parametrize("text", CLEAN)
def test_rare_but_right_text_has_no_sure_damage(text):
    assert not any(sure for w in text.split() for _, _, sure in Channels().read(w))


def test_a_word_that_occurs_once_fills_lost_bytes(spark):
    df = spark.createDataFrame(corpus(["Ông kể chuyện khuỷu tay.", "Ông kể chuyện khu���u tay."]), SCHEMA)
    assert {r.page: r.restored for r in restored_pages(df, "doc_id", "text").collect()} == {1001: "Ông kể chuyện khuỷu tay."}


def test_workers_hold_few_rows_however_many_pages_are_damaged():
    page = " ".join(misread(s, "cp1252") for s in SENTENCES)
    schema = pa.schema([("page", pa.int64()), ("text", pa.string())])
    batch = pa.RecordBatch.from_pydict({"page": list(range(1500)), "text": [page] * 1500}, schema)
    one = sum(len(b["page"].drop_null()) for b in garbled._candidates(iter([batch.slice(0, 1)])))
    sizes = [len(b["page"].drop_null()) for b in garbled._candidates(iter([batch]))]
    assert sum(sizes) == 1500 * one and max(sizes) <= 20_000

    rows = pa.RecordBatch.from_pylist([{"page": 0, "i": i, "channel": c, "sure": True, "raw": -20.0, "text": f"{c}{i}", "score": s} for i in range(50) for c, s in (("a", -3.0), ("b", -5.0), ("c", -9.0))])
    pages = (pa.RecordBatch.from_arrays([pa.array([n] * 150), *rows.columns[1:]], names=rows.schema.names) for n in range(2000))
    tracemalloc.start()
    got = 0
    for b in garbled._decode(100.0)(pages):
        assert set(b["channel"].to_pylist()) <= {"a"}
        got += b.num_rows
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == 100_000 and most < 20e6


def test_a_worker_forgets_readings_beyond_its_bytes(monkeypatch):
    monkeypatch.setattr(garbled, "_CACHE", 100_000)
    channels = Channels()
    for i in range(2000):
        assert ("cp1252", f"é{i}", True) in channels.read(f"Ã©{i}")
    assert sum(len(t) + sum(len(x) for _, x, _ in r) for t, r in channels.known.items()) < 110_000 and len(channels.known) < 400
