import pyarrow as pa

from millrace.llm.quality import quality_profiles, statistics

PROSE = "The railway keeper lost 67 coins to the masons, since every ferry of the town guarded a temple.\nIt was told that the engineers and the teachers shared a tramway until the war set them apart."


def test_kinds():
    texts = [PROSE, "Site,a,b\nX,1,2\nY,3,4\nZ,5,6", "- red mill\n- old ferry\n- new temple\n- blue kiln", "tea salt rice silk rope mill ferry kiln " * 5, PROSE + "\nCopyright 2020 | Home | Contact", "!!!! @@@@ ####\n%%%% ^^^^", "the same line of words in it\n" * 9, "a1B2" * 200, "Đồn điền cũ của làng đã di dời và các thợ xây trở về khi mùa lũ qua đi.", PROSE.replace(", ", ",\n").replace(" of ", "\nof ")]
    got = statistics(pa.array(texts))["is_prose"].tolist()
    assert got == [True, False, False, False, True, False, False, False, True, True]


def test_figures():
    s = statistics(pa.array(["One two, three.\nOne two, three.\n\nfour", " ", ""]))
    assert s["word_count"].tolist() == [7, 0, 0] and s["char_count"].tolist() == [37, 1, 0]
    assert abs(s["symbol_ratio"][0] - 4 / 37) < 1e-9 and abs(s["repeated_line_ratio"][0] - 2 / 3) < 1e-9
    assert s["reasons"][1] == s["reasons"][2] == ["blank"] and not s["is_prose"][1]


def test_edges(spark):
    schema = "doc_id string, content string, key string, prose_share string"
    df = spark.createDataFrame([("a", None, "x", "y"), (None, PROSE, "x", "y"), ("b", "", "x", "y"), ("c", "line of words\n" * 100_000, "x", "y"), ("d", PROSE, "x", "y"), ("d", PROSE, "x", "y")], schema)
    rows = quality_profiles(df, "doc_id", "content").collect()
    assert sorted((r.key or "", r.is_prose) for r in rows) == [("", True), ("b", False), ("c", False), ("d", True), ("d", True)]
    assert quality_profiles(df.limit(0), "doc_id", "content").count() == 0
