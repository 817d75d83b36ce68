from millrace.llm.pairs import copied, defective_pairs, first_defect

SCHEMA = "item_id bigint, question string, answer string, defect string, item string, w string"


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return {(r["item"], r.defect) for r in defective_pairs(df, "item_id", "question", "answer").collect()}


def test_single_rules():
    q = "Which goods are linked with Sazufvekak Institute?"
    assert first_defect(q, None) == first_defect(q, " ​") == first_defect(q, "N/A") == first_defect(q, "...") == "empty"
    assert first_defect(q, "I'm sorry, but I can't help with that.") == first_defect(q, "Tôi không thể trả lời câu hỏi này.") == "refusal"
    assert first_defect(q, f'You asked: "{q.upper()}"') == first_defect(q, q + " " + q) == "copied_question"
    assert first_defect(q, "Trong sổ kế toán, Sazufvekak Institute được nhắc cùng với dây thừng.") == "wrong_language"
    assert first_defect(q, "In the accounts, Sazufvekak Institute is mentioned together with rope.") is None
    assert first_defect(q, "rope") is None and first_defect(q, "Tihatsenor") is None and first_defect(None, "It was sold in the year 1836.") is None
    assert not copied(q, "rope")


def test_truncation_follows_the_corpus(spark):
    q = "How large is the file on {}?"
    rows = [(i, q.format(f"Name{i}"), f"The file on Name{i} holds {i} pages and is kept in the reading room.") for i in range(60)]
    rows += [(100, q.format("A"), "The file on Some Name holds 12 pages and is"), (101, q.format("B"), "The file on Other Name holds 12 pages and is kept in the reading room"), (102, q.format("C"), "12345"), (103, q.format("D"), "The file on Third Name…"), (104, q.format("E"), "sugar cane")]
    assert found(spark, rows) == {(100, "truncated"), (103, "truncated")}


def test_edges(spark):
    rows = [(None, "q?", "x"), (1, None, None), (1, None, None), (2, "", "An answer that ends."), (3, "q?", "word " * 40_000 + "end.")]
    assert found(spark, rows) == {(1, "empty")}
    assert found(spark, []) == set()
