import random

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.crosssplit import banded, cross_split, overlap_pairs, overlap_report, word_changes

SCHEMA = "item_id bigint, question string, answer string, split string, source string, text string, train string"


def full(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("ab", max_size=12), st.text("ab", max_size=12), st.integers(0, 4))
def test_banded_distance(a, b, k):
    assert banded(a, b, k) == min(full(a, b), k + 1)


def pairs(spark, rows):
    df = spark.createDataFrame([(*r, "s", "x", "y") for r in rows], SCHEMA)
    return {(r.train_item, r.eval_item) for r in overlap_pairs(*cross_split(df, "item_id", "question", "answer", "split")).collect()}


def test_small_changes_count_other_subjects_do_not(spark):
    q = "Which goods are linked with Sazufvekak Institute?"
    rows = [
        (1, q, "indigo", "train"), (2, "What goods are linked with SAZUFVEKAK  institute ?", " Indigo.", "test"), (3, "Question: Which gods are linked with Sazufvekak Institute?", "indigo", "validation"),
        (4, "Which goods are linked with Mugovmudet Institute?", "indigo", "test"), (5, q, "honey", "test"), (6, q, "indigo", "train"), (7, "Was it first recorded in the year 1923, as the register says?", "True", "train"), (8, "Was it first recorded in the year 1928, as the register says?", "True", "test"),
    ]
    assert pairs(spark, rows) == {(1, 2), (1, 3), (6, 2), (6, 3)}


def test_edges(spark):
    rows = [(1, None, "a", "train"), (2, "", "a", "test"), (3, "Q?", None, "train"), (4, "q", "", "test"), (4, "q", "", "test"), (None, "q", "", "test"), (5, "q", "", None), (6, "long question " * 5000, "x", "train"), (7, "long question " * 5000, "x", "test")]
    assert pairs(spark, rows) == {(3, 4), (6, 7)}
    assert pairs(spark, []) == set()


def test_every_single_slip_is_found(spark):
    r = random.Random(3)
    base = "which merchant carried copper wire to the harbour of pusectabal before winter"
    rows = [(0, base, "x", "train")]
    for i in range(1, 60):
        p = r.choice([k for k, c in enumerate(base) if c != " " and (k + 1 >= len(base) or base[k + 1] != " ") and base[k - 1] != " "])
        t = base[:p] + r.choice(["", "z", base[p] + "z"]) + base[p + 1 :]
        rows.append((i, t, "x", "test"))
    assert pairs(spark, rows) == {(0, i) for i in range(1, 60)}


def test_report(spark):
    df = spark.createDataFrame([(1, "a b c d e", "x", "train", "S", "", ""), (2, "A b c d e", "x", "test", " s", "", ""), (3, "a b c d e", "x", "test", None, "", "")], SCHEMA)
    links, members = cross_split(df, "item_id", "question", "answer", "split")
    got = {(r.split, r.source, r["items"], r.exact, r.near) for r in overlap_report(links, members, df, "item_id", "split", "source").collect()}
    assert got == {("test", "s", 1, 1, 0), ("test", None, 1, 1, 0)}


def test_word_changes():
    assert word_changes("a cat sat", "a cta sat") == [("cat", "cta")]
    assert word_changes("in 1923", "in 1928") is None and word_changes("ab cd", "abcd") == []


def test_short_questions_have_near_matches(spark):
    rows = [(1, "Who is X?", "a", "train"), (2, "Whp is X?", "a", "test"), (3, "Who is Y?", "a", "test"), (4, "Wh is X", "a", "test"), (5, "ab", "b", "train"), (6, "a", "b", "test"), (7, "ax", "b", "test")]
    assert pairs(spark, rows) == {(1, 2), (1, 4), (5, 7)}


def test_common_words_are_no_slips_of_each_other_at_any_size(spark):
    for n in (5, 80):
        rows = [(i, f"Which merchant sold copper wire in {'abcdefghij'[i % 10]}{i:x} harbour", "x", "train") for i in range(n)]
        rows += [(1000 + i, f"Which merchant sold copper wine in z{i:x} harbour", "y", "train") for i in range(n)]
        rows += [(2000, "Which merchant sold copper wine in a0 harbour", "x", "test"), (2001, "Which mercant sold copper wire in a0 harbour", "x", "test")]
        assert pairs(spark, rows) == {(0, 2001)}, n


def test_the_engine_s_banded_distance_is_the_same(spark):
    from pyspark.sql import functions as F

    r = random.Random(9)
    word = lambda: "".join(r.choice("aạ\U00020000b ") for _ in range(r.randrange(9)))
    ps = [(word(), word()) for _ in range(400)]
    got = [x.d for x in spark.createDataFrame(ps, "x string, y string").select(F.levenshtein("x", "y", 3).alias("d")).collect()]
    assert got == [d if (d := banded(x, y, 3)) <= 3 else -1 for x, y in ps]
