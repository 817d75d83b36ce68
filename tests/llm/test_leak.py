import random

from millrace.functions.fold import words
from millrace.llm.leak import Index, leaked_passages

PAGES, ITEMS = "doc_id bigint, text string, page string, item string", "item_id bigint, question string, passage string, answer string, page string, shared string"


def runs(t):
    w = words(t)
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)}


def test_search_equals_brute_force(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(3, 60)))) for i in range(80)]
    pages = []
    for p in range(200):
        parts = []
        for _ in range(r.randrange(1, 4)):
            t = r.choice(items)[1].split()
            a = r.randrange(len(t))
            parts += t[a : a + r.randrange(1, len(t) + 1)] + [r.choice(vocabulary)]
        pages.append((p, " ".join(parts).upper()))
    want = {(p, i) for p, t in pages for i, q in items if runs(q) and 2 * len(runs(q) & runs(t)) >= len(runs(q))}
    got = leaked_passages(spark.createDataFrame([(p, t, "x", "y") for p, t in pages], PAGES), spark.createDataFrame([(i, "q w1", q, None, "x", "y") for i, q in items], ITEMS), "doc_id", "text", "item_id", "passage", "question", "answer")
    assert len(want) > 40 and {(x.page, x["item"]) for x in got.collect()} == want


def test_edges(spark):
    p = "one two three four five six seven"
    pages = spark.createDataFrame([(1, p, "x", "y"), (1, p, "x", "y"), (2, None, "x", "y"), (3, "", "x", "y"), (None, p, "x", "y"), (4, p + " z" * 200_000, "x", "y"), (5, "five six seven", "x", "y")], PAGES)
    items = spark.createDataFrame([(7, "two?", p, None, "x", "y"), (7, "two?", p, None, "x", "y"), (8, None, None, None, "x", "y"), (9, "q", "a b c", "d", "x", "y"), (None, "q", p, "d", "x", "y")], ITEMS)
    args = ("doc_id", "text", "item_id", "passage", "question", "answer")
    got = sorted((x.page, x["item"], x.question_part, x.answer_part) for x in leaked_passages(pages, items, *args).collect())
    assert got == [(1, 7, 1.0, None), (1, 7, 1.0, None), (4, 7, 1.0, None)]
    assert leaked_passages(pages.limit(0), items, *args).count() == leaked_passages(pages, items.limit(0), *args).count() == 0


def test_weights_keep_half_of_the_runs_at_one():
    ix = Index([(1, "a b c d e f g h"), (2, "a b c d x y z")], 0.5)
    for i in range(2):
        own = sorted(w for o, w in zip(ix.owner.tolist(), ix.weight.tolist()) if o == i)
        assert abs(sum(own[: -(-len(own) // 2)]) - 1) < 1e-9
