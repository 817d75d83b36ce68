import random
from collections import defaultdict

from hypothesis import given as given_
from hypothesis import settings
from hypothesis import strategies as st

from millrace.llm.names import CHANCE, FEW, LEARNED, RIVAL, STANDS, UNIT, WIDE, compare, form, lcs, lcs_ratio, name_variants, short_names

SCHEMA = "node_id string, name string, label string, mentions array<string>, node string, root string, form string"


NICK = [("Patty", "Patricia"), ("Quin", "Quentin"), ("Fdn", "Foundation"), ("Kate", "Katherine"), ("Kate", "Catherine"), (None, "x"), ("a", "a")]


def groups(spark, rows, nick=None):
    df = spark.createDataFrame([(i, n, lab, m, "x", "y", "z") for i, n, lab, m in rows], SCHEMA)
    nick = nick and spark.createDataFrame(nick, "short string, full string")
    out = {}
    for r in name_variants(df, nicknames=nick).collect():
        out.setdefault(r.root, set()).add(r.node)
    return sorted(sorted(g) for g in out.values() if len(g) > 1)


def test_variants_meet(spark):
    rows = [
        ("a1", "Patricia Gefarbohul", "PERSON", None), ("a2", "GEFARBOHUL, Patricia", "PER", []), ("a3", "P. Gefarbohul", "PERSON", ["P. Gefarbohul"]), ("a4", "Dr. Patricia Gefarbohl", None, None), ("a5", "Patty Gefarbohul", "PERSON", None),
        ("b1", "Quentin Gefarbohul", "PERSON", None), ("b2", "Quin Gefarbohul", "PER", None),
        ("c1", "Tidobbetel Foundation of Public Archives", "ORG", None), ("c2", "Fdn. of Public Archives (Tidobbetel)", "ORGANIZATION", None), ("c3", "TFPA", "ORG", ["Tidobbetel Foundation for Public Archives"]),
        ("d1", "Công ty Cổ phần Tidobbetel", "ORG", None), ("d2", "Tidobbetel JSC", "ORG", None), ("e1", "TFPA", "ORG", None),
        ("f1", "Đặng Kim Hội Thuận", "PERSON", None), ("f2", "DANG KIM HOI THUAN", "PER", None), ("f3", "Thuận, Đặng Kim Hội", "PER", None), ("f4", "Đặng Kim Hội Thuấn", "PER", None),
    ]
    got = groups(spark, rows, NICK)
    assert ["a1", "a2", "a3", "a4", "a5"] in got and ["b1", "b2"] in got and ["c1", "c2", "c3"] in got and ["d1", "d2"] in got
    assert all("e1" not in g and not ("a1" in g and "b1" in g) for g in got)


def test_an_initial_that_fits_two_people_joins_neither(spark):
    got = groups(spark, [("a", "Robert Zupospodan", "PER", None), ("b", "Rebecca Zupospodan", "PER", None), ("c", "R. Zupospodan", "PER", None)])
    assert got == []


def test_edges(spark):
    assert groups(spark, [(None, "X Yyyyyyyy", "PER", None), ("a", None, None, None), ("b", "", "PER", []), ("c", "  ", None, [None, ""]), ("d", "n" * 3000, "ORG", None), ("e", "n" * 3000, "ORG", None), ("e", "n" * 3000, "ORG", None)]) == [["d", "e"]]
    assert groups(spark, []) == []


def test_comparison():
    said = lambda a, b, often=None, may=None: compare(a, b, often or {}, may or {})[0]
    assert said("gefarbohul patricia", "gefarbohl patricia") == 2
    assert said("gefarbohul p", "gefarbohul patricia") == 1
    assert said("gefarbohul quentin", "gefarbohul patricia") == 0
    assert said("3000 detokzisec", "250 detokzisec") == 0
    assert said("catherine x", "katherine x", {"catherine": 100, "katherine": 80}) == 0
    assert said("gefarbohul kate", "catherine gefarbohul", None, {"kate": ["catherine", "katherine"]}) == 1
    assert compare("gefarbohul mus", "gefarbohul museum", {}, {}) == (1, 1) and compare("gefarbohul phố thành", "gefarbohul tp", {}, {})[0] == 1
    assert lcs_ratio("abcd", "abxd") == 0.75 and lcs_ratio("", "") == 1.0
    assert form("LMRT", "ORG") is None and form(None, None) is None


@settings(max_examples=300, deadline=None)
@given_(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert lcs(a, b) == best[-1][-1]


def test_short_names_are_learned_from_the_table(spark):
    people = ["Gefarbohul", "Tidobbetel", "Nojifbutup", "Zuposdupez"]
    rows = [(f"{f}{i}", f"{g} {f}", "PER", None) for f in people for i, g in enumerate(("Robert", "Bob"))] + [("m", "Maria Gefarbohul", "PER", None), ("p", "Peter Zavenrehib", "PER", None), ("q", "Bob Zavenrehib", "PER", None)]
    assert groups(spark, rows) == sorted([f"{f}0", f"{f}1"] for f in people)


def test_a_slip_is_linked_however_common_the_family(spark):
    pair = [("a", "Mark Stevenson", "PER", None), ("b", "Mrak Stevenson", "PER", None)]
    given = ["Julia", "Peter", "Victor", "Edith", "Oscar", "Wanda", "Felix", "Irene", "Hugo", "Zelda", "Boris", "Carla", "Dennis", "Gwen", "Luise"]
    for n in (0, 15, 400):
        others = [(f"o{i}", f"{given[i % 15]}{'' if i < 15 else 'bcdfghjklmnpqrstvwxz'[i % 20] + 'aeiou'[i % 5] + 'bcdfghjklmnpqrstvwxz'[i // 20 % 20]} Stevenson", "PER", None) for i in range(n)]
        assert ["a", "b"] in [[x for x in g if x in "ab"] for g in groups(spark, pair + others)], n


def test_an_initial_meets_a_common_family(spark):
    rows = [("a", "J. Wetherby", "PER", None), ("b", "John Wetherby", "PER", None)] + [(f"o{i}", f"{chr(97 + i % 9)}{'aeiou'[i % 5]}{chr(98 + i // 9 % 20)}{chr(98 + i // 3 % 20)}o Wetherby", "PER", None) for i in range(60)]
    assert any({"a", "b"} <= set(g) for g in groups(spark, rows))


def test_one_name_on_a_third_of_all_rows(spark):
    rows = [(f"n{i}", "Patricia Gefarbohul" if i < 300 else f"Zo{i}mun Bi{i * 7919}kor", "PER", None) for i in range(900)]
    assert max(map(len, groups(spark, rows))) == 300


def test_a_block_of_over_64_forms_loses_no_pair(spark):
    r = random.Random(7)
    fill = [(f"f{i}", "Wetherby Gefarbohul Tezo" + "".join(r.choice("bcfghjklpqsuvwxy") for _ in range(6)), "PER", None) for i in range(100)]
    rows = [("a", "Wetherby Gefarbohul Tezomandir", "PER", None), ("b", "Wetherby Q. Gefarbohul Tezomandr", "PER", None)]
    found = lambda rs: [sorted(n for n in g if n in "ab") for g in groups(spark, rs) if set(g) & set("ab")]
    assert found(rows + fill) == found(rows) == [["a", "b"]]


def learned(forms):
    """Short names of two-word forms by every pair of tokens that share a rest."""
    beside, rests = defaultdict(set), defaultdict(set)
    for x, y in {tuple(sorted(f.split(" "))) for f in forms}:
        for rest, token in ((x, y), (y, x)):
            beside[rest].add(token)
            rests[token].add(rest)
    w = {r: UNIT if len(t) <= WIDE else UNIT * (WIDE - 1) // (len(t) - 1) for r, t in beside.items()}
    places, found = sum(map(len, beside.values())), {}
    for s, mine in rests.items():
        whole, others = sum(w[r] for r in mine), sum(w[r] * (len(beside[r]) - 1) for r in mine)
        for f in set().union(*(beside[r] for r in mine)):
            both = mine & rests[f]
            n = sum(w[r] for r in both)
            if (len(s), s) < (len(f), f) and (len(s) <= FEW or 2 * lcs(s, f) >= len(s)) and n >= LEARNED * UNIT and n >= STANDS * whole:
                if sum(w[r] == UNIT for r in both) >= LEARNED or n >= CHANCE * others * len(rests[f]) / places:
                    found[s, f] = n
    top = {}
    for (s, f), n in found.items():
        top[s] = max(top.get(s, (0, "")), (n, f))
    sums = defaultdict(lambda: defaultdict(int))
    for (s, f), n in found.items():
        f = top[f][1] if f in top else f
        sums[s][f] += n if s != f else 0
    kept = {s: [f for f, n in fs.items() if n and n >= RIVAL * max(fs.values())] for s, fs in sums.items()}
    return sorted((s, f, len(fs) > 1) for s, fs in kept.items() for f in fs)


def test_short_names_beside_remainders_of_many_tokens(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(n))
    families = [word(4) + "son" for _ in range(60)]
    wide = [f"{word(3)} {f}" for f in families for _ in range(30)] + [f"{g} {f}" for f in families[:8] for g in ("robert", "bob")]
    dense = [f"{g} {f}" for g in [word(2 + i % 2) for i in range(30)] for f in families[:30]]
    mixed = wide + [f"{g} {r.choice(families)}" for g in [word(2) for _ in range(40)] for _ in range(r.randint(1, 12))] + [f"{g} {word(3)}" for g in families[:5] for _ in range(100)]
    for forms in (wide, dense, mixed):
        got = sorted(map(tuple, short_names(spark.createDataFrame([("P", " ".join(sorted(f.split(" ")))) for f in set(forms)], "kind string, tokens string")).collect()))
        assert got == learned(forms)
        assert (("bob", "robert", False) in got) == (forms is not dense) and (forms is not dense or not got)
