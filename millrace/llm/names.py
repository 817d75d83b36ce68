"""Variant spellings of names: suffix blocking, longest-common-subsequence comparison, linking.

1. every name and mention becomes a form: the text as read, titles and small words dropped, tokens sorted;
   equal forms are one row from here on, so a name that fills a third of all rows is compared once;
2. short names are learned: a shorter token stands for a longer one (Bob, Robert) if a good share of the
   remainders it occurs beside also stand beside the longer; remainders of many tokens weigh less, but all
   are counted. An open table of such pairs may be given as well. A token with one such reading is written out, one with several stays open;
3. suffix blocking. All suffixes of at least MIN letters of every token are indexed, and a token's key is
   its shortest suffix that at most CAP forms share. Two forms with a common suffix that rare meet there.
   Where even the whole token is overly common it is refined with other fields before it is given up: the
   form's other long tokens as they are, and parts of one token that a slip leaves alone (ends of three
   letters; all forms with one letter less for short tokens), or its initial. These blocks have no cap;
   large ones are compared in parts;
4. pairs are compared token by token by the longest-common-subsequence ratio. Two tokens are a slip of each
   other only if one of them is rare against the other, so the measure doesn't change as the table grows;
5. links and a node's own forms give components. An initial, an open short name or a name without
   accents joins a component only if no other component would do.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.fold import fold
from millrace.operators.components import connected_components
from millrace.session import cut

# Titles before or after a name, without accents.
TITLES = ("dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "dame", "ts", "gs", "pgs", "ths", "bs", "ks", "ong", "ba", "co", "anh", "chi")
# Small words without weight in a name.
SMALL = ("the", "of", "for", "and", "a", "an", "place", "person", "organization", "org", "company_", "event", "inc", "ltd", "limited")
# Ways to write a joint stock company; all read "jsc".
JOINT_STOCK = ("cong ty co phan", "cong ty cp", "c ty co phan", "c ty cp", "cty co phan", "cty cp", "ctcp", "joint stock company", "joint stock co", "joint-stock company", "jsc")
# The label sets of extractors, brought to one letter.
KINDS = {"person": "P", "per": "P", "organization": "O", "org": "O", "organisation": "O", "location": "L", "loc": "L", "gpe": "L", "work": "W", "work_of_art": "W", "concept": "C", "product": "R", "event": "E"}
_TOKEN = re.compile(r"[^\W_]+")
#: Fewest letters of an indexed suffix, and most forms of a block by a suffix alone.
MIN, CAP = 4, 24
#: Forms of a refined block that are compared in one part.
PART = 1024
#: A slip of a word is seen at most this often: a few times by itself, and in this share of the word's forms.
SLIPS, SLIP_SHARE = 3, 0.05
#: A short name is learned beside at least so many different rests, and in this share of its rests; others of RIVAL against the best keep it open.
LEARNED, STANDS, RIVAL = 2, 0.25, 0.4
#: A rest that more than WIDE tokens share counts less, in proportion; what such rests are needed for must be CHANCE times what is expected. Weights are whole numbers, 1 is UNIT.
WIDE, CHANCE, UNIT = 24, 3, 10**9
#: A short name of more letters must have half of them in common with what it stands for.
FEW = 6


def bare(text: str) -> str:
    """Without accents."""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).replace("đ", "d").replace("ø", "o")


def form(name: str | None, label: str | None) -> tuple[str, str, str] | None:
    """(kind, sorted tokens with accents, the same in reading order joined without blanks); None for acronyms and empty names."""
    if not name or not name.strip():
        return None
    kind = KINDS.get((label or "").strip().lower(), "")
    plain = unicodedata.normalize("NFKC", name)
    text = fold(name)
    kept = _TOKEN.findall(text)
    if len(kept) == 1 and 2 <= len(kept[0]) <= 6 and _TOKEN.findall(plain.strip())[:1] and plain.strip().isupper() and kind in ("O", ""):
        return None
    person = kind == "P"
    if "," in text and not re.search(r",\s*(ltd|inc|jsc|llc|corp|co)\b", text):
        head, _, tail = text.partition(",")
        if _TOKEN.search(tail):
            text = f"{tail} {head}"
    tokens = _TOKEN.findall(text)
    if kind in ("O", ""):
        flat = " ".join(bare(t) for t in tokens)
        for j in JOINT_STOCK:
            if (m := re.search(rf"(?:^| )({j})(?: |$)", flat)):
                at = flat[: m.start(1)].count(" ")
                tokens[at : at + j.count(" ") + 1] = ["jsc"]
                break
    if person or not kind:
        while len(tokens) > 1 and bare(tokens[0]) in TITLES and (tokens[0] in ("dr", "prof", "ts", "gs", "pgs", "ths", "professor", "mr", "mrs", "ms") or len(tokens) > 4):
            tokens = tokens[1:]
        while len(tokens) > 2 and tokens[-1] in ("dr", "prof", "ts", "gs", "jr", "sr"):
            tokens = tokens[:-1]
    if not person:
        tokens = [t for t in tokens if t not in SMALL] or tokens
    if not tokens:
        return None
    return kind, " ".join(sorted(tokens)), "".join(bare(t) for t in tokens)


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rest, mark, token): every long token of a form beside the other long ones, with the kind; mark is the longest of these."""
    for batch in batches:
        rests, marks, tokens = [], [], []
        for kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            long = [t for t in text.split(" ") if len(t) > 1]
            for k, t in enumerate(long if len(long) > 1 else ()):
                if not any(c.isdigit() for c in t):
                    rest = sorted(map(bare, long[:k] + long[k + 1 :]))
                    rests.append(f"{kind}|{' '.join(rest)}")
                    marks.append(max(rest, key=len))
                    tokens.append(t)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (rests, marks, tokens)], names=["rest", "mark", "token"])


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of which the first may be a short form: of few letters, or with half its letters in the other; not a matter of accents."""
    for batch in batches:
        keep = [(p := bare(a)) != (q := bare(b)) and (len(p) <= FEW or 2 * lcs(p, q) >= len(p)) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield batch.filter(pa.array(keep, pa.bool_()))


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["node", "kind", "tokens", "joined"]
    for batch in batches:
        out: list[tuple] = []
        for node, name, label, mentions in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if node is not None:
                out += [(node, *f) for f in {form(x, label) for x in [name, *(mentions or [])]} - {None}]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(4)], names=names)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, row by row in the bits of one number."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def shortened(t: str, u: str) -> bool:
    """Whether t may be written for u: its first letter and a subsequence, at most half as long; short words only without vowels."""
    return 2 <= len(t) <= len(u) / 2 and t[0] == u[0] and (len(u) >= 6 or not re.search("[aeiouy]", t)) and lcs(t, u) == len(t)


def compare(a: str, b: str, often: dict[str, int], may: dict[str, list[str]], least: float = 0.78) -> tuple[int, int]:
    """(said, side). said: 2: the same thing; 1: the same if nothing else fits (an initial, missing accents); -1: that, with a slip; 0: not.
    side: 1 or 2 if the first or second name is shortened, so that it depends on the other; else 0.

    often: forms of each token; may: what the tokens that stand for several may stand for.
    """
    x, y = a.split(" "), b.split(" ")
    bx, by = sorted(map(bare, x)), sorted(map(bare, y))
    if bx == by:
        if sorted(x) == sorted(y):
            return 2, 0
        return (1 if a.isascii() or b.isascii() else 0), 0
    same = 0
    left_x, left_y = list(x), list(y)
    for t in x:
        hit = next((u for u in left_y if u == t), None) or next((u for u in left_y if bare(u) == bare(t) and (u.isascii() or t.isascii())), None)
        if hit:
            left_x.remove(t)
            left_y.remove(hit)
            same += 1
    if not same and not len(x) == len(y) == 1:
        return 0, 0
    side = 0
    weak = a.isascii() != b.isascii()
    for p, q in ((left_x, left_y), (left_y, left_x)):
        for t in sorted(p, key=len):
            if len(t) == 1 and (hit := next((u for u in q if len(u) > 1 and bare(u)[0] == bare(t)), None)):
                p.remove(t)
                q.remove(hit)
                weak = weak or same < 2
            elif t in may and (hit := next((u for u in q if u in may[t]), None)):
                p.remove(t)
                q.remove(hit)
                weak = True
    for p, q in ((left_x, left_y), (left_y, left_x)):
        for t in list(p):
            if (hit := next((u for u in q if shortened(bare(t), bare(u))), None)):
                if same < 2:
                    weak, side = True, 1 if p is left_x else 2
                p.remove(t)
                q.remove(hit)
            elif 2 <= len(t) <= 4 and len(q) == len(t) and len(p) == 1 and sorted(bare(t)) == sorted(bare(u)[0] for u in q):
                p.remove(t)  # the first letters of all words left
                q.clear()
    if same >= 2:
        left_x, left_y = [t for t in left_x if len(t) > 1], [t for t in left_y if len(t) > 1]
    if len(left_x) != len(left_y) or len(left_x) > 2:
        return 0, 0
    long_same = any(len(u) > 6 for u in x if u in y)
    for t in left_x:
        best = max(left_y, key=lambda u: lcs_ratio(bare(t), bare(u)))
        p, q = bare(t), bare(best)
        few, many = sorted((often.get(t, 1), often.get(best, 1)))
        if p == q or few > SLIPS + SLIP_SHARE * many or t.isdigit() or best.isdigit():
            return 0, 0
        short = min(len(p), len(q))
        if short < 3 or (short < 6 and same < 2 and not long_same) or lcs_ratio(p, q) < (0.7 if short < 6 else least) or abs(len(p) - len(q)) > 2:
            return 0, 0
        left_y.remove(best)
    return ((-1 if left_x else 1) if weak else 2), side


def _parts(token: str, alone: bool) -> set[str]:
    """Parts of a token of which a single slip leaves one alone; alone says that nothing else tells it apart."""
    out = {f"<{token[:3]}", f">{token[-3:]}"} if len(token) >= 6 and not alone else set()
    return out | {token, *(token[:i] + token[i + 1 :] for i in range(len(token)))} if alone or len(token) <= 6 else out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(form, key, role): blocks of a form; role 1 and 2 meet each other only (names in full and with an initial)."""
    for batch in batches:
        ids, keys, roles = [], [], []
        for i, bares, suffixes, joined, may in zip(*(batch.column(j).to_pylist() for j in range(5))):
            rare = {t: s for t, s in zip(bares, suffixes) if s is not None}
            whole = sorted(t for t in bares if len(t) > 1)
            own = {(f"={' '.join(sorted(bares))}", 0), (f"={' '.join(whole)}", 0), (f"j{joined}", 0)} | {(f"s{s}", 0) for s in rare.values()}
            for k, out in enumerate(whole):
                rest = whole[:k] + whole[k + 1 :]
                if any(t in rare for t in rest):
                    continue
                tail = " ".join(rest)
                own |= {(f"r{tail}|{p}", 0) for p in _parts(out, not rest)}
                if rest:
                    own.add((f"i{tail}|{out[0]}", 1))
            for t in bares:
                if len(t) == 1 and whole and not any(u in rare for u in whole):
                    own.add((f"i{' '.join(whole)}|{t}", 2))
            for t, f in may or []:
                if t in whole:
                    rest = list(whole)
                    rest.remove(t)
                    own.add((f"={' '.join(sorted([*rest, f]))}", 0))
            ids += [i] * len(own)
            for key, role in own:
                keys.append(key)
                roles.append(role)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(roles, pa.int32())], names=["form", "key", "role"])


def _judge(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = []
            for x, y, nx, ny, mx, my, jx, jy in zip(*(batch.column(i).to_pylist() for i in range(2, 10))):
                if jx == jy and sorted(x.replace(" ", "")) == sorted(y.replace(" ", "")):
                    said.append((2, 0))
                    continue
                may: dict[str, list[str]] = {}
                for t, f in [*(mx or []), *(my or [])]:
                    may.setdefault(t, []).append(f)
                said.append(compare(x, y, dict(zip([*x.split(" "), *y.split(" ")], [*nx, *ny])), may, least))
            keep = pa.array([s != 0 for s, _ in said], pa.bool_())
            said = [x for x in said if x[0]]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), *[pa.array([x[i] for x in said], pa.int32()) for i in range(2)]], names=["a", "b", "said", "side"])

    return run


def _bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([bare(t) for t in batch.column("canon").to_pylist()], pa.string())], names=[*batch.schema.names, "bare"])


def short_names(forms: DataFrame) -> DataFrame:
    """(short, full, open) from forms(kind, tokens): what short names stand for; open ones have several readings.

    Two tokens occur together when forms have them beside the same rest. A rest weighs 1, or, where n tokens
    share it and n is above WIDE, (WIDE - 1) / (n - 1); none is left out. The longer stands for the shorter where
    the rests that both stand beside weigh at least LEARNED and at least the share STANDS of all rests of the
    shorter; rests with one longest token count as one, the heaviest. Where fewer than LEARNED of them weigh 1, they must
    also weigh CHANCE times what the longer's number of rests lets expect.
    """
    seen = cut(forms.select("kind", "tokens").mapInArrow(_left_out, "rest string, mark string, token string").select(F.xxhash64("rest").alias("rest"), "mark", "token").distinct())
    size = seen.groupBy("rest").agg(F.count("*").alias("k")).withColumn("w", F.expr(f"if(k <= {WIDE}, {UNIT}L, greatest(1L, {UNIT}L * {WIDE - 1} div (k - 1)))"))
    marks = seen.join(size, "rest").groupBy("token", "mark").agg(F.max("w").alias("w"), F.min("k").alias("k"), F.count("*").alias("rests"))
    # nothing is shared beyond a token's own weight
    tokens = cut(marks.groupBy("token").agg(F.sum("w").alias("all"), F.sum(F.expr("w * (k - 1)")).alias("others"), F.sum("rests").alias("rests")).where(f"all >= {LEARNED * UNIT}"))
    places = float(seen.count())
    heavy = cut(seen.join(size.where("k > 1"), "rest").join(tokens.select("token", "all"), "token"))
    # a partner has to share one of the heavier rests: the lighter ones together aren't enough
    running = Window.partitionBy("token").orderBy("w", "mark")
    first = heavy.groupBy("token", "mark", "all").agg(F.max("w").alias("w")).withColumn("sum", F.sum("w").over(running)).where(f"sum >= {LEARNED * UNIT}L and sum >= {STANDS} * all").select("token", "mark")
    short = heavy.join(first, ["token", "mark"]).select("rest", F.col("token").alias("short"))
    pairs = cut(short.join(heavy.select("rest", F.col("token").alias("full")), "rest").where("struct(length(short), short) < struct(length(full), full)").select("short", "full").distinct().mapInArrow(_plausible, "short string, full string"))
    shared = pairs.join(heavy.select(F.col("token").alias("short"), "rest", "mark", "w"), "short").join(heavy.select(F.col("token").alias("full"), "rest"), ["full", "rest"])
    shared = shared.groupBy("short", "full", "mark").agg(F.max("w").alias("w")).groupBy("short", "full").agg(F.sum("w").alias("n"), F.sum(F.expr(f"int(w = {UNIT})")).alias("narrow")).where(f"n >= {LEARNED * UNIT}")
    of = lambda c, *more: tokens.select(F.col("token").alias(c), *more)
    learned = shared.join(of("short", "all", "others"), "short").join(of("full", "rests"), "full").where(f"n >= {STANDS} * all and (narrow >= {LEARNED} or n >= {CHANCE} * others * (rests / {places}D))")
    pairs = cut(learned.select("short", "full", "n"))
    best = pairs.groupBy("short").agg(F.max_by("full", F.struct("n", "full")).alias("top"))
    # a longer form that itself is short for another counts for that one
    pairs = pairs.join(best.select(F.col("short").alias("full"), "top"), "full", "left").select("short", F.coalesce("top", "full").alias("full"), "n").where("short <> full").groupBy("short", "full").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("short")
    return pairs.withColumn("most", F.max("n").over(w)).where(f"n >= {RIVAL} * most").withColumn("open", F.count("*").over(w) > 1).select("short", "full", "open")


def name_variants(entities: DataFrame, node: str = "node_id", name: str = "name", label: str = "label", mentions: str = "mentions", least: float = 0.78, nicknames: DataFrame | None = None) -> DataFrame:
    """(node, root): nodes that share a root stand for one thing.

    label and mentions may be null; a node without a usable form (null, blank or a bare acronym with
    no other mention) isn't in the result, nor are null nodes. Repeated rows and several rows of one
    node count together. Names are read whole. nicknames(short, full), if given, is used beside the short
    names learned from mentions. Extra columns are ignored; an empty table gives none.
    """
    rows = entities.select(F.col(node).cast("string").alias("node"), F.col(name).cast("string").alias("name"), F.col(label).cast("string").alias("label"), F.col(mentions).cast("array<string>").alias("mentions"))
    raw = rows.mapInArrow(_forms, "node string, kind string, tokens string, joined string").distinct()
    # an unlabelled form takes the kind that the same tokens have elsewhere
    kinds = raw.groupBy("tokens").agg(F.max("kind").alias("real"))
    raw = cut(raw.join(kinds, "tokens").select("node", F.coalesce(F.nullif("kind", F.lit("")), F.col("real")).alias("kind"), "tokens", "joined").withColumn("raw", F.xxhash64("kind", "tokens")))
    each = raw.groupBy("raw").agg(F.first("kind").alias("kind"), F.first("tokens").alias("tokens"), F.min("joined").alias("joined"))
    short = short_names(each)
    if nicknames is not None:
        given = nicknames.select(F.lower("short").alias("short"), F.lower("full").alias("full")).where("short is not null and full is not null and short <> full").distinct()
        short = short.select("short", "full").union(given).distinct().withColumn("open", F.count("*").over(Window.partitionBy("short")) > 1)
    short = cut(short)
    inc = each.select("raw", "kind", "joined", F.explode(F.split("tokens", " ")).alias("token"))
    # the vocabulary: what a token stands for, in how many forms, and its key in the suffix index
    vocabulary = inc.groupBy("token").agg(F.count("*").alias("n")).join(short.where("not open").select(F.col("short").alias("token"), "full"), "token", "left")
    vocabulary = cut(vocabulary.select("token", F.coalesce("full", "token").alias("canon"), "n").mapInArrow(_bare, "token string, canon string, n long, bare string"))
    often = vocabulary.groupBy("canon").agg(F.sum("n").alias("often"), F.first("bare").alias("bare"))
    suffix = vocabulary.groupBy("bare").agg(F.sum("n").alias("n")).where("length(bare) > 1").select("bare", "n", F.explode(F.expr(f"transform(sequence(least({MIN}, length(bare)), length(bare)), i -> right(bare, i))")).alias("suffix"))
    usable = suffix.groupBy("suffix").agg(F.sum("n").alias("forms")).where(f"forms <= {CAP}").select("suffix")
    chosen = suffix.join(usable, "suffix").groupBy("bare").agg(F.min_by("suffix", F.length("suffix")).alias("suffix"))
    open_names = short.where("open").groupBy("short").agg(F.sort_array(F.collect_set("full")).alias("may"))
    words = vocabulary.select("token", "canon").join(often, "canon").join(chosen, "bare", "left").join(open_names, F.col("canon") == F.col("short"), "left").select("token", "canon", "bare", "often", "suffix", "may")
    whole = inc.join(words, "token").groupBy("raw").agg(F.first("kind").alias("kind"), F.first("joined").alias("joined"), F.sort_array(F.collect_list(F.struct("canon", "bare", "often", "suffix", "may"))).alias("t"))
    may = F.flatten(F.transform("t", lambda x: F.transform(F.coalesce(x["may"], F.array().cast("array<string>")), lambda f: F.array(x["canon"], f))))
    whole = cut(whole.select("raw", "kind", "joined", F.array_join("t.canon", " ").alias("tokens"), F.col("t.bare").alias("bares"), F.col("t.often").alias("often"), F.col("t.suffix").alias("suffixes"), may.alias("may")).withColumn("form", F.xxhash64("kind", "tokens")))
    said = cut(raw.join(whole.select("raw", "form"), "raw").select("node", "form").distinct())
    forms = cut(whole.groupBy("form").agg(F.min_by(F.struct("kind", "joined", "tokens", "bares", "often", "suffixes", "may"), F.struct("joined", "raw")).alias("f")).select("form", "f.*"))
    keys = forms.select("form", "bares", "suffixes", "joined", "may").mapInArrow(_keys, "form long, key string, role int").select("form", F.xxhash64("key").alias("key"), "role").distinct()
    keys = cut(keys)
    size = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    blocks = keys.join(size, "key").withColumn("part", F.expr("cast(pmod(xxhash64(form), parts) as int)")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select("form", "key", "role", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    side = lambda c: blocks.select("key", "one", "two", F.col("form").alias(c), F.col("role").alias(f"r{c}"))
    pairs = side("a").join(side("b"), ["key", "one", "two"]).where("(ra = 0 and rb = 0 and a < b) or (ra = 1 and rb = 2 and a <> b)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda c: forms.select(F.col("form").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in ("tokens", "often", "may", "joined", "kind", "bares")])
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where("(kind_a = kind_b or kind_a = '' or kind_b = '') and (arrays_overlap(bares_a, bares_b) or joined_a = joined_b or (size(bares_a) = 1 and size(bares_b) = 1))")
    judged = cut(pairs.select("a", "b", "tokens_a", "tokens_b", "often_a", "often_b", "may_a", "may_b", "joined_a", "joined_b").mapInArrow(_judge(least), "a long, b long, said int, side int"))
    # initials, open short names and names without accents aren't hubs: they join a component only if it is the only one
    lean = forms.select("form", F.expr("(exists(bares, t -> length(t) = 1) or size(may) > 0) and size(filter(bares, t -> length(t) > 1 and not exists(may, m -> m[0] = t))) < 2").alias("initial"), F.expr("tokens rlike '^[ -~]*$'").alias("ascii"))
    weak = judged.where("said <> 2")
    ends = weak.select(F.col("a").alias("form"), F.col("b").alias("other"), "said", F.expr("side = 1").alias("cut"), F.expr("side = 2").alias("oc")).union(weak.select("b", "a", "said", F.expr("side = 2"), F.expr("side = 1")))
    dependent = ends.join(lean, "form").where("not oc and (cut or initial or ascii)").join(lean.select(F.col("form").alias("other"), F.col("initial").alias("oi"), F.col("ascii").alias("oa")), "other").where("not oi and (cut or initial or ascii and not oa)").select("form", "other", "said")
    dependent = cut(dependent)
    dependents = cut(dependent.select("form").union(lean.where("initial").select("form")).distinct())
    hubs = said.join(dependents, "form", "left_anti")
    strong = judged.where("said = 2").select("a", "b").join(dependents.select(F.col("form").alias("a")), "a", "left_anti").join(dependents.select(F.col("form").alias("b")), "b", "left_anti")
    key = lambda c: F.concat(F.lit("f"), F.col(c).cast("string"))
    links = hubs.select(F.concat(F.lit("n"), F.col("node")).alias("a"), key("form").alias("b")).union(strong.select(key("a"), key("b")))
    parts = cut(connected_components(links))
    of_form = parts.where("node like 'f%'").select(F.substring("node", 2, 64).cast("long").alias("form"), "root")
    of_node = parts.where("node like 'n%'").select(F.expr("substring(node, 2)").alias("node"), "root")
    # what nodes with a dependent form say by their other forms counts as well
    by_pair = dependent.join(of_form.withColumnRenamed("form", "other"), "other").select("form", "root", F.expr("if(said = 1, 0, 1)").alias("rank"))
    by_node = said.join(dependents, "form", "left_semi").join(of_node, "node").select("form", "root", F.lit(0).alias("rank"))
    of_rank = lambda f, r: f(F.when(F.col("rank") == r, F.col("root")))
    choice = by_pair.union(by_node).groupBy("form").agg(F.coalesce(of_rank(F.min, 0), of_rank(F.min, 1)).alias("root"), F.coalesce(of_rank(F.max, 0), of_rank(F.max, 1)).alias("last"))
    loose = said.join(dependents, "form", "left_semi").join(of_node, "node", "left_anti")
    late = loose.join(choice, "form", "left").where("root is null or root = last").select("node", F.coalesce("root", key("form")).alias("root")).groupBy("node").agg(F.min("root").alias("root"))
    return of_node.union(late)
