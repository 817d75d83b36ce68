"""String resolution of entities: greedy merging into the first similar canonical of a type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import acronym, compact, words
from millrace.operators.dedup import greedy_keep_first, set_pairs
from millrace.session import cut


def name_tokens(c: Column) -> Column:
    """Distinct lower-case tokens of a name."""
    return F.array_distinct(words(F.lower(c)))


def surface_compatible(a: Column, b: Column) -> Column:
    """Equal names, a shared token, or one the acronym of the other."""
    la, lb = F.lower(F.trim(a)), F.lower(F.trim(b))
    return (la == lb) | F.arrays_overlap(name_tokens(a), name_tokens(b)) | ((acronym(a) != "") & (acronym(a) == compact(b))) | ((acronym(b) != "") & (acronym(b) == compact(a)))


def resolve_strings(entities: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(pos, canonical_pos): each entity with the first canonical of its type whose name is similar enough.

    entities(pos, name, type), pos unique. In order of pos an entity merges into the first canonical
    before it whose tokens have that Jaccard similarity, or becomes one; a canonical's name never
    changes. The rule runs over distinct (type, token set) pairs, so names repeated any number of times
    take part once. Null types count as empty; an entity without a name never merges.
    """
    e = entities.select("pos", F.lower(F.trim(F.coalesce("name", F.lit("")))).alias("n"), F.coalesce("type", F.lit("")).alias("type"))
    tokens = F.transform(F.array_sort(name_tokens(F.col("n"))), lambda t: F.concat(F.col("type"), F.lit("\x1f"), t))
    keyed = cut(e.select("pos", F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.concat("type", F.lit("\x1f\x1f"), F.col("pos").cast("string")))).alias("s")).withColumn("h", F.sha2(F.array_join("s", "\x1e"), 256)))
    forms = cut(keyed.groupBy("h").agg(F.min("pos").alias("id"), F.first("s").alias("s")))
    pairs = cut(set_pairs(forms, "id", "s", threshold).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))
    merged = cut(greedy_keep_first(pairs, "u", "v"))
    into = pairs.join(merged, F.col("u") == F.col("id"), "left_anti").join(merged, F.col("v") == F.col("id"), "left_semi").groupBy("v").agg(F.min("u").alias("u"))
    out = forms.select("h", "id").join(into, F.col("id") == F.col("v"), "left").select("h", F.coalesce("u", "id").alias("canonical_pos"))
    return keyed.join(out, "h").select("pos", "canonical_pos")


def resolve_embeddings(entities: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(pos, canonical_pos): each entity with the first seed before it of its type that is compatible in name and close in meaning.

    entities(pos, name, type, embedding), pos unique. In order of pos an entity joins the first seed it is
    linked to, or becomes one: only seeds attract, so links to joined entities don't count. Candidates
    share a token of the name, the whole name or an acronym with its expansion, all equi-joins; then names
    and the cosine decide. Null names, types or vectors never join.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    e = entities.select("pos", "name", F.coalesce("type", F.lit("")).alias("type"), F.transform("embedding", lambda x: x.cast("double")).alias("v")).where("name is not null and v is not null").withColumn("n", norm).where("n > 0")
    e = cut(e)
    keys = F.array_distinct(F.filter(F.concat(name_tokens(F.col("name")), F.array(F.concat(F.lit("="), F.lower(F.trim("name"))), F.concat(F.lit("a"), F.nullif(acronym(F.col("name")), F.lit(""))), F.concat(F.lit("a"), compact(F.col("name"))))), lambda x: x.isNotNull()))
    k = e.select("pos", "type", F.explode(keys).alias("k"))
    pairs = k.join(k.select(F.col("pos").alias("later"), "type", "k"), ["type", "k"]).where("pos < later").select("pos", "later").distinct()
    side = lambda p, t: e.select(F.col("pos").alias(p), *[F.col(c).alias(f"{c}{t}") for c in ("name", "v", "n")])
    both = pairs.join(side("pos", "_a"), "pos").join(side("later", "_b"), "later")
    dot = F.aggregate(F.zip_with("v_a", "v_b", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    links = cut(both.where(surface_compatible(F.col("name_a"), F.col("name_b")) & (dot / (F.col("n_a") * F.col("n_b")) >= threshold)).select(F.col("pos").alias("u"), F.col("later").alias("v")))
    joined = cut(greedy_keep_first(links, "u", "v"))
    into = links.join(joined, F.col("u") == F.col("id"), "left_anti").join(joined, F.col("v") == F.col("id"), "left_semi").groupBy("v").agg(F.min("u").alias("u"))
    return entities.select("pos").join(into, F.col("pos") == F.col("v"), "left").select("pos", F.coalesce("u", "pos").alias("canonical_pos"))


def merge_clusters(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """One entity per canonical: the best name (confidence, then length, then order), joined aliases, sources, longest description, highest score.

    entities(pos, name, type, aliases, source, description, confidence); mapping(pos, canonical_pos).
    """
    e = entities.join(mapping, "pos")
    alias = e.select("canonical_pos", F.explode_outer("aliases").alias("alias")).where("alias is not null").select("canonical_pos", F.lower("alias").alias("alias")).distinct().groupBy("canonical_pos").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))
    src = e.where("source is not null").groupBy("canonical_pos", "source").agg(F.min("pos").alias("p")).groupBy("canonical_pos").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "source"))), lambda x: x["source"]).alias("sources"))
    best = e.groupBy("canonical_pos").agg(
        F.max_by(F.struct("name", "type"), F.struct(F.coalesce("confidence", F.lit(0.0)), F.length("name"), -F.col("pos"))).alias("b"),
        F.max_by("description", F.struct(F.length("description"), -F.col("pos"))).alias("description"), F.max("confidence").alias("confidence"), F.count("*").alias("members"),
    )
    out = best.join(alias, "canonical_pos", "left").join(src, "canonical_pos", "left")
    empty = F.array().cast("array<string>")
    return out.select("canonical_pos", "b.name", "b.type", F.coalesce("aliases", empty).alias("aliases"), F.coalesce("sources", empty).alias("sources"), "description", "confidence", "members")


def id_mapping(entities: DataFrame, canonical: DataFrame) -> DataFrame:
    """(pos, id): each entity's canonical through the index of (type, lower-case alias or name); the last canonical to claim an alias has it."""
    index = canonical.select("type", F.col("canonical_pos"), F.explode(F.array_union(F.array(F.lower("name")), "aliases")).alias("k")).groupBy("type", "k").agg(F.max("canonical_pos").alias("id"))
    own = entities.select("pos", "type", F.lower("name").alias("k"))
    return own.join(index, ["type", "k"], "left").select("pos", F.coalesce("id", "pos").alias("id"))


def match_stored(batch: DataFrame, stored: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(pos, stored_id, similarity): for each new entity the most similar stored one of its type, or null.

    Candidates share a token (an equi-join), then the names' token similarity decides; ties go to the
    smallest id. No candidate is dropped for number.
    """
    toks = lambda d, k: d.select(F.col(k).alias("k"), "type", name_tokens(F.col("name")).alias("s"))
    a, b = toks(batch, "pos"), toks(stored, "id")
    ax, bx = a.select(F.col("k").alias("pos"), "type", "s", F.explode("s").alias("t")), b.select(F.col("k").alias("id"), "type", F.col("s").alias("z"), F.explode("s").alias("t"))
    pair = ax.join(bx, ["type", "t"]).groupBy("pos", "id").agg(F.count("*").alias("both"), F.first(F.size("s")).alias("n"), F.first(F.size("z")).alias("m"))
    sim = F.col("both").cast("double") / (F.col("n") + F.col("m") - F.col("both"))
    best = pair.select("pos", "id", sim.alias("similarity")).where(f"similarity >= {threshold}").groupBy("pos").agg(F.min_by(F.struct("id", "similarity"), F.struct((-F.col("similarity")).alias("s"), "id")).alias("b"))
    return batch.select("pos").join(best, "pos", "left").select("pos", F.col("b.id").alias("stored_id"), "b.similarity")
