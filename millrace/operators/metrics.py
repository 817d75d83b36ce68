"""Graph audits, coverage, and answer metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.functions.text import char_ngrams, kg_name, strip, words
from millrace.operators.graph import degrees, reachable, weak_components

GENERIC = ("ENTITY", "UNKNOWN", "NAMED_ENTITY", "CONCEPT")


def _share(cond: Column) -> Column:
    return F.coalesce(F.avg(F.coalesce(cond, F.lit(False)).cast("double")), F.lit(0.0))


def graph_quality(entities: DataFrame, triples: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: completeness, consistency, duplication, missing information, format errors, labelling, reusability, overall.

    entities(id, name, type, aliases, description); triples(subject, predicate, object). Each measure is
    one aggregate; the largest weak component comes from the component job.
    """
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    has_alias = F.coalesce(F.size("aliases"), F.lit(-1)) > 0
    e = entities.agg(
        ((_share(filled("name")) + _share(filled("type")) + _share(has_alias)) / 3).alias("completeness"), _share(~filled("type") | ~has_alias | (F.col("type") == "UNKNOWN")).alias("missing_information"),
        _share(filled("type") & ~F.col("type").isin(*GENERIC)).alias("labeling_quality"), _share(~F.coalesce(F.col("type"), F.lit("")).isin("ENTITY", "UNKNOWN", "Chunk", "Document")).alias("meaningful"), _share(filled("description")).alias("described"),
        (1 - F.countDistinct(F.lower("name")) / F.count("*")).alias("entity_duplication"), F.count("*").alias("entities"),
    )
    ids = nodes.select("id").distinct()
    t = triples.join(ids.select(F.col("id").alias("subject"), F.lit(True).alias("s")), "subject", "left").join(ids.select(F.col("id").alias("object"), F.lit(True).alias("o")), "object", "left")
    key = F.concat_ws("\x1f", *[F.coalesce(c, F.lit("")) for c in ("subject", "predicate", "object")])
    t = t.agg(_share(F.col("s").isNull() | F.col("o").isNull()).alias("loose"), (1 - F.countDistinct(key) / F.count("*")).alias("triple_duplication"), _share(~(filled("subject") & filled("predicate") & filled("object"))).alias("format_errors"))
    n = nodes.agg(_share(F.col("type").isNull() | F.col("type").isin("UNKNOWN", "")).alias("untyped"), F.count("*").alias("nodes"))
    m = edges.agg(F.count("*").alias("edges"))
    big = weak_components(nodes, edges).groupBy("component").agg(F.count("*").alias("c")).agg(F.coalesce(F.max("c"), F.lit(0)).alias("largest"))
    r = e.join(t).join(n).join(m).join(big)
    r = r.withColumn("consistency", ((1 - F.col("loose")) + (1 - F.col("untyped"))) / 2).withColumn("duplication_level", (F.col("entity_duplication") + F.col("triple_duplication")) / 2)
    some, linked = (F.col("nodes") > 0).cast("double"), (F.col("edges") > 0).cast("double")
    r = r.withColumn("reusability", 0.2 * some + 0.2 * linked + 0.2 * linked * F.col("largest") / F.greatest("nodes", F.lit(1)) + 0.2 * F.col("meaningful") + 0.2 * F.col("described"))
    r = r.withColumn("overall", (F.col("completeness") + F.col("consistency") + F.col("labeling_quality") + F.col("reusability") + (1 - F.col("duplication_level")) + (1 - F.col("format_errors")) + (1 - F.col("missing_information"))) / 7)
    return r.select("completeness", "consistency", "duplication_level", "missing_information", "format_errors", "labeling_quality", "reusability", "overall")


def orphan_audit(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: orphans, their share, entity and chunk orphans, health and flag."""
    d = degrees(nodes, edges).join(nodes.select("id", "type"), "id").withColumn("orphan", (F.col("out_degree") + F.col("in_degree")) == 0)
    doc = F.coalesce(F.col("type"), F.lit("")).isin("Chunk", "Document")
    r = d.agg(F.sum(F.col("orphan").cast("long")).alias("orphan_count"), F.avg(F.col("orphan").cast("double")).alias("r"), F.sum((F.col("orphan") & ~doc).cast("long")).alias("entity_orphans"), F.sum((F.col("orphan") & doc).cast("long")).alias("chunk_orphans"))
    return r.select("orphan_count", F.round("r", 4).alias("orphan_rate"), "entity_orphans", "chunk_orphans", F.round(F.greatest(F.lit(0.0), 100 - F.col("r") * 300), 1).alias("health_score"), F.when(F.col("r") > 0.3, "red").when(F.col("r") > 0.1, "yellow").otherwise("green").alias("flag"))


def density_audit(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: density of the directed graph, health and flag; 0 and 100 below two nodes."""
    r = nodes.agg(F.count("*").alias("n")).join(edges.agg(F.count("*").alias("m")))
    d = F.when(F.col("n") < 2, 0.0).otherwise(F.col("m") / (F.col("n") * (F.col("n") - 1)))
    r = r.select("n", d.alias("d"))
    health = F.when(F.col("n") < 2, 100.0).when(F.col("d") < 0.005, F.greatest(F.lit(0.0), F.col("d") * 2000)).when(F.col("d") <= 0.2, 100.0).otherwise(F.greatest(F.lit(0.0), 100 - (F.col("d") - 0.2) * 500))
    return r.select(F.round("d", 6).alias("density"), F.round(health, 1).alias("health_score"), F.when((F.col("n") >= 2) & (F.col("d") < 0.005), "red").when(F.col("d") > 0.2, "yellow").otherwise("green").alias("flag"))


def schema_audit(triples: DataFrame, nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """One row: violations of domain and range over all triples, compliance, health and flag.

    rules(predicate, domain, range) is a small ontology; a triple can break both sides; an end without a type breaks none.
    """
    kind = nodes.select("id", "type").where("type is not null and type <> ''")
    t = triples.join(F.broadcast(rules), "predicate", "left").join(kind.select(F.col("id").alias("subject"), F.col("type").alias("st")), "subject", "left").join(kind.select(F.col("id").alias("object"), F.col("type").alias("ot")), "object", "left")
    bad = lambda want, have: (F.coalesce(F.col(want), F.lit("")) != "") & F.col(have).isNotNull() & (F.col(want) != F.col(have))
    r = t.agg(F.coalesce(F.sum(bad("domain", "st").cast("long") + bad("range", "ot").cast("long")), F.lit(0)).alias("violations"), F.count("*").alias("n"))
    c = 1 - F.col("violations") / F.greatest("n", F.lit(1))
    return r.select("violations", F.round(c, 4).alias("compliance_rate"), F.round(c * 100, 1).alias("health_score"), F.when(c < 0.8, "red").when(c < 0.95, "yellow").otherwise("green").alias("flag"))


def hop_audit(nodes: DataFrame, edges: DataFrame, sample: int = 200) -> DataFrame:
    """One row: shares reachable in two and three hops from the first `sample` nodes by id, health and flag."""
    starts = nodes.select("id").orderBy("id").limit(sample)
    s = starts.count()
    seen = reachable(nodes, edges, starts, 3)
    r = seen.agg(F.coalesce(F.sum((F.col("depth") <= 2).cast("long")), F.lit(0)).alias("a"), F.count("*").alias("b"))
    pairs = max(s * (s - 1), 1)
    r = r.select((F.col("a") / pairs).alias("p2"), (F.col("b") / pairs).alias("p3"))
    mean = (F.col("p2") + F.col("p3")) / 2
    return r.select(F.round("p2", 4).alias("reachable_2hop"), F.round("p3", 4).alias("reachable_3hop"), F.round(F.least(F.lit(100.0), mean * 200), 1).alias("health_score"), F.when(mean < 0.1, "red").when(mean < 0.3, "yellow").otherwise("green").alias("flag"))


def verdict(score: Column) -> Column:
    """A word for a health score."""
    return F.when(score >= 80, "excellent").when(score >= 60, "good").when(score >= 40, "fair").otherwise("poor")


def fact_coverage(facts: DataFrame, names: DataFrame, triples: DataFrame) -> DataFrame:
    """One row: facts matched exactly, as a connected pair, or by a mention of both ends, and the weighted score.

    facts(subject, predicate, object) and triples by name (s, p, o); names(name). Names are compared in
    lower case without articles and closing punctuation. All matches are equi-joins.
    """
    f = facts.select(F.monotonically_increasing_id().alias("f"), kg_name(F.col("subject")).alias("a"), F.lower("predicate").alias("p"), kg_name(F.col("object")).alias("b")).distinct()
    t = triples.select(kg_name(F.col("s")).alias("a"), F.lower("p").alias("p"), kg_name(F.col("o")).alias("b")).distinct()
    n = names.select(kg_name(F.col("name")).alias("n")).distinct()
    any_pair = t.select("a", "b").union(t.select("b", "a")).distinct().withColumn("linked", F.lit(True))
    f = f.join(t.withColumn("exact", F.lit(True)), ["a", "p", "b"], "left").join(any_pair, ["a", "b"], "left").join(n.select(F.col("n").alias("a"), F.lit(True).alias("ha")), "a", "left").join(n.select(F.col("n").alias("b"), F.lit(True).alias("hb")), "b", "left")
    r = f.agg(F.count("*").alias("facts"), F.count("exact").alias("exact"), F.count("linked").alias("connected"), F.count(F.when(F.col("ha") & F.col("hb"), 1)).alias("mentioned"))
    rate = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("facts")), F.lit(0.0))
    return r.withColumn("coverage", F.round(0.5 * rate("exact") + 0.3 * rate("connected") + 0.2 * rate("mentioned"), 4))


def answer_tokens(c: Column) -> Column:
    """Distinct lower-case words of an answer, cut at blanks."""
    return F.array_distinct(words(F.lower(c)))


def token_f1(expected: Column, predicted: Column) -> Column:
    """1 for equal answers (trimmed, any case), else F1 of their token sets; 0 without a shared token."""
    a, b = answer_tokens(expected), answer_tokens(predicted)
    both = F.size(F.array_intersect(a, b)).cast("double")
    f1 = F.coalesce(F.try_divide(2 * both, F.size(a) + F.size(b)), F.lit(0.0))
    return F.when(strip(F.lower(expected)) == strip(F.lower(predicted)), 1.0).otherwise(f1)


def hallucinated(question: Column, expected: Column, predicted: Column, share: float = 0.3) -> Column:
    """Whether more than `share` of the distinct predicted tokens are in neither question nor expected answer."""
    p = answer_tokens(predicted)
    new = F.array_except(p, F.array_union(answer_tokens(question), answer_tokens(expected)))
    return F.when(F.size(p) > 0, F.size(new) / F.size(p) > share).otherwise(False)


def length_consistency(n: Column) -> Column:
    """An aggregate: one minus the population deviation over the mean of lengths, at least 0."""
    return F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide(F.stddev_pop(n), F.avg(n)), F.lit(0.0)))


# Words without weight in the overlap of instruction and response.
STOPWORDS = ("the", "a", "an", "is", "was", "are", "were", "of", "to", "in", "for", "on", "and", "or", "it", "its", "be", "has", "have", "had", "do", "does", "did", "what", "who", "where", "when", "why", "how", "?")


def relevancy(instruction: Column, response: Column) -> Column:
    """Share of the instruction's keywords in the response; 0.5 without keywords."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    i = F.array_except(words(F.lower(instruction)), stop)
    return F.when(F.size(i) > 0, F.size(F.array_intersect(i, words(F.lower(response)))) / F.size(i)).otherwise(0.5)


def faithful(context: Column, response: Column) -> Column:
    """Whether every capitalised word of the response occurs in the context."""
    named = F.filter(words(response), lambda w: (F.length(w) > 1) & w.rlike(r"^\p{Lu}"))
    return F.forall(named, lambda w: F.contains(F.lower(context), F.lower(w)))


def factual(subject: Column, object_: Column, response: Column) -> Column:
    """Half a point for each end of a triple that the response contains."""
    hit = lambda c: F.when((c != "") & F.contains(F.lower(response), F.lower(c)), 0.5).otherwise(0.0)
    return hit(subject) + hit(object_)


def bigrams(texts: DataFrame, text: str) -> DataFrame:
    """(bigram, n): pairs of neighbouring lower-case words over all texts."""
    w = texts.select(words(F.lower(F.col(text))).alias("w")).where("size(w) > 1")
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws("_", a, b))
    return w.select(F.explode(pairs).alias("bigram")).groupBy("bigram").agg(F.count("*").alias("n"))


def duplication_audit(entities: int, pairs: DataFrame) -> DataFrame:
    """One row (pairs, entities_in_pairs, health_score, flag) of similar names; pairs(a, b), entities counted before."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).agg(F.countDistinct("id").alias("entities_in_pairs"))
    r = pairs.agg(F.count("*").alias("pairs")).join(F.broadcast(ends)).withColumn("n", F.lit(max(entities, 1)))
    return r.select("pairs", "entities_in_pairs", F.round(F.greatest(F.lit(0.0), 100 - 500 * F.col("pairs") / F.col("n")), 1).alias("health_score"), F.when(F.col("pairs") > F.col("n") * 0.1, "red").when(F.col("pairs") > 0, "yellow").otherwise("green").alias("flag"))


def overall_health(*audits: DataFrame) -> DataFrame:
    """One row (overall_health_score, verdict): the mean of the health scores of one-row audits, and its word."""
    scores = audits[0].select(F.col("health_score").cast("double").alias("h"))
    for a in audits[1:]:
        scores = scores.unionByName(a.select(F.col("health_score").cast("double").alias("h")))
    return scores.agg(F.round(F.avg("h"), 1).alias("overall_health_score")).withColumn("verdict", verdict(F.col("overall_health_score")))


def database_audit(nodes: DataFrame, edges: DataFrame, threshold: float = 0.85, patterns: int = 100, starts: int = 50) -> DataFrame:
    """One row of the stored graph's audit variant: compliance, duplicates and undirected reach.

    nodes(id, name, type), edges(subject, object, predicate). Of the `patterns` most frequent (type,
    predicate, type) patterns those with a DATE as subject of a person, body or place are violations.
    Duplicates are of one type, one name inside the other, with similar 3-grams (candidates share a 3-gram
    of the shorter name's start). Reach is counted undirected from the `starts` first nodes in hash order.
    """
    t = nodes.select("id", "type")
    p = edges.where("upper(predicate) <> 'MENTIONS'").join(t.select(F.col("id").alias("subject"), F.col("type").alias("st")), "subject").join(t.select(F.col("id").alias("object"), F.col("type").alias("ot")), "object")
    p = p.groupBy("st", "predicate", "ot").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "st", "predicate", "ot").limit(patterns)
    odd = (F.col("st") == "DATE") & F.col("ot").isin("PERSON", "ORG", "GPE")
    comply = p.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.sum(F.when(odd, F.col("n"))), F.lit(0)).alias("violations"))
    comply = comply.select("violations", F.round(F.coalesce(F.try_divide(F.col("all") - F.col("violations"), F.col("all")), F.lit(0.0)), 4).alias("compliance_rate"))
    named = nodes.where("name is not null and type is not null").select("id", "type", F.lower("name").alias("n"))
    g = named.select("id", "type", "n", F.array_distinct(char_ngrams(F.col("n"), 3)).alias("g"))
    # a name inside another one has its first 3-gram there: an equi-join, then containment
    inner, outer = g.select(F.col("id").alias("a"), "type", F.col("n").alias("x"), F.col("g").alias("ga"), F.substring("n", 1, 3).alias("k")), g.select(F.col("id").alias("b"), "type", F.col("n").alias("y"), F.col("g").alias("gb"), F.explode("g").alias("k"))
    both = F.size(F.array_intersect("ga", "gb"))
    dup = inner.join(outer, ["type", "k"]).where(F.contains("y", F.col("x")) & (F.col("a") != F.col("b")) & (F.col("x") != F.col("y")) & (both / (F.size("ga") + F.size("gb") - both) >= threshold)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    n = nodes.agg(F.count("*").alias("n"))
    und = edges.select("subject", "object").union(edges.select("object", "subject")).distinct()
    first = nodes.select("id").distinct().orderBy(F.sha2("id", 256), "id").limit(starts)
    seen = reachable(nodes, und, first, 3).where("start <> id").groupBy("start", "id").agg(F.min("depth").alias("d"))
    reach = seen.agg(F.count(F.when(F.col("d") <= 2, 1)).alias("r2"), F.count("*").alias("r3"))
    out = comply.join(F.broadcast(dup.agg(F.count("*").alias("duplicate_pairs")))).join(F.broadcast(n)).join(F.broadcast(reach)).join(F.broadcast(first.agg(F.count("*").alias("k"))))
    share = lambda c: F.round(F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("k") * (F.col("n") - 1)), F.lit(0.0)), 4)
    return out.select("violations", "compliance_rate", "duplicate_pairs", share("r2").alias("reachable_2hop"), share("r3").alias("reachable_3hop"))


def sft_overall(pairs: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """One row (faithfulness, answer_relevancy, factual_correctness, semantic_diversity, overall_score) of pairs(id, instruction, response, context).

    facts(id, subject, object) are the triples behind a pair: half a point for each end in the response,
    the mean over a pair's triples, 0.5 without any; diversity is distinct over all bigrams of instructions.
    """
    if facts is None:
        scored = pairs.withColumn("fact", F.lit(0.5))
    else:
        f = facts.join(pairs.select("id", "response"), "id").groupBy("id").agg(F.avg(factual(F.col("subject"), F.col("object"), F.col("response"))).alias("fact"))
        scored = pairs.join(f, "id", "left").withColumn("fact", F.coalesce("fact", F.lit(0.5)))
    r = scored.agg(F.avg(faithful(F.col("context"), F.col("response")).cast("double")).alias("x"), F.avg(relevancy(F.col("instruction"), F.col("response"))).alias("y"), F.avg("fact").alias("z"))
    b = bigrams(pairs, "instruction").agg(F.coalesce(F.count("*") / F.sum("n"), F.lit(0.0)).alias("d"))
    r = r.join(F.broadcast(b)).select(*[F.round(F.coalesce(c, F.lit(0.0)), 3).alias(n) for c, n in (("x", "faithfulness"), ("y", "answer_relevancy"), ("z", "factual_correctness"), ("d", "semantic_diversity"))])
    mean = (F.col("faithfulness") + F.col("answer_relevancy") + F.col("factual_correctness") + F.col("semantic_diversity")) / 4
    return r.withColumn("overall_score", F.round(mean, 3))


def rank_models(scores: DataFrame) -> DataFrame:
    """(metric, model, value, place): models ranked by each metric of scores(model, metric, value); low is good for hallucination_rate only."""
    signed = F.when(F.col("metric") == "hallucination_rate", F.col("value")).otherwise(-F.col("value"))
    return scores.select("metric", "model", "value", F.rank().over(Window.partitionBy("metric").orderBy(signed)).alias("place"))


def counted(stage: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows and an observation of their number, filled by whatever action reads them: a counter without a job of its own."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
