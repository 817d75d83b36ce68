"""Mixing sources to target weights with capped repeats: pivotal dependent rounding.

Every record of a source is wanted the same fractional number of times, at most the source's cap. The
whole part is certain; the rest is a probability, rounded so that the number of copies of a source is
exact but for one record: two fractional probabilities meet, mass moves at random from one to the
other until one of them is 0 or 1, and the other goes on. Records meet in order of size, so the size
taken stays close to the target too. Buckets of records do this alone and each
hands on one residual; residuals meet in further rounds, a reduction tree of fixed fan-in.
"""

from __future__ import annotations

import base64
import random
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The usual split of byte-level BPE vocabularies into words, digits, signs and blanks (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUCKET, FAN_IN = 50_000, 64
_EPS = 1e-9


def _count(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.value.splitlines())}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["id", "source", "tokens"])

    return run


def token_sizes(docs: DataFrame, key: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, source, tokens): tokens of each whole text (0 for a null one), sources trimmed and in lower case.

    Null and blank sources are null; rows keep their number, repeated ids included; a null id is made of
    the text. The vocabulary file, of fixed size, is read by the driver and sent along.
    """
    with open(tokenizer, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null-"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))))
    name = F.nullif(F.lower(F.regexp_replace(F.col(source).cast("string"), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))
    return docs.select(own.alias("id"), name.alias("source"), F.col(text).cast("string").alias("text")).mapInArrow(_count(vocabulary), "id string, source string, tokens long")


def pivotal(units: list[tuple[str, float]], seed: int) -> tuple[dict[str, int], tuple[str, float] | None]:
    """Rounds probabilities by pairs: ({unit: 0 or 1}, what is left of the last one)."""
    done: dict[str, int] = {}
    held: tuple[str, float] | None = None
    for u, p in units:
        if p <= _EPS or p >= 1 - _EPS:
            done[u] = int(p > 0.5)
        elif held is None:
            held = (u, p)
        else:
            v, q = held
            draw = random.Random(xxhash.xxh3_64_intdigest(f"{seed}|{v}|{u}")).random()
            if p + q < 1:  # one of them drops to zero
                lost, kept = ((u, v) if draw < q / (p + q) else (v, u))
                done[lost], held = 0, (kept, p + q)
            else:  # one of them rises to one
                sure, kept = ((u, v) if draw < (1 - q) / (2 - p - q) else (v, u))
                done[sure], held = 1, (kept, p + q - 1)
            if held[1] <= _EPS or held[1] >= 1 - _EPS:
                done[held[0]], held = int(held[1] > 0.5), None
    return done, held


def _round(seed: int):
    def run(table: pa.Table) -> pa.Table:
        rows = [(i, p) for _, i, p in sorted(zip(table.column("tokens").to_pylist(), table.column("id").to_pylist(), table.column("p").to_pylist()))]
        size = dict(zip(table.column("id").to_pylist(), table.column("tokens").to_pylist()))
        source = table.column("source")[0].as_py()
        done, held = pivotal(rows, seed)
        ids = [*done, *([held[0]] if held else [])]
        return pa.table({"id": pa.array(ids, pa.string()), "source": pa.array([source] * len(ids), pa.string()), "tokens": pa.array([size[i] for i in ids], pa.int64()), "p": pa.array([*map(float, done.values()), *([held[1]] if held else [])], pa.float64())})

    return run


def mix(docs: DataFrame, targets: DataFrame, key: str, source: str, text: str, tokenizer: str = TOKENIZER, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(copies, report) of a mix as large as all of docs once.

    copies(id, source, tokens, copies): how often each record of a target source is taken, at most
    max_repeats times. report(source, target_share, max_repeats, records, tokens, wanted, taken,
    actual_share, short): sizes in tokens; short says that even max_repeats times all records stay
    below the target. targets(source, target_share, max_repeats) is a fixed small table; a target
    listed twice counts once (its largest share), null names, shares and caps are left out, as are docs of other sources (their size
    still counts towards the mix). Records are told apart by id: rows with an equal id are one record
    of their summed size, as are rows with null ids and equal texts. Empty tables: no copies, sources of size 0.
    """
    sizes = token_sizes(docs, key, source, text, tokenizer)
    sizes = cut(sizes.groupBy("id", "source").agg(F.sum("tokens").alias("tokens")))
    goal = targets.select(F.nullif(F.lower(F.trim(F.col("source"))), F.lit("")).alias("source"), "target_share", "max_repeats").where("source is not null and target_share is not null and max_repeats is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    have = sizes.groupBy("source").agg(F.count("*").alias("records"), F.sum("tokens").alias("tokens"))
    plan = goal.join(have, "source", "left").na.fill(0, ["records", "tokens"]).withColumn("wanted", F.col("target_share") * F.lit(float(total)))
    plan = cut(plan.withColumn("short", F.col("tokens") * F.col("max_repeats") < F.col("wanted")).withColumn("times", F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("wanted") / F.col("tokens"))).otherwise(0.0)))
    taken = sizes.join(F.broadcast(plan.select("source", "times", "records").where("records > 0")), "source")
    taken = taken.withColumn("whole", F.floor("times").cast("long")).withColumn("p", F.col("times") - F.floor("times"))
    most = plan.agg(F.max("records")).first()[0] or 0
    open_rows = taken.where(f"p > {_EPS}").select("id", "source", "tokens", "p")
    rounds, n = [], most
    buckets = max(1, ceil(most / BUCKET))
    while True:
        done = cut(open_rows.withColumn("b", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(buckets))).groupBy("source", "b").applyInArrow(_round(seed), "id string, source string, tokens long, p double"))
        rounds.append(done.where(f"p <= {_EPS} or p >= {1 - _EPS}").select("id", "source", F.round("p").cast("long").alias("more")))
        open_rows = done.where(f"p > {_EPS} and p < {1 - _EPS}")
        if buckets == 1:
            break
        buckets = ceil(buckets / FAN_IN)
    chance = F.pmod(F.xxhash64("id", F.lit(seed), F.lit("last")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    rounds.append(open_rows.select("id", "source", (chance < F.col("p")).cast("long").alias("more")))
    more = rounds[0]
    for r in rounds[1:]:
        more = more.union(r)
    copies = taken.join(more, ["id", "source"], "left").select("id", "source", "tokens", (F.col("whole") + F.coalesce("more", F.lit(0))).alias("copies"))
    got = copies.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("taken"))
    report = plan.join(got, "source", "left").na.fill(0, ["taken"])
    sum_all = got.agg(F.sum("taken").alias("all"))
    report = report.join(F.broadcast(sum_all)).select("source", "target_share", "max_repeats", "records", "tokens", "wanted", "taken", (F.col("taken") / F.col("all")).alias("actual_share"), "short")
    return copies, report
