"""Mixing sources to target weights by temperature.

A source's share of tokens p is raised to an exponent a and normalised: w ~ p^a. a = 1 keeps the natural mix, a = 0
makes all sources equal, a > 1 favours large sources; the entropy of the weights falls as a grows. Bisection finds the a
whose weights meet a target entropy: by default the one that lies `toward` of the way from the natural mix's entropy to that
of equal weights, so that there is something to do unless sources are equal already; or an absolute one, as a fraction of
the greatest. Where sources would then repeat more than `most_repeats` times, a is brought back toward 1, by bisection too,
until none does; `limit` tells what set the exponent, "entropy" or "repeats". The weights are realised as budgeted block
permutations: each source's rows are dealt to blocks of about block_tokens by hash, blocks are permuted anew for each
pass over the source, and rows are taken in that order until the source's token budget is met. All passes but the last
are whole.

Budgets are set so that the source that is cut most is still used whole (`budget` = "cover": no row is lost, others
repeat) or so that the mix has as many tokens as the input (`budget` = "same": over-represented sources lose rows).

No window is over the rows or blocks of a source: rows are ordered within blocks, blocks within one of 256 ranges of
their hashes, and ranges by a table of 256 rows a source.

Cases: null sources are a source of their own; null and blank texts count one token, so that every row can be
placed; rows with a null id are dealt to blocks each by itself; ties in the permutation go by id, and rows that repeat an id are
rows of their own; texts of any length are counted whole; an empty table gives no rows; one source alone keeps its rows
once. Columns besides the three stated ones are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._common import kept, words_of

NULL_SOURCE = "\0null"


MOST_EXPONENT = 64.0


def spread(weights: dict[str, float]) -> float:
    """The entropy of weights as a fraction of the greatest that so many sources can have."""
    return 1.0 if len(weights) == 1 else -math.fsum(x * math.log(x) for x in weights.values() if x > 0) / math.log(len(weights))


def tempered(tokens: dict[str, int], a: float) -> dict[str, float]:
    """The weights of exponent a."""
    most = max(tokens.values())
    raw = {s: (n / most) ** a for s, n in tokens.items()}
    whole = math.fsum(raw.values())
    return {s: x / whole for s, x in raw.items()}


def bisected(low: float, high: float, ok) -> float:
    """The end of what is ok, which holds at low and up to some place."""
    if ok(high):
        return high
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if ok(mid) else (low, mid)
    return low


def tempering(tokens: dict[str, int], toward: float = 0.5, entropy: float | None = None, most_repeats: float = 4.0, budget: str = "cover") -> tuple[float, dict[str, float], float, str]:
    """(exponent, weight of each source, tokens of the mix, what set the exponent) from the tokens of each source."""
    if not tokens:
        return 1.0, {}, 0.0, "entropy"
    total, natural = sum(tokens.values()), spread(tempered(tokens, 1.0))
    target = natural + toward * (1 - natural) if entropy is None else entropy

    def size(w: dict[str, float]) -> float:
        return max(n / w[s] for s, n in tokens.items()) if budget == "cover" else float(total)

    def repeats(a: float) -> float:
        w = tempered(tokens, a)
        return max(size(w) * w[s] / n for s, n in tokens.items())

    if min(tokens.values()) == max(tokens.values()):
        a = 1.0  # any exponent gives equal weights
    else:
        a = bisected(0.0, MOST_EXPONENT, lambda x: spread(tempered(tokens, x)) >= target)
    limit = "entropy"
    if repeats(a) > most_repeats + 1e-9:
        a, limit = 1 + bisected(0.0, 1.0, lambda x: repeats(1 + x * (a - 1)) <= most_repeats + 1e-9) * (a - 1), "repeats"
    w = tempered(tokens, a)
    return a, w, size(w), limit


def weights(tokens: dict[str, int], **how) -> tuple[float, dict[str, float], float]:
    """tempering() without its last part."""
    return tempering(tokens, **how)[:3]


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", toward: float = 0.5, entropy: float | None = None, most_repeats: float = 4.0,
            budget: str = "cover", block_tokens: int = 1 << 20, seed: int = 7, most_sources: int = 100_000) -> DataFrame:
    """id, source, n_tokens, pass, block, place, weight, exponent, limit: one row for each time a row of docs is used.

    pass counts from 0; place orders a pass within its block. Whole passes keep each row; in the last one the rows
    are those whose first token lies within the source's remaining budget. Sources are weighed on the driver and
    may be most_sources at most; with more of them the operator stops rather than drop any."""
    text = words_of(F.col(text_col))
    own = F.when(F.col(id_col).isNotNull(), F.concat(F.lit("="), F.col(id_col).cast("string"))).otherwise(F.monotonically_increasing_id().cast("string"))
    lot = F.xxhash64(F.lit(seed), own)  # the number of a row without an id holds, since rows are written before they are used
    rows = kept(docs.select(F.col(id_col).alias("id"), lot.alias("lot"), F.coalesce(F.col(source_col).cast("string"), F.lit(NULL_SOURCE)).alias("source"), F.greatest(F.size(text), F.lit(1)).cast("long").alias("n_tokens")))
    sums = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).limit(most_sources + 1).collect()
    if len(sums) > most_sources:
        raise ValueError(f"over {most_sources} sources")
    tokens = {r["source"]: r["tokens"] for r in sums}
    exponent, weight, size, limit = tempering(tokens, toward, entropy, most_repeats, budget)
    plan = [(s, w, max(1, -(-tokens[s] // block_tokens)), int(q := round(size * w) // tokens[s]), round(size * w) - q * tokens[s]) for s, w in weight.items()]
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "source string, weight double, blocks long, whole long, rest long")
    rows = rows.join(F.broadcast(plan), "source").withColumn("block", F.pmod(F.col("lot"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("pass", F.explode(F.expr("sequence(0, int(whole))")))
    last = F.col("pass") == F.col("whole")
    # the last pass: blocks in their order for that pass, each with the tokens before it
    sizes = rows.filter(last & (F.col("rest") > 0)).groupBy("source", "block", "pass", "rest").agg(F.sum("n_tokens").alias("in_block"))
    # blocks stand in the order of their hashes: 256 ranges of those a source, which are counted first, then each by itself
    sizes = kept(sizes.withColumn("turn", F.xxhash64(F.lit(seed), "source", "pass", "block")).withColumn("range", F.shiftright("turn", 56)))
    whole = sizes.groupBy("source", "range").agg(F.sum("in_block").alias("in_range"))
    whole = whole.withColumn("lead", F.sum("in_range").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, 0)) - F.col("in_range"))
    inside = F.sum("in_block").over(W.partitionBy("source", "range").orderBy("turn", "block").rowsBetween(W.unboundedPreceding, 0)) - F.col("in_block")
    ahead = sizes.withColumn("inside", inside).join(whole.select("source", "range", "lead"), ["source", "range"]).withColumn("ahead", F.col("lead") + F.col("inside"))
    ahead = kept(ahead.select("source", "block", "pass", "ahead"))
    own = W.partitionBy("source", "block", "pass").orderBy(F.xxhash64(F.lit(seed), "pass", "lot"), "id", "n_tokens")
    placed = rows.filter(~last | (F.col("rest") > 0)).withColumns({"place": F.row_number().over(own) - 1, "_before": F.sum("n_tokens").over(own.rowsBetween(W.unboundedPreceding, 0)) - F.col("n_tokens")})
    out = placed.join(ahead, ["source", "block", "pass"], "left").filter(~last | (F.col("ahead") + F.col("_before") < F.col("rest")))
    return out.select("id", F.when(F.col("source") != NULL_SOURCE, F.col("source")).alias("source"), "n_tokens", F.col("pass").cast("int").alias("pass"), "block", "place", "weight", F.lit(exponent).alias("exponent"), F.lit(limit).alias("limit"))
