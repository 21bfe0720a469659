"""Time regions to be masked: padding, minimum length, and merging of near regions (gaps and islands)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MIN_MS, PAD_BEFORE, PAD_AFTER, GAP = 400.0, 0.150, 0.150, 0.1


def padded(matches: DataFrame, durations: DataFrame, before: float = PAD_BEFORE, after: float = PAD_AFTER, min_ms: float = MIN_MS) -> DataFrame:
    """matches with start_time, end_time widened and held within (id, duration), and bleep_duration."""
    return held(matches.join(durations.select("id", "duration"), "id"), before, after, min_ms)


def held(matches: DataFrame, before: float = PAD_BEFORE, after: float = PAD_AFTER, min_ms: float = MIN_MS) -> DataFrame:
    """padded() of matches that have their conversation's duration beside them."""
    m = matches.withColumns({"start_time": F.greatest(F.lit(0.0), F.col("start_time") - before), "end_time": F.least(F.col("duration"), F.col("end_time") + after)})
    return m.withColumn("bleep_duration", F.greatest(F.lit(min_ms), (F.col("end_time") - F.col("start_time")) * 1000) / 1000).drop("duration")


def merged(regions: DataFrame, gap: float = GAP) -> DataFrame:
    """(id, region, start_time, end_time, bleep_duration, n_matches): regions that start no later than `gap` after
    the end of what stands before them are one. Regions that end before they start are left out."""
    r = regions.filter("end_time >= start_time")
    order = W.partitionBy("id").orderBy("start_time", "end_time")
    r = r.withColumn("_last", F.max("end_time").over(order.rowsBetween(W.unboundedPreceding, -1)))
    r = r.withColumn("region", F.sum(F.when(F.col("start_time") > F.col("_last") + gap, 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    out = r.groupBy("id", "region").agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.count("*").alias("n_matches"))
    return out.withColumn("bleep_duration", F.greatest(F.lit(MIN_MS), (F.col("end_time") - F.col("start_time")) * 1000) / 1000)


def _merged(starts: pa.Array, ends: pa.Array, durations: pa.Array, before: float, after: float, gap: float) -> pa.Array:
    """held() and merged() of each list of times: array<struct<start_time, end_time, n_matches>>, by region."""
    told = lambda a: a.to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(starts)), np.diff(starts.offsets.to_numpy()))
    s, e = np.fmax(0.0, told(starts.flatten()) - before), np.fmin(told(durations)[row], told(ends.flatten()) + after)
    kept = np.flatnonzero(e >= s)
    kept = kept[np.lexsort((e[kept], s[kept], row[kept]))]
    row, s, e = row[kept], s[kept], e[kept]
    values, rank = np.unique(e, return_inverse=True)  # the largest end so far, by its rank, which each row lifts above all before
    last = values[np.maximum.accumulate(rank + row * len(values)) % max(len(values), 1)]
    opens = np.ones(len(row), bool)
    opens[1:] = (row[1:] != row[:-1]) | (s[1:] > last[:-1] + gap)
    first = np.flatnonzero(opens)
    end = np.maximum.reduceat(e, first) if len(first) else e
    columns = [pa.array(s[first]), pa.array(end), pa.array(np.diff(np.append(first, len(row))))]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[first], np.arange(len(starts) + 1)), pa.int32()), pa.StructArray.from_arrays(columns, ["start_time", "end_time", "n_matches"]))


def of_talks(talks: DataFrame, before: float = PAD_BEFORE, after: float = PAD_AFTER, gap: float = GAP) -> DataFrame:
    """bleep_regions() of conversations (id, duration, words array<struct<word, start_time, end_time>>, spans, see
    detect.spans), whose ids are unique: a conversation's regions are merged in its row."""

    def run(starts: pa.Array, ends: pa.Array, durations: pa.Array) -> pa.Array:
        return _merged(starts, ends, durations, before, after, gap)

    starts = F.transform("spans", lambda m: F.get("words", m["word_idx"])["start_time"])
    ends = F.transform("spans", lambda m: F.get("words", m["word_idx"] + m["n_words"] - 1)["end_time"])
    merged_ = F.arrow_udf(run, "array<struct<start_time:double,end_time:double,n_matches:long>>").asNondeterministic()
    r = talks.select("id", F.posexplode(merged_(starts, ends, F.col("duration"))).alias("region", "r"))
    bleep = F.greatest(F.lit(MIN_MS), (F.col("r.end_time") - F.col("r.start_time")) * 1000) / 1000
    return r.select("id", F.col("region").cast("long").alias("region"), "r.start_time", "r.end_time", "r.n_matches", bleep.alias("bleep_duration"))


def with_matches(regions: DataFrame, padded_matches: DataFrame) -> DataFrame:
    """regions with matches: array<struct<start_time, end_time, text, category>> of the padded matches inside, in order
    of time. A merged region spans every match it was made of, and no other begins within it."""
    m = padded_matches.filter("end_time >= start_time").select("id", F.struct("start_time", "end_time", "text", "category").alias("m"))
    inside = (F.col("m.start_time") >= F.col("start_time")) & (F.col("m.start_time") <= F.col("end_time"))
    per = regions.select("id", "region", "start_time", "end_time").join(m, "id").filter(inside).groupBy("id", "region").agg(F.array_sort(F.collect_list("m")).alias("matches"))
    return regions.join(per, ["id", "region"], "left")


def bleep_regions(matches: DataFrame, durations: DataFrame, **how) -> DataFrame:
    return merged(padded(matches, durations, **how))


def samples(regions: DataFrame, rate: int = 16000) -> DataFrame:
    """regions with first_sample, end_sample (truncated)."""
    return regions.withColumns({"first_sample": (F.col("start_time") * rate).cast("long"), "end_sample": (F.col("end_time") * rate).cast("long")})
