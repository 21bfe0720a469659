"""Manifest, quality report, rendered bars and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.exact import exact_sum, round1
from ..functions.text import bar
from .ordinal import numbered
from .verify import STATUSES


def manifest(results: DataFrame, run_date: str, speakers: int = 2, rate: int = 16000) -> DataFrame:
    """One row a success: results has (conversation_id, success, duration, pii_count, status)."""
    return results.filter("success").select("conversation_id", F.col("duration").alias("duration_sec"), F.lit(speakers).alias("num_speakers"), F.lit(rate).alias("sample_rate"), (F.col("pii_count") > 0).alias("has_pii"), "pii_count", F.lit(f"{run_date}_v1").alias("deid_version"), F.coalesce("status", F.lit("pending")).alias("qa_status"))


def summary(results: DataFrame) -> DataFrame:
    ok = F.col("success")
    seconds = F.coalesce(exact_sum(F.when(ok, F.coalesce("duration", F.lit(0.0)))), F.lit(0.0))
    sums = results.agg(F.count("*").alias("total_conversations"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), seconds.alias("_s"), F.coalesce(F.sum(F.when(ok, F.col("pii_count"))), F.lit(0)).alias("total_pii_redacted"))
    return sums.select("total_conversations", "successful", "failed", round1(F.col("_s")).alias("total_duration_sec"), round1(F.col("_s") / 60).alias("total_duration_min"), "total_pii_redacted")


def failures(results: DataFrame) -> DataFrame:
    return results.filter("NOT success").select("conversation_id", "stage", "error")


def qa_report(results: DataFrame, timestamp: str) -> DataFrame:
    """One row, shaped as the report file: a list of failures and a map of times are part of it, so it is meant for
    batches whose report a reader can open; summary(), failures() and verify.status_counts() scale to any number."""
    counts = F.map_from_arrays(F.array(*map(F.lit, STATUSES)), F.array(*(F.count_if(F.col("success") & (F.col("status") == s)) for s in STATUSES)))
    results = results.withColumn("processing_time_s", F.max("processing_time_s").over(W.partitionBy("conversation_id")))
    times = F.map_from_entries(F.collect_set(F.struct("conversation_id", "processing_time_s")))  # an id that repeats has its longest time
    lists = results.agg(counts.alias("verification_status"), F.filter(F.collect_list(F.when(~F.col("success"), F.struct("conversation_id", "stage", "error"))), lambda x: x.isNotNull()).alias("failures"), times.alias("processing_times"))
    return summary(results).select(F.lit(timestamp).alias("timestamp"), F.struct("*").alias("summary")).crossJoin(F.broadcast(lists))  # one row each


def times(results: DataFrame) -> DataFrame:
    total = exact_sum(F.col("processing_time_s"))
    return results.agg(total.alias("total"), (total / F.count("processing_time_s")).alias("average"), F.max("processing_time_s").alias("longest"))


def category_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("category").agg(F.count("*").alias("n"))


def conversation_counts(matches: DataFrame) -> DataFrame:
    """(id, n_exact, n_fuzzy) of each conversation with matches."""
    return matches.groupBy("id").agg(F.count_if(~F.col("is_fuzzy")).alias("n_exact"), F.count_if("is_fuzzy").alias("n_fuzzy"))


def bars(counts: DataFrame, label: str, value: str, width: int = 50) -> DataFrame:
    """(label, value, bar), longest bar `width` blocks; order by value descending, then label, as ranked_bars() does."""
    most = counts.agg(F.max(value).alias("_most"))
    return counts.crossJoin(F.broadcast(most)).select(F.col(label).alias("label"), F.col(value).alias("value"), bar(F.col(value), F.col("_most"), width).alias("bar"))


def ranked_bars(counts: DataFrame, label: str, value: str, width: int = 50) -> DataFrame:
    """bars() with place (1, 2, ...), largest first, then by label."""
    drawn = bars(counts, label, value, width).withColumn("_by", -F.col("value"))
    return numbered(drawn, ["_by", "label"], ordinal="place").drop("_by", "total")


def compared(before: DataFrame, after: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    """(key, before, after, delta) over the keys of both; a missing value is 0."""
    j = before.select(key, F.col(value).alias("before")).join(after.select(key, F.col(value).alias("after")), key, "full").na.fill(0, ["before", "after"])
    return j.withColumn("delta", F.col("after") - F.col("before"))


def counts_compared(rows: DataFrame, key: str, first: Column, name: str = "metric") -> DataFrame:
    """compared() of how many rows of each key are first and how many are not, in one pass."""
    n = rows.groupBy(F.col(key).alias(name)).agg(F.count_if(first).alias("before"), F.count_if(~first).alias("after"))
    return n.withColumn("delta", F.col("after") - F.col("before"))


def rendered(rows: list, title: str) -> str:
    """The text of a chart from collected rows of bars(); "(no data)" for none."""
    if not rows:
        return f"{title}\n(no data)"
    wide = max(len(str(r["label"])) for r in rows)
    return "\n".join([title, "-" * len(title), *(f"{r['label']!s:<{wide}} | {r['bar']} {r['value']}" for r in rows)])


def first_redactions(transcripts: DataFrame, most: int = 10) -> DataFrame:
    """id, the first redactions, how many more there are, and both texts' first 200 characters."""
    return transcripts.select("id", F.slice("redactions", 1, most).alias("shown"), F.greatest(F.size("redactions") - most, F.lit(0)).alias("more"), F.substring("original_text", 1, 200).alias("original"), F.substring("redacted_text", 1, 200).alias("redacted"))


def first_spans(talks: DataFrame, most: int = 10) -> DataFrame:
    """(id, shown array<string>, more): the first matches' texts and how many more there are, of conversations with words and
    spans (see detect.matches_of)."""
    text = lambda m: F.array_join(F.slice("words", m["word_idx"] + 1, m["n_words"])["word"], " ")
    return talks.select("id", F.transform(F.slice("spans", 1, most), text).alias("shown"), F.greatest(F.size("spans") - most, F.lit(0)).alias("more"))


def span_counts(talks: DataFrame) -> DataFrame:
    """conversation_counts() of conversations with spans (see detect.spans)."""
    n = lambda test: F.size(F.filter("spans", test)).cast("long")
    return talks.filter(F.size("spans") > 0).select("id", n(lambda m: ~m["is_fuzzy"]).alias("n_exact"), n(lambda m: m["is_fuzzy"]).alias("n_fuzzy"))
