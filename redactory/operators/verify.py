"""Verification of redacted transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.phrases import terms_in
from .detect import MIN_CONFIDENCE, detect, detect_in_text

STATUSES = ["PASS", "PASS_WITH_NOTE", "REVIEW_REQUIRED", "FAIL"]
REVIEW = 2


def status(count: Column, sure: Column) -> Column:
    """Of a number of findings and how many of them are of high confidence."""
    return F.when(count == 0, STATUSES[0]).when((count <= REVIEW) & (sure == 0), STATUSES[1]).when(count <= REVIEW, STATUSES[2]).otherwise(STATUSES[3])


def note(count: Column, sure: Column, source: str) -> Column:
    """The note that goes with a status; null for PASS."""
    say = lambda tail: F.concat(F.lit(f"{source.capitalize()}: "), count.cast("string"), F.lit(tail))
    return (F.when(count == 0, F.lit(None).cast("string")).when((count <= REVIEW) & (sure == 0), say(" low-confidence match(es), likely ASR noise or false positive"))
            .when(count <= REVIEW, say(" PII match(es) found, manual review recommended")).otherwise(say(" PII instances leaked - check bleep alignment")))


def severity(s: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STATUSES)), s) - 1


def overall(text: Column, audio: Column) -> Column:
    """The worse of both; a null audio status does not count."""
    return F.when(severity(audio) > severity(text), audio).otherwise(text)


def _judged(ids: DataFrame, found: DataFrame, source: str) -> DataFrame:
    n = found.groupBy("id").agg(F.count("*").alias("n"), F.count_if(F.coalesce("confidence", F.lit(1.0)) >= MIN_CONFIDENCE).alias("sure"))
    out = ids.select("id").join(n, "id", "left").na.fill(0, ["n", "sure"])
    return out.select("id", status(F.col("n"), F.col("sure")).alias(f"{source}_status"), F.col("n").alias(f"{source}_found"), note(F.col("n"), F.col("sure"), source).alias(f"{source}_note"))


def with_text_status(redacted: DataFrame) -> DataFrame:
    """redacted (redacted_text and others) with text_status, text_found, text_note. Every finding of text mode is a sure one;
    labels are no findings. A text_found that is there already is kept."""
    leaked = lambda x: ~x["text"].startswith("[") & ~x["text"].endswith("]")
    out = redacted if "text_found" in redacted.columns else redacted.withColumn("text_found", F.size(F.filter(terms_in(F.col("redacted_text")), leaked)).cast("long"))
    n = F.col("text_found")
    return out.withColumns({"text_status": status(n, n), "text_note": note(n, n, "text")})


def verify_text(redacted: DataFrame) -> DataFrame:
    """(id, text_status, text_found, text_note) of (id, redacted_text), or of (id, text_found)."""
    return with_text_status(redacted.select("id", "text_found" if "text_found" in redacted.columns else "redacted_text")).select("id", "text_status", "text_found", "text_note")


def verify_audio(ids: DataFrame, words_again: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """(id, audio_status, audio_found, audio_note) from the words of a second transcription of the masked audio;
    conversations in failures (id, error) are to be reviewed."""
    out = _judged(ids, detect(words_again), "audio")
    if failures is None:
        return out
    out = out.join(failures.select("id", "error"), "id", "left")
    bad = F.col("error").isNotNull()
    return out.select("id", F.when(bad, STATUSES[2]).otherwise(F.col("audio_status")).alias("audio_status"), F.when(bad, 0).otherwise(F.col("audio_found")).alias("audio_found"), F.when(bad, F.concat(F.lit("Audio verification failed: "), "error")).otherwise(F.col("audio_note")).alias("audio_note"))


def verify(redacted: DataFrame, words_again: DataFrame | None = None, failures: DataFrame | None = None) -> DataFrame:
    """Text and, where a second transcription is given, audio: (id, text_status, audio_status, overall_status, notes)."""
    out = verify_text(redacted)
    if words_again is None:
        out = out.withColumns({"audio_status": F.lit(None).cast("string"), "audio_note": F.lit(None).cast("string"), "audio_found": F.lit(0)})
    else:
        out = out.join(verify_audio(redacted, words_again, failures), "id")
    return out.withColumns({"overall_status": overall(F.col("text_status"), F.col("audio_status")), "notes": F.filter(F.array("text_note", "audio_note"), lambda x: x.isNotNull())})


def findings(redacted: DataFrame, words_again: DataFrame | None = None) -> DataFrame:
    """(id, text_pii_found, audio_pii_found): what verify() counts, each finding with its text, category, confidence,
    is_fuzzy and times, in order; nulls stand for what a source does not know, and empty lists for no findings."""
    kind = "array<struct<start_time:double,end_time:double,text:string,category:string,confidence:double,is_fuzzy:boolean,start:int,end:int>>"
    none = lambda t: F.lit(None).cast(t)
    texts = detect_in_text(redacted.select("id", F.col("redacted_text").alias("text"))).filter(~F.col("text").startswith("[") & ~F.col("text").endswith("]"))
    parts = [("text", texts.select("id", none("double").alias("start_time"), none("double").alias("end_time"), "text", "category", none("double").alias("confidence"), none("boolean").alias("is_fuzzy"), "start", "end"))]
    if words_again is not None:
        parts.append(("audio", detect(words_again).select("id", "start_time", "end_time", "text", "category", "confidence", "is_fuzzy", none("int").alias("start"), none("int").alias("end"))))
    out = redacted.select("id")
    for source, found in parts:
        first = F.array_sort(F.collect_list(F.struct("start", *(c for c in found.columns if c not in ("id", "start")))))
        per = found.groupBy("id").agg(first.alias("_f"))
        fields = F.transform("_f", lambda x: F.struct(*(x[c].alias(c) for c in ("start_time", "end_time", "text", "category", "confidence", "is_fuzzy", "start", "end"))))
        out = out.join(per, "id", "left").withColumn(f"{source}_pii_found", F.coalesce(fields, F.expr(f"cast(array() AS {kind})"))).drop("_f")
    return out if words_again is not None else out.withColumn("audio_pii_found", F.expr(f"cast(array() AS {kind})"))


def status_counts(results: DataFrame, col: str = "overall_status") -> DataFrame:
    """(status, n) for all four statuses, zero where none."""
    all_ = results.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    n = results.groupBy(F.col(col).alias("status")).agg(F.count("*").alias("n"))
    return all_.join(n, "status", "left").na.fill(0, ["n"])
