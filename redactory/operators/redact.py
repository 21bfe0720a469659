"""Redaction of words and the log of replacements."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import LABELS
from ..functions.text import full_text, label_of
from .detect import covered, spans


def redact_words(words: DataFrame, matches: DataFrame) -> DataFrame:
    """words with redacted: the label at a match's first word, null at its others, else the word."""
    hit = covered(matches)
    out = words.join(hit, ["id", "idx"], "left")
    return out.withColumn("redacted", F.when(F.col("word_idx").isNull(), F.col("word")).when(F.col("idx") == F.col("word_idx"), label_of(F.col("category")))).drop("word_idx", "category")


def redact_text(words: DataFrame, matches: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """(id, original_text, redacted_text, segments array<struct<seg, text>>). Segments of no words, given in
    segments (id, seg), stay as empty texts."""
    in_order = lambda c: F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("idx", c))), lambda x: x[c]), lambda x: x.isNotNull()), " ")
    per = redact_words(words, matches).groupBy("id", "seg").agg(in_order("word").alias("original"), in_order("redacted").alias("text"))
    if segments is not None:
        per = segments.select("id", "seg").distinct().join(per, ["id", "seg"], "left").na.fill("", ["original", "text"])
    joined = lambda n: F.array_join(F.transform("s", lambda x: x[n]), " ")
    per = per.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("seg", "text", "original"))).alias("s"))
    return per.select("id", joined("original").alias("original_text"), joined("text").alias("redacted_text"), F.transform("s", lambda x: F.struct(x["seg"].alias("seg"), x["text"].alias("text"))).alias("segments"))


def masked(talks: pa.Array, spans: pa.Array) -> pa.Array:
    """The text of each segment: of talks (lists of segments, which are lists of words), each span's first word replaced by
    its label and its others left out."""
    segs, of_talk = talks.flatten(), talks.offsets.to_numpy().astype(np.int64)
    of_talk = of_talk - of_talk[0]
    words, of_seg = segs.flatten(), segs.offsets.to_numpy().astype(np.int64)
    of_seg = of_seg - of_seg[0]
    found = spans.flatten()
    first = np.repeat(of_seg[of_talk[:-1]], np.diff(spans.offsets.to_numpy()))
    at, n = first + found.field("word_idx").to_numpy(), found.field("n_words").to_numpy().astype(np.int64)
    kinds = found.field("category").dictionary_encode()
    labels = pa.array([LABELS.get(c, f"[{c.upper()}]") for c in kinds.dictionary.to_pylist()], pa.string()).take(kinds.indices)
    head, keep = np.zeros(len(words), bool), words.is_valid().to_numpy(zero_copy_only=False).copy()
    head[at] = True
    keep[np.repeat(at, n - 1) + 1 + np.arange((n - 1).sum()) - np.repeat(np.cumsum(n - 1) - (n - 1), n - 1)] = False
    told = pc.replace_with_mask(words, pa.array(head), labels).filter(pa.array(keep))
    ends = np.concatenate([[0], np.cumsum(keep)])[of_seg]
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), told), " ")
    return pa.ListArray.from_arrays(pa.array(of_talk, pa.int32()), texts)


def masked_segments(said: Column, spans: Column) -> Column:
    """array<string>, a text a segment, of said (array<array<string>>: each segment's words; no nulls but words) with the
    spans (see detect.spans) masked."""
    return F.arrow_udf(masked, "array<string>").asNondeterministic()(said, spans)


def in_place(rows: DataFrame, fit: Column, found: DataFrame | None = None, may_context: bool = False, include_original: bool = True) -> DataFrame:
    """rows (id, segments array<struct<words array<struct<word, start, end>>>>, ...), whose ids are unique, with words,
    spans (see detect), original_text, redacted_text, masked array<struct<seg, text>>, redactions (by word; null for none) and
    pii_count. found are the matches where they are known; else they are looked for. Rows that are not fit have no texts."""
    none = lambda t: F.expr(f"cast(array() AS {t})")
    ws = F.transform("segments", lambda s: F.coalesce(F.transform(s["words"], lambda w: F.struct(w["word"].alias("word"), w["start"].alias("start_time"), w["end"].alias("end_time"))), none("array<struct<word:string,start_time:double,end_time:double>>")))
    rows = rows.withColumn("_ws", F.when(fit, ws).otherwise(none("array<array<struct<word:string,start_time:double,end_time:double>>>")))
    rows = rows.withColumns({"words": F.flatten("_ws"), "_said": F.transform("_ws", lambda x: x["word"])}).drop("_ws")
    if found is None:
        rows = rows.withColumn("spans", spans(F.col("words")["word"], may_context))
    else:
        per = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("word_idx", "n_words", "category", "confidence", "is_fuzzy"))).alias("spans"))
        rows = rows.join(per, "id", "left").withColumn("spans", F.coalesce("spans", none("array<struct<word_idx:int,n_words:int,category:string,confidence:double,is_fuzzy:boolean>>")))
    rows = rows.withColumn("_masked", masked_segments(F.col("_said"), F.col("spans")))
    original = lambda m: F.array_join(F.slice("words", m["word_idx"] + 1, m["n_words"])["word"], " ") if include_original else F.lit(None).cast("string")
    entry = lambda m: F.struct(m["word_idx"].alias("word_idx"), original(m).alias("original"), label_of(m["category"]).alias("replacement"), m["category"].alias("category"), F.get("words", m["word_idx"])["start_time"].alias("start_time"), F.get("words", m["word_idx"] + m["n_words"] - 1)["end_time"].alias("end_time"), m["confidence"].alias("confidence"), m["is_fuzzy"].alias("is_fuzzy"))
    spoken = F.array_join(F.transform("_said", lambda x: F.array_join(x, " ")), " ")
    return rows.withColumns({
        "original_text": F.when(fit, spoken), "redacted_text": F.when(fit, F.array_join("_masked", " ")),
        "masked": F.when(F.size("segments") > 0, F.transform("_masked", lambda t, k: F.struct(k.alias("seg"), t.alias("text")))),
        "redactions": F.when(F.size("spans") > 0, F.transform("spans", entry)), "pii_count": F.size("spans"),
    }).drop("_said", "_masked")


def deidentified(words: DataFrame, matches: DataFrame, transcripts: DataFrame, include_original: bool = True) -> DataFrame:
    """(conversation_id, original_text, redacted_text, segments, redactions, pii_count) of transcripts (id, segments).
    A segment has its text, start and end, and its words (word, start, end); a match is one word there, its label, from
    the match's start to its end, in the segment where it begins. original_text is the spoken segments' texts, stripped;
    with include_original=False it and the redactions' originals are null."""
    hit = covered(matches).join(matches.select("id", "word_idx", F.col("start_time").alias("_from"), F.col("end_time").alias("_to")), ["id", "word_idx"])
    first = F.col("idx") == F.col("word_idx")
    kept = words.join(hit, ["id", "idx"], "left").filter(F.col("word_idx").isNull() | first)
    told = F.when(first, label_of(F.col("category"))).otherwise(F.col("word"))
    word = F.struct(F.col("idx").cast("int").alias("idx"), told.alias("word"), F.coalesce("_from", "start_time").alias("start"), F.coalesce("_to", "end_time").alias("end"))
    per = kept.groupBy("id", "seg").agg(F.array_sort(F.collect_list(word)).alias("w"))
    per = per.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("seg", "w"))).alias("by_seg"))
    spoken = lambda w: F.array_join(F.transform(w, lambda x: x["word"]), " ")
    ws = lambda k: F.coalesce(F.try_element_at("by_seg", k), F.expr("cast(array() AS array<struct<idx:int,word:string,start:double,end:double>>)"))
    segment = lambda s, k: F.struct(spoken(ws(k)).alias("text"), s["start"].alias("start"), s["end"].alias("end"), F.transform(ws(k), lambda x: F.struct(x["word"].alias("word"), x["start"].alias("start"), x["end"].alias("end"))).alias("words"))
    out = transcripts.select("id", "segments").join(per, "id", "left")
    out = out.select("id", full_text(F.col("segments")).alias("original_text"), F.transform("segments", segment).alias("segments"))
    out = out.withColumn("redacted_text", F.array_join(F.transform("segments", lambda s: s["text"]), " "))
    out = with_log(out, redaction_log(matches, include_original))
    redactions = F.transform(F.coalesce("redactions", F.expr("cast(array() AS array<struct<word_idx:int,original:string,replacement:string,category:string,start_time:double,end_time:double,confidence:double,is_fuzzy:boolean>>)")), lambda r: r.dropFields("word_idx"))
    original = F.col("original_text") if include_original else F.lit(None).cast("string")
    return out.select(F.col("id").alias("conversation_id"), original.alias("original_text"), "redacted_text", "segments", redactions.alias("redactions"), F.size(redactions).alias("pii_count"))


def redaction_log(matches: DataFrame, include_original: bool = True) -> DataFrame:
    """One row a match: (id, word_idx, original, replacement, category, start_time, end_time, confidence, is_fuzzy)."""
    original = F.col("text") if include_original else F.lit(None).cast("string")
    return matches.select("id", "word_idx", original.alias("original"), label_of(F.col("category")).alias("replacement"), "category", "start_time", "end_time", "confidence", "is_fuzzy")


def with_log(redacted: DataFrame, log: DataFrame) -> DataFrame:
    """redact_text() with redactions (by word) and pii_count."""
    logs = log.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("word_idx", "original", "replacement", "category", "start_time", "end_time", "confidence", "is_fuzzy"))).alias("redactions"))
    out = redacted.join(logs, "id", "left")
    return out.withColumn("pii_count", F.coalesce(F.size("redactions"), F.lit(0)))
