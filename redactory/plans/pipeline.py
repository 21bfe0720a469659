"""The whole chain: transcribe, detect, redact, mask, verify, report; and its command line."""

from __future__ import annotations

import argparse
import importlib
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audio, detect, redact, regions, report, verify
from ..operators.ordinal import numbered
from ..sources import files as io
from ..sources import trees
from ..sources.files import keyed

SAMPLES = "samples/audio"
log = logging.getLogger("redactory")


@dataclass
class Config:
    output: str | None = None
    verify_audio: bool = True
    may_context: bool = False
    include_original: bool = True
    run_date: str = "1970-01-01"
    rate: int = 16000
    audio_format: str = "wav"
    pad_before: float = regions.PAD_BEFORE
    pad_after: float = regions.PAD_AFTER
    min_ms: float = regions.MIN_MS
    frequency: float = 1000
    amplitude: float = 0.5
    device: str = "auto"
    model_name: str | None = None
    profile: object = None


@dataclass
class Result:
    """words, matches and regions have the rows' keys as id; the others have the label as id and the key beside it. told is
    results with redacted_text, which is null for a row that was not searched or whose masking failed."""

    words: DataFrame
    matches: DataFrame
    redacted: DataFrame
    regions: DataFrame
    verification: DataFrame
    results: DataFrame
    told: DataFrame


def by_key(rows: DataFrame) -> DataFrame:
    """rows whose id is their key, which is unique; the label they had as id is left out."""
    return rows.withColumn("id", F.col("key")).drop("key")


def unfit(segments: Column) -> Column:
    """(stage, error) of a transcript that a stage cannot work on, else null: words without a text cannot be searched,
    and masking needs their times."""
    word = lambda test: F.exists(segments, lambda s: F.coalesce(F.exists(s["words"], test), F.lit(False)))
    bad = [("detection", segments.isNull(), "no segments"), ("detection", word(lambda w: w.isNull() | w["word"].isNull()), "a word has no text"),
           ("audio_redaction", word(lambda w: w["start"].isNull() | w["end"].isNull()), "a word has no times")]
    out = F.lit(None).cast("struct<stage:string,error:string>")
    for stage, test, error in reversed(bad):
        out = F.when(test, F.struct(F.lit(stage).alias("stage"), F.lit(error).alias("error"))).otherwise(out)
    return out


def redact_transcripts(transcripts: DataFrame, config: Config | None = None, again: DataFrame | None = None, masked: DataFrame | None = None, found: DataFrame | None = None) -> Result:
    """The chain over transcripts (id, segments, audio_duration, error; key where they come from files; seconds if known).

    Rows are told apart by key (see sources.files.keyed); id is a label that may repeat or be null. Every row ends as one
    row of results: one with an error is a failure of the stage "transcription", one that a stage cannot work on (unfit()) of
    that stage, one whose masking failed (masked: key, error, seconds) of "audio_redaction". again is the second
    transcription (key, segments, error, seconds): a row it has no words of, because it failed or never came to it, is
    to be reviewed. found are the matches, where they are known, with keys as id."""
    config = config or Config()
    rows = keyed(transcripts).withColumn("_unfit", F.when(F.col("error").isNull(), unfit(F.col("segments"))))
    labelled = lambda df: df.withColumnsRenamed({"id": "key", "_label": "id"})
    rows = by_key(rows.withColumn("_label", F.col("id")))
    fit = F.col("error").isNull() & F.col("_unfit").isNull()
    ok = rows.filter(fit).drop("_unfit")
    words = detect.words_of(ok)
    rows = redact.in_place(rows, fit, found, config.may_context, config.include_original)
    ok = rows.filter(fit)
    matches = detect.matches_of(ok) if found is None else found
    texts = ok.select("id", "_label", "original_text", "redacted_text", "masked", "redactions", "pii_count").withColumnRenamed("masked", "segments")
    spans = regions.bleep_regions(matches, ok.select("id", F.col("audio_duration").alias("duration")), before=config.pad_before, after=config.pad_after, min_ms=config.min_ms)
    heard = unheard = None
    if again is not None:
        again = by_key(again)
        heard = detect.words_of(again.filter("error IS NULL"))
        unheard = ok.select("id").join(again.select("id", F.coalesce("error", F.when(F.col("segments").isNull(), F.lit("no transcript"))).alias("error"), F.lit(True).alias("_came")), "id", "left")
        unheard = unheard.select("id", F.when(F.col("_came").isNull(), F.lit("no transcript")).otherwise(F.col("error")).alias("error")).filter("error IS NOT NULL")
    checked = verify.verify(texts.select("id", "redacted_text"), heard, unheard).join(ok.select("id", "_label"), "id")
    if masked is not None:
        masked = by_key(masked)
    spent = [t.select("id", F.col("seconds").alias(f"_s{k}")) for k, t in enumerate((masked, again), 1) if t is not None and "seconds" in t.columns]
    kept = ["id", "_label", "audio_duration", "error", "_unfit", "pii_count", "redacted_text"]
    spent_here = [c for c in ("seconds",) if c in rows.columns]
    out = verify.with_text_status(rows.select(*kept, *(F.col(c).alias("_s0") for c in spent_here)))
    if again is None:  # what a row's text is worth is known beside it
        out = out.withColumn("overall_status", verify.overall(F.col("text_status"), F.lit(None).cast("string")))
    else:
        out = out.join(verify.verify_audio(ok, heard, unheard), "id", "left").withColumn("overall_status", verify.overall(F.col("text_status"), F.col("audio_status")))
    if masked is not None:
        out = out.join(masked.filter("error IS NOT NULL").select("id", F.col("error").alias("_masking")), "id", "left")
    else:
        out = out.withColumn("_masking", F.lit(None).cast("string"))
    for t in spent:
        out = out.join(t, "id", "left")
    seconds = sum((F.coalesce(c, F.lit(0.0)) for c in out.columns if c.startswith("_s")), F.lit(0.0))
    stage = F.when(F.col("error").isNotNull(), "transcription").otherwise(F.coalesce("_unfit.stage", F.when(F.col("_masking").isNotNull(), "audio_redaction")))
    error = F.coalesce("error", "_unfit.error", "_masking")
    done = error.isNull()
    out = out.select("id", "_label", done.alias("success"), stage.alias("stage"), error.alias("error"), F.coalesce("pii_count", F.lit(0)).alias("pii_count"), F.when(done, F.col("overall_status")).alias("status"), F.col("audio_duration").alias("duration"), seconds.alias("processing_time_s"), F.when(done, F.col("redacted_text")).alias("redacted_text"))
    told = labelled(out).withColumnRenamed("id", "conversation_id")
    return Result(words, matches, labelled(texts), spans, labelled(checked), told.drop("redacted_text"), told)


def run(spark: SparkSession, audio_path: str, model: Callable, config: Config | None = None) -> Result:
    """Audio in, everything out; writes below config.output if that is set. The speech model hears each file once, and
    once more when it is masked: what it heard is written, or held in the executors where there is no output."""
    config = config or Config()

    def once(df: DataFrame, name: str) -> DataFrame:
        if not config.output:
            return df.persist()
        df.write.mode("overwrite").parquet(f"{config.output}/{name}")
        return spark.read.schema(df.schema).parquet(f"{config.output}/{name}")

    files = io.require_files(io.audio_files(spark, audio_path))
    heard = once(io.transcribe(files, model, config.device, config.model_name, config.profile), "transcripts_raw")
    fit = heard.filter("error IS NULL").filter(unfit(F.col("segments")).isNull())
    found = once(detect.detect(detect.words_of(by_key(fit)), config.may_context), "qa/matches")
    first = redact_transcripts(heard, config, found=found)
    transcribed = files.select("key", "content").join(fit.select("key"), "key", "left_semi").withColumnRenamed("key", "id")
    silenced = audio.mask_files(transcribed, first.regions, config.audio_format, config.frequency, config.amplitude)
    silenced = once(silenced.withColumnRenamed("id", "key").join(heard.select("key", "id"), "key"), "audio")
    again = None
    if config.verify_audio:
        again = once(io.transcribe(silenced.filter("error IS NULL").withColumn("path", F.col("id")), model, config.device, config.model_name, config.profile), "qa/transcripts_again")
    got = redact_transcripts(heard, config, again, silenced.select("key", "error", "seconds"), found)
    if config.output:
        write(got, heard, config)
        found = verify.findings(by_key(got.redacted), detect.words_of(by_key(again.filter("error IS NULL"))) if again is not None else None)
        found.withColumnRenamed("id", "key").join(heard.select("key", "id"), "key").write.mode("overwrite").json(f"{config.output}/qa/findings")
    return got


def write(got: Result, transcripts: DataFrame, config: Config) -> None:
    """De-identified transcripts, results, manifest, report, and the running numbers of the batch (ordinal, total, by
    path) below config.output."""
    deid = deidentified(got, transcripts, config)
    io.write_transcripts(deid.drop("key"), f"{config.output}/transcripts_deid")
    got.results.write.mode("overwrite").parquet(f"{config.output}/qa/results")
    results = got.results.sparkSession.read.schema(got.results.schema).parquet(f"{config.output}/qa/results")
    report.manifest(results, config.run_date, rate=config.rate).write.mode("overwrite").json(f"{config.output}/metadata/manifest")
    trees.write_report(results, f"{config.output}/qa/processing_report/report.json", config.run_date)
    batch = numbered(results.select("conversation_id", "key"), ["key"])
    batch.write.mode("overwrite").parquet(f"{config.output}/qa/batch")


def deidentified(got: Result, transcripts: DataFrame, config: Config) -> DataFrame:
    """redact.deidentified() of the successful rows, with key."""
    rows = keyed(transcripts)
    fit = by_key(rows).join(got.results.filter("success").select(F.col("key").alias("id")), "id", "left_semi")
    deid = redact.deidentified(got.words, got.matches, fit, config.include_original).withColumnRenamed("conversation_id", "key")
    return rows.select("key", F.col("id").alias("conversation_id")).join(deid, "key")


def export(got: Result, transcripts: DataFrame, audio_files: DataFrame | None, path: str, config: Config) -> None:
    """The files that other tools read: a JSON file a conversation below transcripts_raw/train and transcripts_deid/train,
    masked audio (key, id, content) below audio/train, metadata/manifest.json and qa/processing_report.json. Conversations
    of one label are kept apart by a tag of their keys."""
    rows = keyed(transcripts)
    raw = rows.filter("error IS NULL").select("key", F.col("id").alias("conversation_id"), *(c for c in ("audio_path", "audio_duration", "language", "language_probability", "segments") if c in rows.columns))
    trees.write_objects(raw, f"{path}/transcripts_raw/train")
    trees.write_objects(deidentified(got, transcripts, config), f"{path}/transcripts_deid/train")
    if audio_files is not None:
        named = trees.file_names(audio_files.filter("content IS NOT NULL").withColumnRenamed("id", "conversation_id"), f".{config.audio_format}")
        trees.write_files(named.select("name", F.col("content").alias("body")), f"{path}/audio/train")
    trees.write_array(report.manifest(got.results, config.run_date, rate=config.rate), f"{path}/metadata/manifest.json", ["conversation_id", "duration_sec", "pii_count"])
    trees.write_report(got.results, f"{path}/qa/processing_report.json", config.run_date)


def load(name: str) -> Callable:
    """The speech model "module:function"; see sources.files.transcribe."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> int:
    """Redacts audio (with --model) or transcripts (JSON); 1 if any conversation failed or there was nothing to do."""
    p = argparse.ArgumentParser(description="Redact conversations")
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--input", help="a folder")
    where.add_argument("--file", help="one file")
    where.add_argument("--test", dest="input", action="store_const", const=SAMPLES, help=f"the samples in {SAMPLES}")
    p.add_argument("--output", required=True)
    p.add_argument("--model", help="module:function that makes a speech model; without it the input is transcripts")
    p.add_argument("--no-verify", action="store_true", help="do not transcribe the masked audio again")
    p.add_argument("--format", default="wav", help="of the masked audio")
    p.add_argument("--date", default="1970-01-01")
    p.add_argument("--may-context", action="store_true")
    p.add_argument("--hide-original", action="store_true")
    p.add_argument("--device", default="auto", help="auto, cuda or cpu")
    p.add_argument("--tree", help="also write one file a conversation, the manifest and the report below this folder")
    p.add_argument("--verbose", action="store_true")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    for noisy in ("py4j", "pyspark"):
        logging.getLogger(noisy).setLevel(logging.WARNING)
    log.info("output %s, second transcription %s", a.output, not a.no_verify and a.model is not None)
    spark = SparkSession.builder.appName("redactory").getOrCreate()
    config = Config(a.output, not a.no_verify, a.may_context, not a.hide_original, a.date, audio_format=a.format)
    config.device, config.model_name = a.device, a.model
    try:
        if a.model:
            got = run(spark, a.input or a.file, load(a.model), config)
            df, sounds = spark.read.parquet(f"{a.output}/transcripts_raw"), spark.read.parquet(f"{a.output}/audio")
        else:
            df, sounds = io.transcripts(spark, a.input or a.file), None
            got = redact_transcripts(df, config)
            write(got, df, config)
    except FileNotFoundError as e:
        print(e)
        return 1
    if a.tree:
        export(got, df, sounds, a.tree, config)
    totals = report.summary(got.results).first()
    log.info("statuses %s", {r["status"]: r["n"] for r in verify.status_counts(got.results.filter("success"), "status").collect()})
    print(f"{totals['successful']} of {totals['total_conversations']} conversations, {totals['total_pii_redacted']} terms redacted")
    for r in report.failures(got.results).orderBy("conversation_id").limit(20).collect():
        print(f"failed: {r['conversation_id']} ({r['stage']}): {r['error']}")
    return int(totals["failed"] > 0)


if __name__ == "__main__":
    raise SystemExit(main())
