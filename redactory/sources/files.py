"""Sources and sinks: audio files, transcripts, listings; JSON and Parquet outputs."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, StructType

from ..functions.text import clean_asr, clean_human, stem

AUDIO = "*.{wav,mp3,flac,m4a,ogg,WAV,MP3,FLAC,M4A,OGG}"
WORD = "struct<word:string,start:double,end:double,confidence:double>"
SEGMENTS = f"array<struct<text:string,start:double,end:double,words:array<{WORD}>>>"
TRANSCRIPT = f"conversation_id string, audio_path string, audio_duration double, language string, language_probability double, segments array<struct<text:string,start:double,end:double,words:array<{WORD}>>>, redacted_text string, original_text string, text string"


def _found(path: str, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"not found: {path}") from e
        raise


def audio_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, key, path, length, content) of audio files below path or of one file. id is the file's stem, a label that
    files of several folders may share; key tells them apart. Lazy: content is read when it is used."""
    df = _found(path, lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", AUDIO).load(path))
    return df.select(stem(F.col("path")).alias("id"), F.col("path").alias("key"), "path", "length", "content")


def require_files(files: DataFrame) -> DataFrame:
    if files.select("path").isEmpty():
        raise FileNotFoundError("no audio files found")
    return files


def parsed(files: DataFrame) -> DataFrame:
    """Transcripts of JSON files (path, value), one object or an array of them each: the columns of TRANSCRIPT, id (the
    conversation's, else the file's stem), key (the path, and the place of all but the first in it) and error, which a
    file that holds no transcript has."""
    got = files.select("path", F.posexplode_outer(F.from_json("value", ArrayType(StructType.fromDDL(TRANSCRIPT)))).alias("at", "t"))
    key = F.when(F.coalesce("at", F.lit(0)) == 0, F.col("path")).otherwise(F.concat_ws("#", "path", "at"))
    error = F.when(F.col("t").isNull() | F.col("t.segments").isNull() & F.coalesce("t.redacted_text", "t.text", "t.original_text").isNull(), "no transcript in the file")
    return got.select("t.*", F.coalesce("t.conversation_id", stem(F.col("path"))).alias("id"), key.alias("key"), error.alias("error"))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """parsed() of the JSON files below path."""
    df = _found(path, lambda: spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path))
    return parsed(df.select(F.col("_metadata.file_path").alias("path"), "value"))


def keyed(rows: DataFrame) -> DataFrame:
    """rows (id, ...) with key, where they have none: a digest of the row, and a number among equal rows, which does not
    change when a task is repeated."""
    if "key" in rows.columns:
        return rows
    told = rows.withColumn("_digest", F.sha2(F.to_json(F.struct(*rows.columns)), 256))
    number = F.row_number().over(W.partitionBy("_digest").orderBy("_digest"))
    return told.withColumn("key", F.concat_ws("#", "_digest", number)).drop("_digest")


def human_transcripts(spark: SparkSession, path: str) -> DataFrame:
    df = _found(path, lambda: spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path))
    return df.select(stem(F.col("_metadata.file_path")).alias("id"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def sizes(heard: DataFrame) -> DataFrame:
    """(id, n_segments, n_words, audio_duration) of transcripts; nulls where a transcription failed."""
    words = F.aggregate("segments", F.lit(0), lambda n, s: n + F.coalesce(F.size(s["words"]), F.lit(0)))
    return heard.select("id", F.when(F.col("segments").isNotNull(), F.size("segments")).alias("n_segments"), words.alias("n_words"), "audio_duration")


def device(wanted: str = "auto") -> tuple[str, str]:
    """(device, number type) for a speech model, asked in the task: the GPU that Spark gave the task, else the CPU."""
    if wanted == "auto":
        task = TaskContext.get()
        wanted = "cuda" if task and "gpu" in task.resources() else "cpu"
    return wanted, "float16" if wanted == "cuda" else "float32"


def speech_profile(gpus: float = 1, cpus: int = 1):
    """The resources a task of transcribe() asks for, where the cluster schedules stages by resources."""
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus).resource("gpu", gpus)).build


def transcribe_audio(spark: SparkSession, path: str, model: Callable, **how) -> DataFrame:
    """transcribe() of one file or of a folder's."""
    return transcribe(require_files(audio_files(spark, path)), model, **how)


#: Models that a worker keeps between tasks, by their name and device.
_kept_models: dict[tuple, Callable] = {}


def made(model: Callable, wanted: str = "auto", name: str | None = None) -> Callable:
    """The function that model makes for the task's device: it is told device and compute_type if it has parameters of
    those names. A model with a name is made once a worker and device, others once a task."""
    where = dict(zip(("device", "compute_type"), device(wanted), strict=True))
    known = inspect.signature(model).parameters
    told = {k: v for k, v in where.items() if k in known}
    if name is None:
        return model(**told)
    at = (name, *where.values())
    if at not in _kept_models:
        _kept_models[at] = model(**told)
    return _kept_models[at]


def transcribe(files: DataFrame, model: Callable[..., Callable[[str, bytes], dict]], wanted: str = "auto", name: str | None = None, profile=None) -> DataFrame:
    """(id, key, path, segments, audio_duration, error, seconds) by a speech model, of files (id, path, content, and key
    where ids are not unique). made() tells how the model is made; it returns a function of (path, content) that gives a
    dict with segments and audio_duration, and its failures become errors. Words and segment texts are stripped of white
    space, and a word without a confidence has 1.0; seconds is the time spent on the file. profile: see speech_profile()."""
    import time

    import pandas as pd

    def tidy(segments):
        word = lambda w: {"word": (w["word"] or "").strip(), "start": w["start"], "end": w["end"], "confidence": 1.0 if w.get("confidence") is None else w["confidence"]}
        return [{"text": (s.get("text") or "").strip(), "start": s.get("start"), "end": s.get("end"), "words": [word(w) for w in s.get("words") or []]} for s in segments]

    def run(batches):
        one = made(model, wanted, name)
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                began = time.perf_counter()
                try:
                    got = one(r.path, r.content)
                    row = (tidy(got["segments"]), got.get("audio_duration"), None)
                except Exception as e:  # a conversation that fails is a row
                    row = (None, None, str(e) or type(e).__name__)
                rows.append((r.id, r.key, r.path, *row, time.perf_counter() - began))
            yield pd.DataFrame(rows, columns=["id", "key", "path", "segments", "audio_duration", "error", "seconds"])

    if "key" not in files.columns:
        files = files.withColumn("key", F.col("path"))
    return files.select("id", "key", "path", "content").mapInPandas(run, f"id string, key string, path string, segments {SEGMENTS}, audio_duration double, error string, seconds double", profile=profile)


def pair_by_stem(asr: DataFrame, human: DataFrame) -> DataFrame:
    """ASR transcripts with the first human one (by path) of the same id: (id, reference, hypothesis), cleaned."""
    first = human.withColumn("_n", F.row_number().over(W.partitionBy("id").orderBy("path"))).filter("_n = 1").select("id", F.col("text").alias("human"))
    heard = asr.select("id", clean_asr(F.col("segments"), F.col("redacted_text"), F.col("text")).alias("hypothesis"))  # words and times are not shuffled
    return heard.join(first, "id").select("id", clean_human(F.col("human")).alias("reference"), "hypothesis")


def to_fetch(listing: DataFrame, present: DataFrame, suffix: str = ".wav", contains: str = "", most: int = 50) -> DataFrame:
    """The first `most` names of a remote listing (ordinal, name) that fit, less those present (name)."""
    fit = listing.filter(F.col("name").endswith(suffix) & F.col("name").contains(contains)).orderBy("ordinal").limit(most)
    return fit.join(present.select("name"), "name", "left_anti")


def write_transcripts(df: DataFrame, path: str, fmt: str = "json") -> None:
    """transcripts_raw / transcripts_deid: one JSON object (or Parquet row) a conversation."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of one row."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_audio(masked: DataFrame, write: Callable[[str, bytes], None]) -> None:
    """Hands each file (id, content) to write(id, content) in the task that made it."""
    masked.select("id", "content").foreachPartition(lambda rows: [write(r["id"], bytes(r["content"])) for r in rows] and None)
