"""Audio: decoding, tones, masking and encoding, as Arrow functions over one file a row.

WAV is read and written with the standard library; other formats need the soundfile package, which is used if it
is there."""

from __future__ import annotations

import io
import time
import wave
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .regions import bleep_regions

try:
    import soundfile
except ImportError:
    soundfile = None


def tone(seconds: float, rate: int = 16000, frequency: float = 1000, amplitude: float = 0.5, fade_s: float = 0.010) -> np.ndarray:
    """A sine over [0, seconds], both ends included, with linear fades where it is long enough for two."""
    n = int(seconds * rate)
    t = np.linspace(0, seconds, n, dtype=np.float32)
    out = (amplitude * np.sin(2 * np.pi * frequency * t)).astype(np.float32)
    fade = int(fade_s * rate)
    if n > 2 * fade > 0:
        out[:fade] *= np.linspace(0, 1, fade, dtype=np.float32)
        out[-fade:] *= np.linspace(1, 0, fade, dtype=np.float32)
    return out


def tone_part(seconds: float, lo: int, hi: int, rate: int = 16000, frequency: float = 1000, amplitude: float = 0.5, fade_s: float = 0.010) -> np.ndarray:
    """Samples lo to hi of tone(), to the bit, without making the others."""
    n = int(seconds * rate)
    lo, hi = max(lo, 0), min(hi, n)
    at = np.arange(lo, max(lo, hi))
    t = at * (seconds / (n - 1)) if n > 1 else at * 0.0
    t[at == n - 1] = seconds if n > 1 else 0.0
    out = (amplitude * np.sin(2 * np.pi * frequency * t.astype(np.float32))).astype(np.float32)
    fade = int(fade_s * rate)
    if n > 2 * fade > 0:
        rise = np.linspace(0, 1, fade, dtype=np.float32)
        out[at < fade] *= rise[at[at < fade]]
        fall = at >= n - fade
        out[fall] *= np.linspace(1, 0, fade, dtype=np.float32)[at[fall] - (n - fade)]
    return out


def mono(raw: bytes, width: int, channels: int) -> np.ndarray:
    """Float32 samples of whole frames of that many bytes a sample; channels are averaged."""
    if width == 3:
        x = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        x = (np.pad(x, ((0, 0), (1, 0))).reshape(-1).view("<i4") / 2.0**31).astype(np.float32)
    else:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128 if width == 1 else np.frombuffer(raw, f"<i{width}").astype(np.float32) / 2.0 ** (8 * width - 1)
    return x.reshape(-1, channels).mean(1, dtype=np.float32)


def decode(content: bytes) -> tuple[int, np.ndarray]:
    """(rate, mono float32 samples)."""
    if content[:4] == b"RIFF":
        with wave.open(io.BytesIO(content)) as w:
            return w.getframerate(), mono(w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels())
    if soundfile is None:
        raise ValueError("only WAV can be decoded without the soundfile package")
    x, rate = soundfile.read(io.BytesIO(content), dtype="float32", always_2d=True)
    return rate, x.mean(1)


def pcm16(samples: np.ndarray) -> bytes:
    return (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()


def encode(samples: np.ndarray, rate: int, kind: str = "wav") -> bytes:
    out = io.BytesIO()
    if kind != "wav":
        if soundfile is None:
            raise ValueError(f"{kind} needs the soundfile package")
        soundfile.write(out, samples, rate, format=kind.upper())
    else:
        with wave.open(out, "wb") as w:
            w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
            w.writeframes(pcm16(samples))
    return out.getvalue()


def masked(samples: np.ndarray, rate: int, regions: list, frequency: float = 1000, amplitude: float = 0.5) -> np.ndarray:
    """samples with a tone over each region (start_time, end_time, bleep_duration); the tone is cut at the region's
    end, and what it leaves of the region is silent."""
    out = np.array(samples, np.float32)
    for start, end, seconds in regions:
        a, b = int(start * rate), min(int(end * rate), len(out))
        if b > a:
            bleep = tone(seconds, rate, frequency, amplitude)[: b - a]
            out[a:b] = 0
            out[a : a + len(bleep)] = bleep
    return out


def decoded(files: DataFrame) -> DataFrame:
    """(path, content) with rate, samples, duration, error; a file that cannot be read has an error and nulls."""

    def f(content: pd.Series) -> pd.DataFrame:
        rows = []
        for c in content:
            try:
                rate, x = decode(c)
                rows.append((rate, x, len(x) / rate, None))
            except Exception as e:  # a bad file is a row with an error, not a failed job
                rows.append((None, None, None, str(e)))
        return pd.DataFrame(rows, columns=["rate", "samples", "duration", "error"])

    udf = F.pandas_udf(f, "rate int, samples array<float>, duration double, error string")
    return files.withColumn("a", udf("content")).select(*files.columns, "a.*")


def redact_audio(files: DataFrame, matches: DataFrame, durations: DataFrame, kind: str = "wav", frequency: float = 1000, amplitude: float = 0.5, **padding) -> DataFrame:
    """mask_files() over the regions of matches; padding goes to regions.bleep_regions (before, after, min_ms)."""
    return mask_files(files, bleep_regions(matches, durations, **padding), kind, frequency, amplitude)


def mask_files(files: DataFrame, regions: DataFrame, kind: str = "wav", frequency: float = 1000, amplitude: float = 0.5) -> DataFrame:
    """(id, content, error, seconds) of masked audio from files (id, content) and regions (id, start_time, end_time,
    bleep_duration). A file that cannot be read or written again has null content and an error; seconds is the time
    spent on it."""

    def f(content: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for c, s in zip(content, spans, strict=True):
            began = time.perf_counter()
            try:
                rate, x = decode(c)
                out, error = encode(masked(x, rate, [(r["start_time"], r["end_time"], r["bleep_duration"]) for r in (s if s is not None else [])], frequency, amplitude), rate, kind), None
            except Exception as e:  # a bad file is a row with an error, not a failed job
                out, error = None, str(e) or type(e).__name__
            rows.append((out, error, time.perf_counter() - began))
        return pd.DataFrame(rows, columns=["content", "error", "seconds"])

    per = regions.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start_time", "end_time", "bleep_duration"))).alias("spans"))
    udf = F.pandas_udf(f, "content binary, error string, seconds double")
    return files.join(per, "id", "left").select("id", udf("content", "spans").alias("m")).select("id", "m.*")


def masked_part(samples: np.ndarray, first: int, frames: int, rate: int, regions: list, frequency: float = 1000, amplitude: float = 0.5) -> np.ndarray:
    """masked() of a file of that many frames, for the samples from frame first on."""
    out, end = np.array(samples, np.float32), first + len(samples)
    for start, stop, seconds in regions:
        a, b = int(start * rate), min(int(stop * rate), frames)
        lo, hi = max(a, first), min(b, end)
        if hi > lo:
            out[lo - first : hi - first] = 0
            bleep = tone_part(seconds, lo - a, hi - a, rate, frequency, amplitude)
            out[lo - first : lo - first + len(bleep)] = bleep
    return out


MASKED = "key string, name string, rate int, frames long, block long, pcm binary"


def mask_blocks(blocks: DataFrame, heads: DataFrame, regions: DataFrame, block_bytes: int, frequency: float = 1000, amplitude: float = 0.5) -> DataFrame:
    """MASKED: the blocks of files (sources.wav) as mono samples of 16 bits with a tone over the file's regions (id, the file's
    key, start_time, end_time, bleep_duration). heads has each file once, with the name that its copy is to have; a file
    with an error there is left out. What comes out is to the bit what mask_files() makes of the whole file.

    Regions are cut at the borders of blocks, so that each meets the blocks that it touches. Files, regions and blocks
    are dealt by file and sorted once; a task then holds one block and its regions."""
    good = heads.filter("error IS NULL").select("key", "name", "rate", "frames", (F.col("channels") * F.col("width")).alias("_each"))
    first, stop = (F.col("start_time") * F.col("rate")).cast("long"), F.least((F.col("end_time") * F.col("rate")).cast("long"), F.col("frames"))
    spans = regions.select(F.col("id").alias("key"), "start_time", "end_time", F.col("bleep_duration").alias("seconds")).join(good, "key").filter(stop > first)
    block_of = lambda frame: F.floor(frame * F.col("_each") / F.lit(block_bytes))
    spans = spans.withColumn("block", F.explode(F.sequence(block_of(first), block_of(stop - 1))))
    none = lambda kind: F.lit(None).cast(kind)
    rows = good.select("key", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("kind"), "name", "rate", "frames", none("long").alias("first_frame"), none("int").alias("channels"), none("int").alias("width"), none("binary").alias("pcm"), *(none("double").alias(c) for c in ("start_time", "end_time", "seconds")))
    rows = rows.unionByName(spans.select("key", "block", F.lit(1).alias("kind"), "start_time", "end_time", "seconds"), allowMissingColumns=True)
    rows = rows.unionByName(blocks.filter("error IS NULL").select("key", "block", F.lit(2).alias("kind"), "rate", "frames", "first_frame", "channels", "width", "pcm"), allowMissingColumns=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = name = at = None
        spans: list[tuple] = []
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch[c][k] for c in batch.schema.names}
                kind, block = r["kind"].as_py(), r["block"].as_py()
                if kind == 0:
                    key, name = r["key"].as_py(), r["name"].as_py()
                elif kind == 1:
                    if at != (key, block):
                        at, spans = (key, block), []
                    spans.append((r["start_time"].as_py(), r["end_time"].as_py(), r["seconds"].as_py()))
                elif r["key"].as_py() == key:
                    rate, frames = r["rate"].as_py(), r["frames"].as_py()
                    x = mono(r["pcm"].as_py(), r["width"].as_py(), r["channels"].as_py())
                    out = pcm16(masked_part(x, r["first_frame"].as_py(), frames, rate, spans if at == (key, block) else [], frequency, amplitude))
                    yield pa.RecordBatch.from_pydict({"key": [key], "name": [name], "rate": pa.array([rate], pa.int32()), "frames": pa.array([frames], pa.int64()), "block": pa.array([block], pa.int64()), "pcm": pa.array([out], pa.binary())})

    return rows.repartition("key").sortWithinPartitions("key", "block", "kind", "start_time", "end_time").mapInArrow(run, MASKED)
