"""Audio by blocks, files by key, reports from ordered parts, remote listings."""

import io
import json
import os
import sys
import wave
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from redactory.operators import audio, report
from redactory.sources import remote, trees, wav
from redactory.sources.files import audio_files

sys.path.insert(0, str(Path(__file__).resolve().parent))
import fake_store  # noqa: E402


def sound(frames, rate=8000, channels=1, width=2, seed=1):
    raw = np.random.default_rng(seed).integers(0, 256, frames * channels * width, dtype=np.uint8).tobytes()
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        w.writeframes(raw)
    return out.getvalue()


@pytest.mark.parametrize("seconds", [0.0, 0.00001, 0.0002, 0.015, 0.4, 1.37])
def test_tone_in_parts(seconds):
    for rate in (8000, 16000):
        whole = audio.tone(seconds, rate)
        for size in (1, 7, 100, 5000)[0 if len(whole) < 500 else 1 :]:
            parts = [audio.tone_part(seconds, lo, lo + size, rate) for lo in range(0, len(whole), size)]
            assert np.array_equal(np.concatenate([np.zeros(0, np.float32), *parts]), whole)
        assert len(audio.tone_part(seconds, len(whole), len(whole) + 9, rate)) == 0


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
def test_masking_by_blocks(spark, tmp_path, block):
    """To the bit what masking the whole file gives, for all kinds of samples; bad files are rows with an error."""
    src, out = tmp_path / "in" / "deep", tmp_path / "out"
    src.mkdir(parents=True)
    frames = 3000 if block == 64 else 20_000
    kinds = {"mono": (frames, 8000, 1, 2), "stereo": (frames, 16000, 2, 2), "bytes": (frames, 8000, 1, 1), "three": (frames + 1, 8000, 2, 3), "four": (frames, 8000, 1, 4), "none": (0, 8000, 1, 2), "plain": (frames, 8000, 1, 2)}
    for n, k in kinds.items():
        (src / f"{n}.wav").write_bytes(sound(*k))
    (src.parent / "mono.wav").write_bytes(sound(50, seed=3))  # of the same stem
    (src / "bad.wav").write_bytes(b"RIFF\0\0\0\0WAVEjunk")
    (src / "cut.wav").write_bytes(sound(frames)[:900])
    (src / "other.mp3").write_bytes(b"no sound")
    heads = wav.wav_blocks(spark, str(tmp_path / "in"), heads=True)
    heads = trees.file_names(heads.withColumnRenamed("id", "conversation_id"), ".wav")
    assert heads.count() == 10 and [r["error"] is None for r in heads.orderBy("key").collect()].count(False) == 1
    rng = np.random.default_rng(5)
    spans = [(r["key"], float(a), float(a + d), float(max(d - 0.01, 0.02) if k % 3 else d + 0.2)) for r in heads.collect() for k, (a, d) in enumerate(zip(rng.uniform(0, 2.4, 6), rng.uniform(0.001, 0.6, 6))) if not r["key"].endswith("plain.wav")]
    regions = spark.createDataFrame(spans, "id string, start_time double, end_time double, bleep_duration double")
    blocks = wav.wav_blocks(spark, str(tmp_path / "in"), block)
    biggest = blocks.filter("error IS NULL").agg(F.max(F.length("pcm"))).first()[0]
    assert biggest <= block + 8  # no row holds more than a block
    wav.write_wav(audio.mask_blocks(blocks, heads, regions, block), str(out))
    names = {r["key"]: r["name"] for r in heads.filter("error IS NULL").collect()}
    for key, name in names.items():
        own = sorted((a, e, d) for k, a, e, d in spans if k == key)
        if key.endswith("cut.wav"):
            continue
        rate, x = audio.decode(Path(key).read_bytes())
        assert (out / name).read_bytes() == audio.encode(audio.masked(x, rate, own), rate), name
    cut = audio.decode((out / "cut.wav").read_bytes())[1]
    assert len(cut) == (900 - 44) // 2 and (out / "_SUCCESS").read_text() == str(len(names))
    assert sorted(n for n in names.values() if n.startswith("mono")) == sorted(p.name for p in out.glob("mono~*.wav"))
    with pytest.raises(Exception, match="not found"):
        wav.wav_blocks(spark, str(tmp_path / "nowhere")).count()


def test_blocks_of_a_large_file(spark, tmp_path):
    """A file of many blocks is planned as several partitions, and streams through one writer."""
    (tmp_path / "in").mkdir()
    body = sound(3_000_000, 48000, 2, 2)  # 12 MB
    (tmp_path / "in/long.wav").write_bytes(body)
    blocks = wav.wav_blocks(spark, str(tmp_path / "in"), 1 << 17)
    assert blocks.count() == 92 and blocks.agg(F.sum(F.length("pcm"))).first()[0] == 12_000_000
    heads = wav.wav_blocks(spark, str(tmp_path / "in"), heads=True).withColumn("name", F.lit("long.wav"))
    key = heads.first()["key"]
    regions = spark.createDataFrame([(key, 1.0, 60.0, 59.0), (key, 61.0, 61.5, 0.4)], "id string, start_time double, end_time double, bleep_duration double")
    wav.write_wav(audio.mask_blocks(blocks, heads, regions, 1 << 17), str(tmp_path / "out"))
    rate, x = audio.decode(body)
    assert (tmp_path / "out/long.wav").read_bytes() == audio.encode(audio.masked(x, rate, [(1.0, 60.0, 59.0), (61.0, 61.5, 0.4)]), rate)


def test_redact_audio_passes_its_parameters(spark):
    body = sound(16000)
    file = spark.createDataFrame([("a", body)], "id string, content binary")
    m = spark.createDataFrame([("a", 0.5, 0.6)], "id string, start_time double, end_time double")
    d = spark.createDataFrame([("a", 2.0)], "id string, duration double")
    got = audio.redact_audio(file, m, d, frequency=440, amplitude=0.25, before=0.0, after=0.1, min_ms=50.0).first()
    rate, x = audio.decode(body)
    assert bytes(got["content"]) == audio.encode(audio.masked(x, rate, [(0.5, 0.6 + 0.1, max(400.0, (0.6 + 0.1 - 0.5) * 1000) / 1000)], 440, 0.25), rate)


def test_files_by_key(spark, tmp_path):
    rows = [(f"d{i % 3}/f{i}.txt", f"body {i}") for i in range(200)] + [("none", None), ("empty", "")]
    df = spark.createDataFrame(rows, "name string, body string").repartition(5)
    for _ in range(2):  # again: the same files
        trees.write_files(df, str(tmp_path / "t"))
    found = {str(p.relative_to(tmp_path / "t")): p.read_text() for p in (tmp_path / "t").rglob("*") if p.is_file()}
    assert found == {n: b or "" for n, b in rows} | {"_SUCCESS": "202"}


def test_report_and_array_are_streamed(spark, tmp_path, monkeypatch):
    """100,000 conversations: one object, one array, read back equal; pieces are small."""
    n = 100_000
    results = spark.range(n).select(F.format_string('c"%06d\n', (F.col("id") * 7919 % n).cast("int")).alias("conversation_id"), F.col("id").cast("string").alias("key"), (F.col("id") % 10 > 0).alias("success"), F.when(F.col("id") % 10 == 0, "detection").alias("stage"),
                                    F.when(F.col("id") % 10 == 0, 'bad "x"\\').alias("error"), F.lit(1).alias("pii_count"), F.when(F.col("id") % 10 > 0, F.lit("PASS")).alias("status"), (F.col("id") / 8).alias("duration"), (F.col("id") / 4).alias("processing_time_s"))
    monkeypatch.setattr(trees, "CHUNK", 1000)
    trees.write_report(results, str(tmp_path / "r.json"), "now")
    got = json.loads((tmp_path / "r.json").read_text())
    assert got["timestamp"] == "now" and got["summary"]["successful"] == 90_000 and got["verification_status"] == {"PASS": 90_000, "PASS_WITH_NOTE": 0, "REVIEW_REQUIRED": 0, "FAIL": 0}
    assert len(got["failures"]) == 10_000 and got["failures"][0] == {"conversation_id": min(f["conversation_id"] for f in got["failures"]), "stage": "detection", "error": 'bad "x"\\'}
    assert len(got["processing_times"]) == n and list(got["processing_times"]) == sorted(got["processing_times"]) and got["processing_times"]['c"007919\n'] == 0.25
    trees.write_array(report.manifest(results, "d"), str(tmp_path / "m.json"), ["conversation_id"])
    rows = json.loads((tmp_path / "m.json").read_text())
    assert len(rows) == 90_000 and rows == sorted(rows, key=lambda r: r["conversation_id"])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["m.json", "r.json"]  # no parts are left
    trees.write_array(report.manifest(results.limit(0), "d"), str(tmp_path / "e.json"), ["conversation_id"])
    trees.write_report(results.limit(0), str(tmp_path / "er.json"), "now")
    assert json.loads((tmp_path / "e.json").read_text()) == [] and json.loads((tmp_path / "er.json").read_text())["failures"] == []


def test_equal_ids_keep_the_last_time(spark, tmp_path):
    rows = [("a", "x/a", 1.5), ("a", "z/a", 0.5), ("a", "y/a", 9.0), (None, "n", 2.0)]
    df = spark.createDataFrame(rows, "conversation_id string, key string, processing_time_s double").selectExpr("*", "true AS success", "NULL AS stage", "NULL AS error", "0 AS pii_count", "'PASS' AS status", "1.0D AS duration")
    trees.write_report(df, str(tmp_path / "r.json"), "t")
    assert json.loads((tmp_path / "r.json").read_text())["processing_times"] == {"": 2.0, "a": 0.5}


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    spark.sparkContext.addPyFile(fake_store.__file__)
    monkeypatch.setenv("FAKE_STORE", str(tmp_path))
    return lambda *names: (tmp_path / "listing").write_text("\n".join(names))


def in_workers(spark, tmp_path):
    name = f"fake_store_at_{abs(hash(str(tmp_path)))}"
    file = tmp_path / f"{name}.py"
    file.write_text(f"import os\nos.environ['FAKE_STORE'] = {str(tmp_path)!r}\nfrom fake_store import make  # noqa\n")
    spark.sparkContext.addPyFile(str(file))
    sys.path.insert(0, str(tmp_path))
    return f"{name}:make"


def test_fetch(spark, store, tmp_path):
    store("x/a.wav", "x/b.txt", "x/c.wav", "x/flaky.wav", "y/broken.wav", "y/d.wav", "lost", "lost", "lost", "y/e.wav", "y/f.wav")
    made, out = in_workers(spark, tmp_path), tmp_path / "out"
    listed = remote.listing(spark, made, 1, 0.0).orderBy("ordinal").collect()
    assert [r["name"] for r in listed] == ["x/a.wav", "x/b.txt", "x/c.wav", "x/flaky.wav", "y/broken.wav", "y/d.wav", None, "y/e.wav", "y/f.wav"] and listed[6]["error"] == "page is gone"
    assert remote.listing(spark, made).rdd.getNumPartitions() == 4  # a page a partition
    out.mkdir()
    (out / "c.wav").write_bytes(b"old")
    got = {r["name"]: r for r in remote.fetch_missing(spark, made, str(out), most=6, retries=2, wait=0.0).collect()}
    assert set(got) == {"x/a.wav", "x/flaky.wav", "y/broken.wav", "y/d.wav", "y/e.wav", None}  # of the first six, c is there
    assert got["x/a.wav"]["bytes"] == 21 and (out / "a.wav").read_bytes() == b"x/a.wav" * 3 and (out / "c.wav").read_bytes() == b"old"
    assert (got["x/flaky.wav"]["attempts"], got["x/flaky.wav"]["error"]) == (3, None)
    assert (got["y/broken.wav"]["attempts"], got["y/broken.wav"]["error"]) == (3, "cannot read y/broken.wav") and not (out / "broken.wav").exists()
    assert got[None]["error"] == "page is gone" and sorted(os.listdir(out)) == ["a.wav", "c.wav", "d.wav", "e.wav", "flaky.wav"]


def test_fetch_transcripts(spark, store, tmp_path):
    store("p/TRANSCRIPTION/a.txt", "p/audio/a.wav", "p/other/b.txt", "q/TRANSCRIPTION/c.txt")
    made = in_workers(spark, tmp_path)
    got = remote.fetch_missing(spark, made, str(tmp_path / "new"), ".txt", "TRANSCRIPTION", 40, skip_present=False, wait=0.0).collect()
    assert sorted(r["file"] for r in got) == ["a.txt", "c.txt"] and (tmp_path / "new/c.txt").exists()
    assert audio_files(spark, str(tmp_path / "new")).count() == 0
