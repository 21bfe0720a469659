"""The chain from audio files to reports, and its command line, with a speech model that fails on some files."""

import io
import json
import sys
import wave
from pathlib import Path

import numpy as np
import pytest

from redactory.operators import audio, regions
from redactory.plans import pipeline

sys.path.insert(0, str(Path(__file__).resolve().parent))
import fake_speech  # noqa: E402


def wav(seconds: float = 2.0, rate: int = 8000, channels: int = 1) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(np.full(int(seconds * rate) * channels, 1000, "<i2").tobytes())
    return out.getvalue()


@pytest.fixture
def sounds(tmp_path, monkeypatch):
    d = tmp_path / "in"
    d.mkdir()
    for name in ("a", "b", "c", "d"):
        (d / f"{name}.wav").write_bytes(wav())
    (d / "broken.wav").write_bytes(wav())
    monkeypatch.setenv("FAKE_SPEECH_LOG", str(tmp_path / "log"))
    return d


def model(log: str):
    def make():
        import os

        os.environ["FAKE_SPEECH_LOG"] = log
        return fake_speech.model()

    return make


def ship(spark):
    spark.sparkContext.addPyFile(fake_speech.__file__)


def test_run(spark, sounds, tmp_path):
    ship(spark)
    (sounds / "e.mp3").write_bytes(b"no sound")  # heard by no one
    (sounds / "d.wav").write_bytes(b"RIFF....")  # heard, but cannot be masked
    out = str(tmp_path / "out")
    got = pipeline.run(spark, str(sounds), model(str(tmp_path / "log")), pipeline.Config(out, run_date="2024-01-01"))
    rows = {r["conversation_id"]: r for r in got.results.collect()}
    assert {k: (r["success"], r["stage"], r["status"]) for k, r in rows.items()} == {
        "a": (True, None, "PASS"), "b": (True, None, "PASS"), "c": (True, None, "REVIEW_REQUIRED"),  # the masked audio of c was not heard
        "d": (False, "audio_redaction", None), "broken": (False, "transcription", None), "e": (False, "transcription", None)}
    assert all(r["processing_time_s"] > 0 for r in rows.values()) and rows["a"]["pii_count"] == 1
    heard = (tmp_path / "log").read_text().split("\n")[:-1]
    assert sorted(heard) == sorted([f"{n} False" for n in ("a", "b", "broken", "c", "d", "e")] + [f"{n} True" for n in ("a", "b", "c")])  # once each
    notes = {r["id"]: r["notes"] for r in got.verification.collect()}
    assert notes["c"] == ["Audio verification failed: cannot hear c"]
    masked = {r["id"]: r["content"] for r in spark.read.parquet(f"{out}/audio").collect()}
    rate, x = audio.decode(bytes(masked["a"]))
    start, end = int(1.35 * rate), int(2.0 * rate)  # "Monday" from 1.5 on, widened by 0.15
    assert np.allclose(x[: start - 1], 1000 / 32768, atol=1e-3) and np.abs(x[start : end - 1]).max() > 0.4
    assert len(list(Path(f"{out}/metadata/manifest").glob("*.json"))) and len(spark.read.json(f"{out}/metadata/manifest").collect()) == 3
    report = json.loads(next(Path(f"{out}/qa/processing_report").glob("*.json")).read_text())
    assert report["summary"]["failed"] == 3 and {f["conversation_id"] for f in report["failures"]} == {"broken", "d", "e"}


def test_leak_is_found(spark, sounds, tmp_path):
    ship(spark)
    got = pipeline.run(spark, str(sounds / "d.wav"), model(str(tmp_path / "log")))
    assert [(r["conversation_id"], r["status"]) for r in got.results.collect()] == [("d", "REVIEW_REQUIRED")]  # March is heard again


def test_main(spark, sounds, tmp_path, capsys):
    ship(spark)
    (sounds / "broken.wav").unlink()
    out = str(tmp_path / "out")
    assert pipeline.main(["--input", str(sounds), "--output", out, "--model", "fake_speech:model", "--no-verify", "--hide-original"]) == 0
    assert "4 of 4 conversations" in capsys.readouterr().out
    deid = spark.read.json(f"{out}/transcripts_deid")
    assert "original_text" not in deid.columns and "[DATE]" not in deid.columns
    empty = tmp_path / "empty"
    empty.mkdir()
    assert pipeline.main(["--input", str(empty), "--output", out, "--model", "fake_speech:model"]) == 1
    talks = tmp_path / "talks"
    talks.mkdir()
    (talks / "t.json").write_text(json.dumps({"conversation_id": "t", "audio_duration": 2.0, "segments": [{"text": "on Monday", "start": 0.0, "end": 1.0, "words": [{"word": "on", "start": 0.0, "end": 0.4}, {"word": "Monday", "start": 0.5, "end": 0.9}]}]}))
    assert pipeline.main(["--file", str(talks / "t.json"), "--output", str(tmp_path / "o2")]) == 0
    assert "1 of 1 conversations, 1 terms redacted" in capsys.readouterr().out


def test_mask_files_rows(spark):
    files = spark.createDataFrame([("a", wav(channels=2)), ("bad", b"zz"), ("none", None)], "id string, content binary")
    spans = spark.createDataFrame([("a", 0.5, 1.0, 0.5)], "id string, start_time double, end_time double, bleep_duration double")
    got = {r["id"]: r for r in audio.mask_files(files, spans).collect()}
    assert got["a"]["error"] is None and got["bad"]["content"] is None and got["bad"]["error"] and got["none"]["error"]
    rate, x = audio.decode(bytes(got["a"]["content"]))
    assert len(x) == 2 * rate and abs(float(x[0]) - 1000 / 32768) < 1e-3


def test_samples(spark, tmp_path, monkeypatch, capsys):
    """--test takes the recordings of a fixed folder."""
    ship(spark)
    monkeypatch.chdir(tmp_path)
    assert pipeline.main(["--test", "--output", str(tmp_path / "out"), "--model", "fake_speech:model"]) == 1 and "not found" in capsys.readouterr().out
    (tmp_path / pipeline.SAMPLES).mkdir(parents=True)
    (tmp_path / pipeline.SAMPLES / "b.WAV").write_bytes(wav())
    monkeypatch.setattr(pipeline, "SAMPLES", str(tmp_path / pipeline.SAMPLES))  # Spark's working folder is not this one
    assert pipeline.main(["--test", "--output", str(tmp_path / "out"), "--model", "fake_speech:model", "--no-verify"]) == 0
    assert "1 of 1 conversations, 0 terms redacted" in capsys.readouterr().out
