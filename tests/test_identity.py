"""Rows are told apart by key: equal stems, null ids, streaming; stages of failures; keys that the sources give."""

import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

from redactory.operators import detect, redact
from redactory.plans import pipeline
from redactory.sources import files, trees
from redactory.streaming.transcripts import redact_stream

sys.path.insert(0, str(Path(__file__).resolve().parent))
import fake_speech  # noqa: E402
from test_run import model, ship, wav  # noqa: E402

KIND = f"id string, segments {files.SEGMENTS}, audio_duration double, error string"


def said(text, at=0.0):
    words = [(w, at + k / 2, at + k / 2 + 0.4, 1.0) for k, w in enumerate(text.split())]
    return [(text, at, at + len(words) / 2, words)]


def as_json(text, **more):
    seg = [{"text": t, "start": a, "end": b, "words": [dict(zip(("word", "start", "end"), w)) for w in ws]} for t, a, b, ws in said(text)]
    return json.dumps({"audio_duration": 9.0, "segments": seg, **more})


def test_equal_and_null_ids(spark):
    rows = [("a", said("See you on Monday"), 9.0, None), ("a", said("call Denver now"), 9.0, None), (None, said("in Texas"), 9.0, None), (None, said("all well"), 9.0, None), ("a", said("call Denver now"), 9.0, None), (None, None, None, "no codec")]
    got = pipeline.redact_transcripts(spark.createDataFrame(rows, KIND).repartition(3))
    texts = sorted((r["id"] or "", r["redacted_text"], r["pii_count"]) for r in got.redacted.collect())
    assert texts == [("", "all well", 0), ("", "in [STATE]", 1), ("a", "See you on [DAY]", 1), ("a", "call [CITY] now", 1), ("a", "call [CITY] now", 1)]
    results = got.results.collect()
    assert len(results) == 6 and len({r["key"] for r in results}) == 6
    assert sorted((r["conversation_id"] or "", r["success"], r["status"] or "", r["pii_count"]) for r in results) == [("", False, "", 0), ("", True, "PASS", 0), ("", True, "PASS", 1), ("a", True, "PASS", 1), ("a", True, "PASS", 1), ("a", True, "PASS", 1)]


def test_equal_stems_in_two_folders(spark, tmp_path):
    ship(spark)
    for folder in ("train", "test"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "a.wav").write_bytes(wav())
    out = str(tmp_path / "out")
    config = pipeline.Config(out)
    got = pipeline.run(spark, str(tmp_path / "in"), model(str(tmp_path / "log")), config)
    rows = got.results.collect()
    assert [(r["conversation_id"], r["success"], r["pii_count"], r["status"]) for r in rows] == [("a", True, 1, "PASS")] * 2
    assert {r["key"].split("/")[-2] for r in rows} == {"train", "test"}
    pipeline.export(got, spark.read.parquet(f"{out}/transcripts_raw"), spark.read.parquet(f"{out}/audio"), str(tmp_path / "tree"), config)
    for folder, end in (("transcripts_deid/train", ".json"), ("transcripts_raw/train", ".json"), ("audio/train", ".wav")):
        names = sorted(p.name for p in (tmp_path / "tree" / folder).glob(f"*{end}"))
        assert len(names) == 2 and all(n.startswith("a~") for n in names)
    report = json.loads((tmp_path / "tree/qa/processing_report.json").read_text())
    assert report["summary"]["successful"] == 2 and list(report["processing_times"]) == ["a"]
    assert spark.read.parquet(f"{out}/qa/batch").select("ordinal", "total").orderBy("ordinal").collect() == [(1, 2), (2, 2)]


def test_stages_of_failures(spark):
    word = lambda w, a, b: (w, a, b, 1.0)
    rows = [("no words", [("", 0.0, 1.0, [])], 9.0, None), ("null word", [("x", 0.0, 1.0, [word(None, 0.0, 1.0)])], 9.0, None), ("no times", [("Monday", 0.0, 1.0, [word("Monday", None, None)])], 9.0, None),
            ("no segments", None, 9.0, None), ("unheard", None, None, "no codec"), ("fine", said("on Monday"), 9.0, None)]
    got = pipeline.redact_transcripts(spark.createDataFrame(rows, KIND))
    assert {r["conversation_id"]: (r["success"], r["stage"]) for r in got.results.collect()} == {
        "no words": (True, None), "null word": (False, "detection"), "no times": (False, "audio_redaction"), "no segments": (False, "detection"), "unheard": (False, "transcription"), "fine": (True, None)}


def test_transcript_files(spark, tmp_path, capsys):
    for name, body in (("x/t.json", as_json("on Monday")), ("y/t.json", as_json("in Texas")), ("many.json", f"[{as_json('red', conversation_id='m')}, {as_json('all well')}]"), ("bad.json", "{not json")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(body)
    rows = files.transcripts(spark, str(tmp_path / "in"))
    assert sorted((r["id"], r["key"].rpartition("/in/")[2], r["error"] is None) for r in rows.collect()) == [("bad", "bad.json", False), ("m", "many.json", True), ("many", "many.json#1", True), ("t", "x/t.json", True), ("t", "y/t.json", True)]
    out = str(tmp_path / "out")
    assert pipeline.main(["--input", str(tmp_path / "in"), "--output", out, "--tree", str(tmp_path / "tree")]) == 1  # one failed
    assert "4 of 5 conversations, 3 terms redacted" in capsys.readouterr().out
    deid = [json.loads(p.read_text()) for p in (tmp_path / "tree/transcripts_deid/train").glob("*.json")]
    assert sorted(d["redacted_text"] for d in deid) == ["[COLOR]", "all well", "in [STATE]", "on [DAY]"]
    manifest = json.loads((tmp_path / "tree/metadata/manifest.json").read_text())
    assert [m["conversation_id"] for m in manifest] == ["m", "many", "t", "t"] and set(manifest[0]) == {"conversation_id", "duration_sec", "num_speakers", "sample_rate", "has_pii", "pii_count", "deid_version", "qa_status"}
    assert pipeline.main(["--file", str(tmp_path / "none.json"), "--output", out]) == 1
    assert "not found" in capsys.readouterr().out


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "one.json").write_text(as_json("on Monday"))  # no id of its own
    (src / "two.json").write_text(as_json("call Denver now", conversation_id="c"))
    places = [str(tmp_path / n) for n in ("out", "check")]
    redact_stream(spark, str(src), *places).awaitTermination()
    (src / "three.json").write_text(as_json("in Texas", conversation_id="c"))
    redact_stream(spark, str(src), *places).awaitTermination()
    got = spark.read.parquet(places[0])
    assert sorted((r["id"], r["redacted_text"], r["batch"]) for r in got.collect()) == [("c", "call [CITY] now", 0), ("c", "in [STATE]", 1), ("one", "on [DAY]", 0)]
    assert spark.read.parquet(f"{places[0]}_results").filter("success").count() == 3


def test_device_and_kept_models(monkeypatch):
    class Task:
        def resources(self):
            return {"gpu": object()}

    assert files.device() == ("cpu", "float32")
    monkeypatch.setattr(files.TaskContext, "get", staticmethod(Task))
    assert files.device() == ("cuda", "float16") and files.device("cpu") == ("cpu", "float32")
    seen = []

    def make(device, compute_type):
        seen.append((device, compute_type))
        return lambda path, content: {"segments": []}

    one = files.made(make, "auto", "tiny")
    assert files.made(make, "auto", "tiny") is one and seen == [("cuda", "float16")]
    files.made(make, "cpu", "tiny"), files.made(make, "auto"), files.made(make, "auto")
    assert seen[1:] == [("cpu", "float32")] + [("cuda", "float16")] * 2
    assert files.made(lambda: "plain") == "plain"


def test_transcribe_strips_texts_and_knows_its_device(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav())

    def make(device):
        return lambda path, content: {"audio_duration": 1.0, "segments": [{"text": f"  on {device} ", "start": 0.0, "end": 1.0, "words": [{"word": " on ", "start": 0.0, "end": 1.0}]}]}

    r = files.transcribe_audio(spark, str(tmp_path), make, wanted="cpu").first()
    assert r["segments"][0]["text"] == "on cpu" and r["segments"][0]["words"][0]["word"] == "on" and r["id"] == "a" and r["key"].endswith("/a.wav")


MAY = [("You may proceed", False), ("It may rain tomorrow", False), ("avocado may actually be", False), ("In May we celebrate", True), ("during May the weather", True), ("last May I visited", True), ("next May will be", True),
       ("May 15th is the date", True), ("on May 1st we", True), ("May 2024 was great", True), ("I said that nobody was here and you may go since it is over", False), ("word " * 9 + "may, 3 of them", False)]


def test_may_in_all_modes(spark):
    """By words, exact and with near terms, and as text; without the context no "may" is a month."""
    w = spark.createDataFrame([(i, 0, k, t, k * 0.5, k * 0.5 + 0.4) for i, (text, _) in enumerate(MAY) for k, t in enumerate(text.split())], "id int, seg int, idx int, word string, start_time double, end_time double")
    t = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(MAY)], "id int, text string")
    months = lambda df: sorted(r["id"] for r in df.filter("lower(text) LIKE 'may%' AND category = 'month'").collect())
    want = [i for i, (_, month) in enumerate(MAY) if month]
    assert months(detect.detect(w, may_context=True)) == months(detect.exact(w, may_context=True)) == months(detect.detect_in_text(t, may_context=True)) == want
    assert months(detect.detect(w)) == months(detect.detect_in_text(t)) == []


def test_long_conversation_in_linear_time(spark):
    """100,000 words, every third a term, in one conversation: by words and as text."""
    import time

    text = "new york city " * 20_000 + "hello Monday " * 20_000
    df = spark.createDataFrame([("x", text)], "id string, text string")
    began = time.time()
    assert detect.detect_in_text(df).count() == 40_000
    words = df.select("id", F.posexplode(F.split(F.trim("text"), " ")).alias("idx", "word")).selectExpr("id", "0 AS seg", "idx", "word", "double(idx) AS start_time", "double(idx + 1) AS end_time")
    assert detect.detect(words).count() == 40_000
    assert redact.redact_text(words, detect.detect(words)).select(F.length("redacted_text")).first()[0] == len("[CITY] " * 20_000 + "hello [DAY] " * 20_000) - 1
    assert time.time() - began < 90


def test_file_names(spark):
    rows = [("k1", "a"), ("k2", "a"), ("k3", "b/c"), ("k4", None), ("k5", ""), ("k6", ".x")]
    got = {r["key"]: r["name"] for r in trees.file_names(spark.createDataFrame(rows, "key string, conversation_id string"), ".json").collect()}
    assert got["k3"] == "b_c.json" and got["k6"] == "_x.json" and got["k1"] != got["k2"] and got["k1"].startswith("a~") and len(set(got.values())) == 6
