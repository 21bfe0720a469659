"""De-identified transcripts, findings, rendering, and the command lines for accuracy and results."""

import json

import pytest

from redactory.operators import detect, redact, regions, render, report, verify
from redactory.plans import accuracy, pipeline, show
from redactory.sources import files

KIND = f"id string, segments array<struct<text:string,start:double,end:double,words:array<{files.WORD}>>>"


def segment(text, start):
    words = [(w, start + k / 2, start + k / 2 + 0.4, 1.0) for k, w in enumerate(text.split())]
    return (f" {text} ", start, start + len(words) / 2, words)


@pytest.fixture(scope="module")
def talks(spark):
    rows = [("a", [segment("we left New", 0.0), segment("York on Monday", 2.0), ("", 9.0, 9.0, [])]), ("b", [segment("all well", 0.0)]), ("c", [])]
    return spark.createDataFrame(rows, KIND)


@pytest.mark.parametrize("original", [True, False])
def test_deidentified(talks, original):
    w = detect.words_of(talks)
    got = {r["conversation_id"]: r for r in redact.deidentified(w, detect.detect(w), talks, original).collect()}
    a = got["a"]
    label, date = (r["replacement"] for r in a["redactions"])
    assert a["redacted_text"] == f"we left {label} on {date} " and label in ("[CITY]", "[STATE]")
    assert [s["text"] for s in a["segments"]] == [f"we left {label}", f"on {date}", ""]
    assert [(s["start"], s["end"]) for s in a["segments"]] == [(0.0, 1.5), (2.0, 3.5), (9.0, 9.0)]
    place = a["segments"][0]["words"][-1]
    assert (place["word"], place["start"], place["end"]) == (label, 1.0, 2.4)  # from "New" to the end of "York"
    assert a["pii_count"] == 2 and [r["original"] for r in a["redactions"]] == (["New York", "Monday"] if original else [None, None])
    assert a["original_text"] == ("we left New York on Monday " if original else None)
    assert (got["b"]["redacted_text"], got["b"]["pii_count"], got["b"]["redactions"]) == ("all well", 0, [])
    assert (got["c"]["redacted_text"], got["c"]["segments"]) == ("", [])


def test_regions_hold_their_matches(spark):
    m = spark.createDataFrame([("a", 1.0, 1.2, "x", "month"), ("a", 1.3, 1.5, "y", "day"), ("a", 5.0, 5.2, "z", "day"), ("b", 1.0, 1.1, "q", "day")], "id string, start_time double, end_time double, text string, category string")
    wide = regions.padded(m, spark.createDataFrame([("a", 9.0), ("b", 9.0)], "id string, duration double"))
    got = regions.with_matches(regions.merged(wide), wide).orderBy("id", "start_time").collect()
    assert [[x["text"] for x in r["matches"]] for r in got] == [["x", "y"], ["z"], ["q"]] and [r["n_matches"] for r in got] == [2, 1, 1]


def test_findings(spark, talks):
    texts = spark.createDataFrame([("a", "on Monday in [CITY]"), ("b", "")], "id string, redacted_text string")
    got = {r["id"]: r for r in verify.findings(texts, detect.words_of(talks)).collect()}
    assert [(f["text"], f["category"], f["start"]) for f in got["a"]["text_pii_found"]][0] == ("Monday", "day", 3)
    assert [f["text"] for f in got["a"]["audio_pii_found"]] == ["New York", "Monday"] and got["b"]["text_pii_found"] == []
    assert verify.findings(texts).filter("id = 'a'").first()["audio_pii_found"] == []


def test_sizes(talks):
    got = {r["id"]: (r["n_segments"], r["n_words"]) for r in files.sizes(talks.selectExpr("*", "1.0D AS audio_duration")).collect()}
    assert got == {"a": (3, 6), "b": (1, 2), "c": (0, 0)}


def test_render(spark):
    totals = spark.createDataFrame([(2, 1, 1, 3)], "total_conversations int, successful int, failed int, total_pii_redacted int")
    statuses = spark.createDataFrame([("PASS", 4), ("FAIL", 8), ("REVIEW_REQUIRED", 0)], "status string, n int")
    times = spark.createDataFrame([("a", 1.0), ("b" * 40, 4.0)], "conversation_id string, processing_time_s double")
    failed = spark.createDataFrame([("b", "transcription", "x" * 90), ("a", "detection", None)], "conversation_id string, stage string, error string")
    text = render.report_text(totals, statuses, times, failed)
    lines = text.split("\n")
    assert "  1  failed" in lines and "  3  total pii redacted" in lines and "  5.0 in all, 2.5 on average, 4.0 at most" in lines
    at = lines.index("[status]")
    assert lines[at + 1 : at + 4] == ["  8  FAIL  " + "█" * 40, "  4  PASS  " + "█" * 20, "  0  REVIEW_REQUIRED  "]
    assert "b" * 30 in text and "b" * 31 not in text and "x" * 60 in text and "x" * 61 not in text
    assert lines[lines.index("[failures]") + 1 :] == ["  detection  a  -", "  transcription  b  " + "x" * 60]
    assert render.report_text(totals, statuses, times, failed, 1).count("and 1 more") == 2 and "and 2 more" in render.report_text(totals, statuses, times, failed, 1)
    assert render.report_text(*(d.limit(0) for d in (totals, statuses, times, failed))).count("(no data)") == 3
    assert render.percent(float("inf")) == "inf" and render.percent(0.25) == "25.00%"


def test_render_transcripts(spark):
    found = [("Monday", "[DAY]", "day")] * 11 + [(None, "[CITY]", "city")]
    rows = [("a", "o" * 300, None, 12, found), (None, "plain", "plain", 0, []), ("c", None, "x", None, None)]
    got = render.transcript_texts(spark.createDataFrame(rows, show.DEIDENTIFIED))
    shown = {r["conversation_id"]: r["shown"].split("\n") for r in got.collect()}
    assert shown["a"][:3] == ["[a] 12 found", "   1  city", "   11  day"] and shown["a"].count("    [DAY] for Monday") == 10 and "    and 2 more" in shown["a"]
    assert shown["a"][-2:] == ["  before: " + "o" * 200, "  after: -"]
    assert shown[None] == ["[-] 0 found", "  before: plain", "  after: plain"] and shown["c"][0] == "[c] 0 found"


def test_accuracy(spark, tmp_path, capsys):
    asr, human = tmp_path / "asr", tmp_path / "human"
    asr.mkdir(), human.mkdir()
    say = {"x": ("the cat sat", "the cat sat down"), "y": ("one two", "one too"), "z": ("alone", None)}
    for name, (ref, hyp) in say.items():
        (human / f"{name}.txt").write_text(f"[0.00] {ref}")
        if hyp:
            (asr / f"{name}.json").write_text(json.dumps({"segments": [{"text": hyp, "start": 0.0, "end": 1.0, "words": []}]}))
    out = str(tmp_path / "out")
    assert accuracy.main(["--asr-dir", str(asr), "--human-dir", str(human), "--output", out]) == 0
    told = capsys.readouterr().out
    assert "Files analyzed: 2" in told and "Aggregate WER: 40.00%" in told and "Total errors: 2" in told
    rows = {r["conversation_id"]: r for r in spark.read.json(f"{out}/individual").collect()}
    assert (rows["x"]["insertions"], rows["y"]["substitutions"]) == (1, 1)
    assert spark.read.json(f"{out}/totals").first()["total_reference_words"] == 5
    whole = json.loads((tmp_path / "out/results.json").read_text())
    assert whole["files_analyzed"] == 2 and whole["aggregate_wer"] == 0.4 and [r["conversation_id"] for r in whole["individual_results"]] == ["x", "y"]
    assert accuracy.main(["--asr", str(asr / "y.json"), "--human", str(human / "x.txt")]) == 0  # of different names
    told = capsys.readouterr().out
    assert "WER ANALYSIS: y" in told and "Reference words: 3" in told and "errors:" in told
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "q.txt").write_text("q")
    assert accuracy.main(["--asr-dir", str(asr), "--human-dir", str(empty)]) == 1
    assert accuracy.main(["--asr-dir", str(tmp_path / "none"), "--human-dir", str(empty)]) == 1 and "not found" in capsys.readouterr().out


def test_show_reads_what_the_chain_writes(spark, tmp_path, capsys):
    talk = tmp_path / "t.json"
    talk.write_text(json.dumps({"conversation_id": "t", "audio_duration": 2.0, "segments": [{"text": "on Monday", "start": 0.0, "end": 1.0, "words": [{"word": "on", "start": 0.0, "end": 0.4}, {"word": "Monday", "start": 0.5, "end": 0.9}]}]}))
    out = str(tmp_path / "out")
    assert pipeline.main(["--file", str(talk), "--output", out, "--verbose"]) == 0
    capsys.readouterr()
    told = {}
    for way in ("report", "results"):
        source = f"{out}/qa/processing_report" if way == "report" else f"{out}/qa/results"
        assert show.main([f"--{way}", source, "--transcripts", f"{out}/transcripts_deid", "--output", str(tmp_path / "texts")]) == 0
        told[way] = capsys.readouterr().out
        assert "1  total pii redacted" in told[way] and "[t] 1 found" in told[way] and "before: on Monday" in told[way] and "after: on [DAY]" in told[way]
    assert told["report"] == told["results"] and spark.read.text(str(tmp_path / "texts")).count() == 5
    assert pipeline.main(["--file", str(tmp_path / "none.wav"), "--output", out, "--model", "fake_speech:model"]) == 1


def test_first_redactions(spark):
    kind = "id string, original_text string, redacted_text string, redactions array<struct<original:string,replacement:string>>"
    rows = [("a", "o" * 250, "r" * 250, [("x", "[DAY]")] * 13), ("b", "s", "t", []), ("c", None, None, [("y", "[CITY]")] * 10)]
    got = {r["id"]: r for r in report.first_redactions(spark.createDataFrame(rows, kind)).collect()}
    assert [(len(got[k]["shown"]), got[k]["more"]) for k in "abc"] == [(10, 3), (0, 0), (10, 0)]
    assert (got["a"]["original"], got["a"]["redacted"], got["b"]["original"], got["c"]["original"]) == ("o" * 200, "r" * 200, "s", None)


def test_bars(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 5), ("c", 0), ("d", 10)], "category string, n int")
    drawn = report.ranked_bars(counts, "category", "n").orderBy("place").collect()
    assert [(r["label"], len(r["bar"]), r["place"]) for r in drawn] == [("a", 50, 1), ("d", 50, 2), ("b", 25, 3), ("c", 0, 4)]
    assert [len(r["bar"]) for r in report.bars(counts.filter("n = 0"), "category", "n").collect()] == [0]
    assert report.rendered([], "t").endswith("(no data)")
