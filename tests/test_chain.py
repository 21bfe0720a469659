import numpy as np
import pytest

from redactory.operators import audio, detect, redact, regions, report, verify, wer
from redactory.plans.pipeline import redact_transcripts


def words(spark, texts):
    rows = []
    for i, segs in texts.items():
        n = 0
        for s, text in enumerate(segs):
            for w in text.split():
                rows.append((i, s, n, w, n * 0.4, n * 0.4 + 0.3))
                n += 1
    return spark.createDataFrame(rows, "id string, seg int, idx int, word string, start_time double, end_time double")


CASES = {
    "I visited New York City on Monday": [("New York City", "city"), ("Monday", "day")], "Houston, Texas": [("Houston,", "city"), ("Texas", "state")], "new york": [("new york", "city")],
    "West Virginia Beach": [("West Virginia", "state"), ("Beach", "color")], "Huston": [("Huston", "city")], "Munday": [("Munday", "day")], "marland": [("marland", "state")], "monday's,": [("monday's,", "day")],
    "(houston)": [("(houston)", "city")], "monday-friday": [], "remember salon round back like": [], "plate": [("plate", "color")], "May": [],
}


def test_detect(spark):
    w = words(spark, {t: [t] for t in CASES})
    got = {t: [] for t in CASES}
    for r in detect.detect(w).orderBy("id", "word_idx").collect():
        got[r["id"]].append((r["text"], r["category"]))
    assert got == CASES


def test_detect_in_text(spark):
    t = ["West Virginia Beach", "It was Monday", "Red, green, and blue are primary colors", "monday-friday", "", "You may proceed", "HoUsToN"]
    got = {x: [] for x in t}
    for r in detect.detect_in_text(spark.createDataFrame([(x, x) for x in t], "id string, text string")).orderBy("id", "start").collect():
        got[r["id"]].append((r["text"], r["category"], r["start"], r["end"]))
    assert got["West Virginia Beach"] == [("Virginia Beach", "city", 5, 19)]
    assert [len(got[x]) for x in t] == [1, 1, 3, 2, 0, 0, 1]


def test_redact_across_segments(spark):
    w = words(spark, {"a": ["I love New", "York pizza"]})
    m = detect.detect(w)
    assert redact.redact_text(w, m).first()["redacted_text"] == "I love [CITY] pizza"
    log = redact.redaction_log(m, include_original=False).collect()
    assert [(r["replacement"], r["original"]) for r in log] == [("[CITY]", None)]


@pytest.mark.parametrize("spans,out", [([(0.05, 0.10)], [(0.0, 0.25, 0.4)]), ([(1.0, 1.2), (1.5, 1.7)], [(0.85, 1.85, 1.0)]), ([(1.0, 1.2), (3.0, 3.2)], [(0.85, 1.35, 0.5), (2.85, 3.35, 0.5)])])
def test_regions(spark, spans, out):
    m = spark.createDataFrame([("a", *s) for s in spans], "id string, start_time double, end_time double")
    got = regions.bleep_regions(m, spark.createDataFrame([("a", 10.0)], "id string, duration double")).orderBy("start_time").collect()
    assert [tuple(round(r[c], 6) for c in ("start_time", "end_time", "bleep_duration")) for r in got] == out


def test_tone_and_mask():
    t = audio.tone(0.4)
    assert len(t) == 6400 and t.dtype == np.float32 and 0.45 <= abs(t).max() <= 0.55
    rate, x = audio.decode(audio.encode(np.ones(16000, np.float32) * 0.25, 16000))
    y = audio.masked(x, rate, [(0.1, 0.3, 0.4)])
    assert rate == 16000 and np.array_equal(y[:1600], x[:1600]) and np.array_equal(y[4800:], x[4800:]) and abs(y[1600:4800]).max() > 0.4


def test_status(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 2), (3, 3), (2, 0)], "n int, s int")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(verify.status(F.col("n"), F.col("s"))).collect()] == ["PASS", "REVIEW_REQUIRED", "REVIEW_REQUIRED", "FAIL", "PASS_WITH_NOTE"]


def test_wer(spark):
    df = spark.createDataFrame([("I visited Houston Texas on Monday", "I visited Huston Texas on Munday"), ("", ""), ("", "two words")], "reference string, hypothesis string")
    got = wer.wer(df)
    assert [(r["substitutions"], r["insertions"], r["deletions"], round(r["wer"], 4)) for r in got.collect()] == [(2, 0, 0, 0.3333), (0, 0, 0, 0.0), (0, 2, 0, float("inf"))]
    b = wer.batch(got).first()
    assert (round(b["aggregate_wer"], 4), round(b["mean_wer"], 4), b["reference_words"]) == (0.6667, 0.3333, 6)


def test_chain(spark):
    word = lambda w, t: (w, t, t + 0.3, 1.0)
    seg = [("See Houston", 0.0, 1.0, [word("See", 0.0), word("Houston", 0.5)]), ("", 1.0, 1.0, [])]
    kind = "id string, segments array<struct<text:string,start:double,end:double,words:array<struct<word:string,start:double,end:double,confidence:double>>>>, audio_duration double, error string"
    got = redact_transcripts(spark.createDataFrame([("a", seg, 2.0, None), ("b", None, None, "no codec")], kind))
    assert {r["conversation_id"]: (r["success"], r["pii_count"], r["status"]) for r in got.results.collect()} == {"a": (True, 1, "PASS"), "b": (False, 0, None)}
    assert got.redacted.first()["redacted_text"] == "See [CITY] "
    assert report.summary(got.results).first()["failed"] == 1
    assert report.qa_report(got.results, "t").first()["verification_status"]["PASS"] == 1
