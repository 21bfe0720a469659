"""Conversations gathered from segments, and regions merged in their rows, against brute force and the operators of words."""

import random

import pytest
from pyspark.sql import functions as F
from test_spans import ODD, plan, tables  # noqa: F401

from redactory.operators import detect, regions, report
from redactory.operators.talks import gathered
from redactory.plans import queries as q


@pytest.fixture(scope="module")
def segments(spark):
    rng = random.Random(3)
    talk = lambda k: None if k == 7 else k
    rows = [(talk(k), s, rng.choice([None, "", " ", " ".join(w for w in rng.choices(ODD, k=rng.randint(1, 9)) if w)])) for k in range(60) for s in range(rng.choice([1, 2, 9]))]
    rows += [(99, s, f"New{' ' * (s % 3)}") for s in range(40)] + [(100, 0, None), (101, 0, "  ")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "talk long, seg int, text string").repartition(3), rows


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_a_conversation_is_one_row_however_its_segments_are_cut(spark, segments, batch):
    df, rows = segments
    want = {}
    for talk, _, text in sorted(rows, key=lambda r: r[1]):
        want.setdefault(talk, []).append(text or "")
    want = {k: (ts, [ws for t in ts if (ws := [w for w in t.split(" ") if w])]) for k, ts in want.items()}
    want = {k: v for k, v in want.items() if v[1]}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = gathered(df, F.col("text"), "talk", ["seg"], ("texts", "said", "words")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want) and {r["id"]: (r["texts"], r["said"]) for r in got} == want
    for r in got:
        flat = [w for ws in r["said"] for w in ws]
        assert [tuple(w) for w in r["words"]] == [(w, k * 0.5, k * 0.5 + len(w) * 0.0625) for k, w in enumerate(flat)]


@pytest.mark.parametrize("how", [{}, {"may_context": True}, {"misspelt": False}])
def test_spans_of_gathered_segments_are_those_of_rows(segments, how):
    got = gathered(segments[0], F.col("text"), "talk", ["seg"], ("said", "spans"), **how)
    got = got.withColumn("again", detect.spans(F.flatten("said"), **how)).collect()
    assert all(r["spans"] == r["again"] for r in got) and sum(len(r["spans"]) for r in got) > 20


def test_regions_in_rows_are_those_of_matches(spark):
    rng = random.Random(5)

    def word():
        start = None if rng.random() < 0.03 else rng.choice([round(rng.random() * 20, 1), rng.random() * 20])
        return "w", start, None if rng.random() < 0.03 else (start or 0.0) + rng.choice([-1.0, 0.0, 0.1, rng.random()])

    rows = []
    for k in range(150):
        words = [word() for _ in range(rng.choice([1, 3, 12]))]
        spans = [(i, min(rng.choice([1, 1, 2]), len(words) - i), "city", 1.0, False) for i in range(len(words)) if rng.random() < 0.6]
        rows.append((k, words, spans, rng.choice([5.0, 21.0])))
    t = spark.createDataFrame(rows, f"id int, words array<struct<word:string,start_time:double,end_time:double>>, spans {detect.SPANS}, duration double").repartition(3)
    want = regions.bleep_regions(detect.matches_of(t), t.select("id", "duration"))
    got = regions.of_talks(t)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in want.schema}
    told = lambda df: sorted(tuple(r[c] for c in want.columns) for r in df.collect())
    assert told(got) == told(want) and got.count() > 100


def test_counts_are_compared_in_one_pass(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("a", False), ("b", True), ("c", False)], "k string, f boolean")
    n = lambda c: df.filter(c).groupBy("k").agg(F.count("*").alias("value")).withColumnRenamed("k", "metric")
    got = report.counts_compared(df, "k", F.col("f"))
    assert sorted(got.collect()) == sorted(report.compared(n("f"), n("NOT f")).select(got.columns).collect()) == [("a", 1, 2, 1), ("b", 1, 0, -1), ("c", 0, 1, 1)]


SHARED = ["exact_category_counts", "months_said", "redacted_text", "fuzzy_matches", "exact_matches", "verify_text_status", "qa_summary", "status_counts", "region_samples", "bleep_regions", "manifest", "before_after", "conversation_counts", "detect_all", "redaction_log"]


@pytest.mark.parametrize("name", SHARED)
def test_line_items_are_dealt_once_as_they_are(spark, tables, name):  # noqa: F811
    """One exchange by order of the fields a text is made of, sorted there; no lists are collected, and neither matches nor
    regions are shuffled or sorted."""
    p = plan(q.QUERIES[name](spark, tables))
    assert "collect_list" not in p and "Window" not in p, p
    assert p.count("Exchange hashpartitioning(l_orderkey") == 1 and p.count("Sort [l_orderkey") == 1, p
    assert not any("Exchange hashpartitioning(id" in x or "Sort [id" in x for x in p.splitlines()), p
