"""The shared step of the carrier's queries: dealt by the number of line items, what is asked for made in one function."""

import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_spans import plan, tables  # noqa: F401
from test_talks import segments  # noqa: F401

from redactory.functions import phrases
from redactory.operators import detect, redact, talks
from redactory.operators.talks import gathered, matched
from redactory.plans import queries as q

FOUND = ["months_said", "redacted_text", "fuzzy_matches", "exact_matches", "verify_text_status", "qa_summary", "detect_all"]


@pytest.mark.parametrize("name", FOUND)
def test_tasks_grow_with_the_line_items(spark, tables, name, monkeypatch):  # noqa: F811
    """400 line items at 40 a task; none is sorted to be joined, whatever the number of shuffle partitions."""
    monkeypatch.setattr(talks, "A_TASK", 40)
    monkeypatch.setattr(q, "MANY_PARTS", 10)
    df = q.QUERIES[name](spark, tables)
    p = plan(df)
    for key in ("l_orderkey", "l_partkey"):
        assert any(f"hashpartitioning({key}" in x and ", 10), REPARTITION_BY_NUM" in x for x in p.splitlines()), p
    assert "Sort [p_name" in p and "ShuffledHashJoin" in p and "SortMergeJoin" not in p and df.count() > 0, p


@pytest.mark.parametrize("name", FOUND)
def test_words_stay_in_the_function(spark, tables, name):  # noqa: F811
    p = plan(q.QUERIES[name](spark, tables))
    made = [x for x in p.splitlines() if "MapInArrow" in x]
    assert len(made) == 1 and "EvalPython" not in p and not any("words" in x.replace("n_words", "") or "said#" in x or "spans#" in x.replace("n_spans", "") for x in made), p


@pytest.mark.parametrize("how", [{}, {"may_context": True}, {"misspelt": False}])
def test_matched_are_the_matches_of_rows(segments, how):  # noqa: F811
    step = segments[0], F.col("text"), "talk", ["seg"]
    want = detect.matches_of(gathered(*step, ("words", "spans"), **how)).select(detect.MATCH).collect()
    told = lambda rows: sorted(map(repr, rows))
    assert told(matched(*step, **how).collect()) == told(want) and len(want) > 20
    assert told(matched(*step, category="city", **how).collect()) == told(r for r in want if r["category"] == "city")
    assert told(matched(*step, fuzzy=True, **how).collect()) == told(r for r in want if r["is_fuzzy"])
    assert told(matched(*step, category="month", fuzzy=False, n_rows=1, **how).collect()) == told(r for r in want if r["category"] == "month" and not r["is_fuzzy"])


def test_texts_ends_and_counts_are_those_of_words(segments):  # noqa: F811
    kinds = ("said", "words", "spans", "n_spans", "end", "original_text", "redacted_text", "text_found")
    t = gathered(segments[0], F.col("text"), "talk", ["seg"], kinds)
    for r in t.withColumn("masked", redact.masked_segments(F.col("said"), F.col("spans"))).collect():
        assert r["n_spans"] == len(r["spans"]) and r["end"] == max(w["end_time"] for w in r["words"])
        assert r["original_text"] == " ".join(w["word"] for w in r["words"]) and r["redacted_text"] == " ".join(r["masked"])
        assert r["text_found"] == len([x for x in phrases.find(r["redacted_text"]) if x[0][0] != "["])


def test_months_look_at_no_more_than_their_neighbours():
    rng = random.Random(9)
    for _ in range(3000):
        ws = rng.choices(["may", "May's", "in", "", None, "3rd", "of", "2024", "until", "incomprehensibilities", "a"], k=rng.randint(1, 40))
        for at in (k for k, w in enumerate(ws) if w and w[0] in "mM"):
            first, end = rng.randint(0, at), rng.randint(at + 1, len(ws))
            read, side = [], lambda a, b: " ".join(w for w in ws[a:b] if w is not None)
            before = side(max(first, at - detect.AROUND - 1), at) + " " if at > first else ""
            text = before + side(at, min(end, at + detect.AROUND + 2))
            assert detect._said_month(lambda k: read.append(k) or ws[k], at, first, end) == detect.speaks_of_month(text, len(before), len(before) + 3), (ws, at)
            assert len(read) < 45 and (None in ws or "" in ws or len(read) <= 24)


def test_leaks_are_what_text_mode_finds():
    rng = random.Random(2)
    some = ["Red", "reſ", "teXas", "İ", "[CITY]", "new york", "new  york", "york", "predict", "blue_", "blue/green", "-", "\n", "café", "in May"]
    texts = [None, "", *(rng.choice([" ", "", "."]).join(rng.choices(some, k=rng.randint(1, 6))) for _ in range(3000))]
    assert phrases.leaks(pa.array(texts)).to_pylist() == [len([x for x in phrases.find(t) if not x[0].startswith("[") and not x[0].endswith("]")]) for t in texts]


@pytest.mark.parametrize("at_once", [1, 3, 8])
def test_no_conversation_is_cut(monkeypatch, at_once):
    monkeypatch.setattr(talks, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    ids = sorted((rng.choice([None, *range(9)]) for _ in range(60)), key=lambda x: -1 if x is None else x)
    b = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([str(k) for k in range(60)])], ["id", "text"])
    cuts = [0, *sorted(rng.choices(range(60), k=12)), 60]
    got = list(talks._whole(b.slice(x, y - x) for x, y in zip(cuts, cuts[1:], strict=False)))
    assert [t for g in got for t in g["text"].to_pylist()] == b["text"].to_pylist() and len(got) > 1
    seen = [set(g["id"].to_pylist()) for g in got]
    assert sum(map(len, seen)) == len(set(ids))


@pytest.mark.parametrize("many", [0, 1000])
def test_line_items_keep_their_order_and_dates(spark, tmp_path, monkeypatch, many):
    """As the carrier has them: lines and days that are null, negative, equal or far away, and hours."""
    monkeypatch.setattr(q, "MANY_PARTS", many)
    rng = random.Random(4)
    day = lambda: rng.choice([None, datetime.datetime(1, 1, 2), datetime.datetime(1969, 12, 31, 23), datetime.datetime(2024, 2, 29, 5), datetime.datetime(9999, 12, 30)])
    rows = [(rng.randint(1, 9), rng.choice([None, -(1 << 31), -1, 0, 7, (1 << 31) - 1]), rng.randint(1, 3), rng.randint(1, 2), day()) for _ in range(200)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "one"), (2, None), (3, "three thing")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    want = {}
    for r in q.carrier(spark, str(tmp_path)).orderBy("id", "seg").collect():
        want.setdefault(r["id"], []).append(r["text"] or "")
    assert {r["id"]: r["texts"] for r in q.talks(spark, str(tmp_path)).collect()} == want


def nodes(plan):
    """Of a plan that has been run, with what its stages ran."""
    yield plan
    name = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else []
    below = plan.children()
    for p in [*inner, *(below.apply(k) for k in range(below.size()))]:
        yield from nodes(p)


def test_what_is_shuffled_grows_no_faster_than_the_line_items(spark, tmp_path, monkeypatch):
    """Of each of the three, dealt by part as many parts are: as many bytes a line item at 4 times, and nothing is spilled."""
    monkeypatch.setattr(talks, "A_TASK", 2500)
    monkeypatch.setattr(q, "MANY_PARTS", 10)
    for size in (1, 4):
        n = 20_000 * size
        spark.range(n).selectExpr("hash(id) & 262143 AS l_orderkey", "cast(id % 4 AS int) AS l_linenumber", f"pmod(hash(id, 1), {n // 30}) AS l_partkey", "pmod(hash(id, 2), 1000L) AS l_suppkey", "timestamp'2024-05-01' + make_dt_interval(pmod(hash(id, 3), 900)) AS l_shipdate").write.parquet(f"{tmp_path}/{size}/lineitem.parquet")
        spark.range(n // 30).selectExpr("id AS p_partkey", "concat('part ', hash(id) & 63) AS p_name").write.parquet(f"{tmp_path}/{size}/part.parquet")
    for name in ("fuzzy_matches", "exact_matches", "verify_text_status"):
        a_line = {}
        for size in (1, 4):
            df = q.QUERIES[name](spark, f"{tmp_path}/{size}")
            assert df.collect()
            ran = list(nodes(df._jdf.queryExecution().executedPlan()))
            told = lambda metric: sum(p.metrics().apply(metric).value() for p in ran if p.metrics().contains(metric))  # noqa: E731, B023
            a_line[size] = told("shuffleBytesWritten") / (20_000 * size)
            assert told("spillSize") == 0
        assert 0 < a_line[4] <= 1.1 * a_line[1] and a_line[4] < 60, (name, a_line)
