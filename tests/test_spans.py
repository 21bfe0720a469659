"""Matches, masking and verdicts of conversations that are rows, against the same found word by word."""

import random

import pytest
from pyspark.sql import functions as F

from redactory.functions.text import normalize_word, normalized
from redactory.operators import detect, redact, report, verify
from redactory.plans import queries as q

ODD = ["Monday's", "may's.", "Reds", "'Blue'", "New", "york", "York's,", "new", "mexico.", "San", "antonio", "May", "may", "in", "3rd", "of", "Huston", "Philadelfia", "Chigago\n", "red\r\n", "it's ", "", "''", "Texas\x85", "İstanbul", "grays", "los", "Los", "angeles", "plain", "salt", "lake", "city", None]


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(7)
    rows = [(f"c{k}", [[rng.choice(ODD) for _ in range(rng.choice([0, 1, 2, 9]))] for _ in range(rng.randint(1, 5))]) for k in range(120)]
    t = spark.createDataFrame(rows, "id string, said array<array<string>>").repartition(3)
    return q.timed(t).filter(F.size("words") > 0)


def words_in(talks):
    w = talks.select("id", F.posexplode("said").alias("seg", "ws")).select("id", "seg", F.posexplode("ws").alias("pos", "word"))
    idx = F.row_number().over(detect.W.partitionBy("id").orderBy("seg", "pos")) - 1
    w = w.withColumn("idx", idx).withColumn("start_time", F.col("idx") * 0.5)
    return w.withColumn("end_time", F.col("start_time") + F.length("word") * 0.0625)


def test_normal_forms_are_those_of_the_column_function(spark):
    df = spark.createDataFrame([(w,) for w in ODD], "w string")
    for r in df.select("w", normalize_word(F.col("w")).alias("n")).collect():
        assert normalized(r["w"]) == r["n"], repr(r["w"])


@pytest.mark.parametrize(("may", "misspelt"), [(False, True), (True, True), (True, False)])
def test_spans_are_the_matches_of_words(talks, may, misspelt):
    rows = lambda df: sorted(map(repr, df.select(detect.MATCH).collect()))
    w = words_in(talks)
    want = rows(detect.detect(w, may) if misspelt else detect.exact(w, may))
    got = rows(detect.matches_of(talks.withColumn("spans", detect.spans(F.flatten("said"), may, misspelt=misspelt))))
    assert got == want and len(want) > 50


def test_masked_segments_are_the_redacted_words(talks):
    w = words_in(talks)
    want = {r["id"]: [s["text"] for s in r["segments"]] for r in redact.redact_text(w, detect.detect(w)).collect()}
    t = talks.withColumn("spans", detect.spans(F.flatten("said")))
    got = t.select("id", redact.masked_segments(F.col("said"), F.col("spans")).alias("m"), F.transform("said", lambda x: F.size(x) > 0).alias("some")).collect()
    assert {r["id"]: [m for m, some in zip(r["m"], r["some"], strict=True) if some] for r in got} == want


def test_first_spans_counts_the_rest(talks):
    t = talks.withColumn("spans", detect.spans(F.flatten("said")))
    for r in report.first_spans(t, 2).join(t.select("id", "spans"), "id").collect():
        assert len(r["shown"]) == min(2, len(r["spans"])) and r["more"] == max(0, len(r["spans"]) - 2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.range(400).selectExpr("id DIV 4 AS l_orderkey", "cast(id % 4 AS int) AS l_linenumber", "id % 50 AS l_partkey", "id AS l_suppkey", "timestamp'2024-05-01' AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.range(50).selectExpr("id AS p_partkey", "concat('red part', id) AS p_name").write.parquet(f"{d}/part.parquet")
    return d


@pytest.mark.parametrize("name", ["exact_matches", "exact_category_counts", "fuzzy_matches", "detect_all", "redacted_text", "redaction_log", "verify_text_status", "manifest", "qa_summary", "category_bars", "months_said", "topk_redactions", "processing_times", "status_counts", "before_after", "conversation_counts", "match_places"])
def test_words_are_neither_shuffled_nor_sorted(spark, tables, name):
    """Line items are grouped once; no window, and no exchange by anything that was made of their texts."""
    df = q.QUERIES[name](spark, tables)
    p = plan(df)
    dealt = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert "Window" not in p and not any("idx" in line or "seg" in line for line in dealt), p
    assert all("l_orderkey" in x or "l_partkey" in x or "category" in x or "metric" in x or "status" in x for x in dealt), dealt
    assert df.count() > 0


def test_verdicts_need_no_join(spark):
    told = spark.createDataFrame([("a", "I live in [CITY] or Boston"), ("b", ""), ("c", "Monday Tuesday Friday")], "id string, redacted_text string")
    df = verify.verify_text(told)
    assert "Join" not in plan(df) and {(r["id"], r["text_found"], r["text_status"]) for r in df.collect()} == {("a", 1, "REVIEW_REQUIRED"), ("b", 0, "PASS"), ("c", 3, "FAIL")}


def test_paired_words_are_cleaned_before_they_are_shuffled(spark):
    from redactory.sources.files import pair_by_stem

    asr = spark.createDataFrame([("a", [{"text": "Hello, there"}], None, None)], "id string, segments array<struct<text:string>>, redacted_text string, text string")
    df = pair_by_stem(asr, spark.createDataFrame([("a", "x", "Hello there!")], "id string, path string, text string"))
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "hypothesis" in lines[next(k for k, x in enumerate(lines) if "Join" in x) + 1] and df.first()[1:] == ("hello there", "hello there")


def test_the_chain_ends_each_row_in_place(spark, tables):
    """One join, with the parts; none of words, matches, texts or verdicts."""
    df = q.chain_results(spark, tables)
    p = plan(df)
    assert p.count("Join") == 1 and "Window" not in p, p
    assert df.filter("success AND pii_count > 0 AND redacted_text LIKE '%[COLOR]%'").count() == 100
