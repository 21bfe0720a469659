"""Rounding and sums that do not depend on partitions, running numbers, alignment of long texts, near terms."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from redactory.functions import exact, lexicon, phrases, spelling
from redactory.functions import text as T
from redactory.operators import report, wer
from redactory.operators.detect import words_of
from redactory.operators.ordinal import numbered
from redactory.sources.files import pair_by_stem


def test_round1(spark):
    rng = random.Random(4)
    xs = [0.05, 0.15, 0.25, 0.35, 2.25, 2.675, -0.05, -0.25, -2.25, 0.0, 0.45, 0.95, 1e15 + 0.3, 4503599627370495.5, 1e300, -1e18, float("inf"), 5e-324, 303.68, 303.65, 303.75, 0.5 - 2**-54]
    xs += [rng.uniform(-1e4, 1e4) for _ in range(3000)] + [round(rng.uniform(0, 1e5), 2) for _ in range(3000)] + [k / 20 for k in range(-2001, 2001)] + [math.nextafter(k / 20, d) for k in range(1, 999, 2) for d in (0, 9e9)]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double").select("i", exact.round1(F.col("x")).alias("r")).orderBy("i").collect()
    assert [(x, r["r"]) for x, r in zip(xs, got) if r["r"] != (round(x, 1) if math.isfinite(x) else x)] == []
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS x").select(exact.round1(F.col("x"))).first()[0] is None


def test_exact_sum(spark):
    rng = random.Random(6)
    xs = [rng.choice((1, -1)) * rng.random() * 10 ** rng.randint(-9, 15) for _ in range(5000)] + [0.1] * 3000 + [1e16, 1.0, -1e16, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    sums = {df.repartition(n).agg(exact.exact_sum(F.col("x"))).first()[0] for n in (1, 3, 7)} | {df.orderBy("x").agg(exact.exact_sum(F.col("x"))).first()[0]}
    want = math.fsum(x for x in xs if x is not None)
    assert len(sums) == 1 and abs(sums.pop() - want) <= 2 * math.ulp(want)
    assert df.limit(0).agg(exact.exact_sum(F.col("x"))).first()[0] is None
    assert spark.createDataFrame([(1.5,), (float("inf"),)], "x double").agg(exact.exact_sum(F.col("x"))).first()[0] == float("inf")
    few = {"a": [0.1, 0.2], "b": [2.0**80, 1.0, -(2.0**80)], "c": [-0.5, 0.25]}
    got = spark.createDataFrame([(k, x) for k, xs in few.items() for x in xs], "k string, x double").groupBy("k").agg(exact.exact_sum(F.col("x")).alias("s")).collect()
    assert {r["k"]: r["s"] for r in got} == {k: math.fsum(xs) for k, xs in few.items()}


def test_totals_do_not_depend_on_partitions(spark):
    rng = random.Random(8)
    rows = [(str(i), True, None, None, 1, "PASS", rng.uniform(0, 400), rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "conversation_id string, success boolean, stage string, error string, pii_count int, status string, duration double, processing_time_s double")
    for f in (report.summary, report.times):
        assert len({tuple(f(df.repartition(n)).first()) for n in (1, 5)}) == 1
    assert report.summary(df).first()["total_duration_sec"] == round(math.fsum(r[6] for r in rows), 1)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_numbered(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice("abc") * rng.randint(0, 3), rng.randint(0, 30), i) for i in range(500)] + [(None, 1, 500), (None, None, 501)]
    got = numbered(spark.createDataFrame(rows, "a string, b int, c int").repartition(7), ["a", "b", "c"], ranges).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2]))
    assert [tuple(r[c] for c in "abc") for r in sorted(got, key=lambda r: r["ordinal"])] == want
    assert [r["ordinal"] for r in sorted(got, key=lambda r: r["ordinal"])] == list(range(1, 503)) and {r["total"] for r in got} == {502}
    assert numbered(spark.createDataFrame([], "a string"), ["a"]).count() == 0


def plain(ref, hyp):
    """The full matrix, then back from its end: a match, else the cheapest of substitution, insertion, deletion, in that order."""
    cost = [[i + j for j in range(len(hyp) + 1)] for i in range(len(ref) + 1)]
    for i in range(1, len(ref) + 1):
        for j in range(1, len(hyp) + 1):
            cost[i][j] = cost[i - 1][j - 1] if ref[i - 1] == hyp[j - 1] else 1 + min(cost[i - 1][j - 1], cost[i][j - 1], cost[i - 1][j])
    i, j, pairs, n = len(ref), len(hyp), [], [0, 0, 0]
    while i or j:
        if i and j and ref[i - 1] == hyp[j - 1]:
            step = None
        elif not i or not j:
            step = 1 if j else 2
        else:
            step = min(range(3), key=lambda k: (cost[i - 1][j - 1], cost[i][j - 1], cost[i - 1][j])[k])
        i, j = i - (step != 1), j - (step != 2)
        pairs.append({"ref": ref[i] if step != 1 else None, "hyp": hyp[j] if step != 2 else None})
        if step is not None:
            n[step] += 1
    return (*n, pairs[::-1])


@pytest.mark.parametrize("rows", [1, 3, 256])
def test_alignment_against_the_full_matrix(rows, monkeypatch):
    monkeypatch.setattr(wer, "ROWS", rows)
    rng, refs, hyps = random.Random(rows), [], []
    for _ in range(1200):
        letters = "abcdefgh"[: rng.choice((1, 2, 3, 8))]
        refs.append([rng.choice(letters) for _ in range(rng.choice((0, 1, 5, 12, 70)))])
        hyps.append([rng.choice(letters) for _ in range(rng.choice((0, 1, 5, 12, 63, 64, 70)))])
    got = wer.counted(pa.array(refs, pa.list_(pa.string())), pa.array(hyps, pa.list_(pa.string())))
    for r, h, counts in zip(refs, hyps, got.tolist()):
        want = plain(r, h)
        assert tuple(counts) == want[:3] and (len(r) + len(h) > 40 and rows < 256 or wer.align(r, h) == want)
    assert wer.counted(pa.array([], pa.list_(pa.string())), pa.array([], pa.list_(pa.string()))).shape == (0, 3)


def test_alignment_of_long_texts():
    """20,000 words: far beyond what a matrix of cells could hold in the memory that this takes."""
    import tracemalloc

    rng = random.Random(3)
    ref = [f"w{rng.randrange(4000)}" for _ in range(20_000)]
    hyp = [w if rng.random() > 0.1 else "other" for w in ref if rng.random() > 0.05]
    tracemalloc.start()
    s, i, d, pairs = wer.align(ref, hyp)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 << 20 and len(pairs) == len(ref) + i and len(ref) - d + i == len(hyp)
    assert [p["ref"] for p in pairs if p["ref"] is not None] == ref and [p["hyp"] for p in pairs if p["hyp"] is not None] == hyp
    assert s == sum(p["ref"] != p["hyp"] and None not in p.values() for p in pairs)


def test_near_terms_against_all_terms():
    rng = random.Random(9)
    words = {w for w, _ in spelling.TERMS} | {"remember", "plate", "match", "x" * 40, "", "abcde"}
    for term, _ in spelling.TERMS:
        for _ in range(12):
            w = list(term)
            for _ in range(rng.randint(1, 3)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randint(0, 1)] = rng.choice(("", "a", "e", "z"))
            words.add("".join(w))
    for w in words:
        best = None
        for term, category, n_words, size, rank in ((r[0], r[1], r[3], r[4], r[5]) for r in lexicon.rows()):
            if n_words == 1 and size >= 5 and len(w) >= 5 and w not in lexicon.NEVER_FUZZY:
                d = plain(list(w), list(term))
                d = sum(d[:3])
                if 0 < d <= 2 and (d < 2 or len(w) >= 7) and d / max(len(w), size) <= 0.25 and (best is None or d < best[2]):
                    best = (term, category, d, 1 - d / max(len(w), size))
        assert spelling.nearest(w) == best, w


def test_phrases_by_rank():
    assert phrases.find("West Virginia Beach") == [("Virginia Beach", "city", 5, 19)]
    assert phrases.find("new yorknew york city_ new york") == [("new york", "city", 23, 31)]
    assert [f[2:] for f in phrases.find("red-red,_red red2 ré red")] == [(0, 3), (4, 7), (21, 24)]
    assert phrases.find("TEXAS is teſting teXaſ") == [("TEXAS", "state", 0, 5), ("teXaſ", "state", 17, 22)]
    assert phrases.find(None) == phrases.find("") == []


def test_small_functions(spark):
    kind = "struct<text:string,start:double,end:double,words:array<struct<word:string,start:double,end:double,confidence:double>>>"
    row = ([(" a b ", 0.0, 1.0, [("Mondays", 0.0, 0.5, 1.0), ("b", 0.5, 1.0, 1.0)]), ("c", 1.0, 2.0, []), ("d", 2.0, 3.0, [("d", 2.0, 3.0, 1.0)])],)
    df = spark.createDataFrame([row], f"segments array<{kind}>")
    r = df.select(T.full_text(F.col("segments")).alias("t"), T.flat_words(F.col("segments"))["word"].alias("w"), T.normalize_phrase(F.lit("  Houston's,  Mondays! ")).alias("p")).first()
    assert (r["t"], r["w"], r["p"]) == ("a b c d", ["Mondays", "b", "d"], "houston's monday")
    assert [w["word"] for w in words_of(df.withColumn("id", F.lit("x"))).orderBy("idx").collect()] == ["Mondays", "b", "d"]
    asr = spark.createDataFrame([("x", None, "the cat", None)], f"id string, segments array<{kind}>, redacted_text string, text string")
    human = spark.createDataFrame([("x", "b/x.txt", "second"), ("x", "a/x.txt", "The cat."), ("y", "a/y.txt", "none")], "id string, path string, text string")
    assert [tuple(r) for r in pair_by_stem(asr, human).collect()] == [("x", "the cat", "the cat")]  # the first by path
