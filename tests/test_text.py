import pytest
from pyspark.sql import functions as F

from redactory.functions import text as T
from redactory.functions.lexicon import rows

NORM = {"MONDAY": "monday", "Houston's": "houston", "Texas?": "texas", '"Houston"': "houston", "Mondays": "monday", "dress": "dress", "bus": "bus", "": "", None: "", "Mars": "mar", "Tues": "tue", "monday's,": "monday's"}
MAY = [("You may proceed", 4, 7, False), ("avocado may actually be", 8, 11, False), ("In May we celebrate", 3, 6, True), ("last May I visited", 5, 8, True), ("May 15th is the date", 0, 3, True), ("on May 1st we", 3, 6, True), ("May 2024 was great", 0, 3, True)]


def test_normalize_word(spark):
    df = spark.createDataFrame([(k,) for k in NORM], "w string").select("w", T.normalize_word(F.col("w")).alias("n"))
    assert {r["w"]: r["n"] for r in df.collect()} == NORM


def test_may(spark):
    df = spark.createDataFrame(MAY, "t string, a int, b int, y boolean").select("t", "y", T.may_is_month(F.col("t"), F.col("a"), F.col("b")).alias("m"))
    assert [r for r in df.collect() if r["y"] != r["m"]] == []


def test_lexicon():
    assert len(rows()) == 260 and len({r[0] for r in rows()}) == 259
    assert next(r for r in rows() if r[0] == "new york")[1] == "city"


@pytest.mark.parametrize("raw,clean", [("[0.000] <Speaker_1> Don't <breath> stop.", "don t stop")])
def test_clean(spark, raw, clean):
    assert spark.createDataFrame([(raw,)], "t string").select(T.clean_human(F.col("t"))).first()[0] == clean
