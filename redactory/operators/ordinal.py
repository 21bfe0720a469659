"""Running numbers over all rows in one order, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows looked at for each range when ranges are cut; what they bound is how even the ranges are, not what is counted.
SAMPLES = 20


def numbered(df: DataFrame, by: list[str], ranges: int | None = None, ordinal: str = "ordinal", total: str = "total") -> DataFrame:
    """df with ordinal (1, 2, ... in ascending order of the columns `by`, nulls first) and total, both long.

    The order is cut into ranges at rows drawn by the hash of their key: a bounded number of keys reaches the driver.
    A first pass counts the rows of each range, a second numbers them within it. Rows that tie in `by` are numbered in any
    order; ranges hold whole ties."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*by)
    drawn = df.select(key.alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(SAMPLES * ranges).orderBy("k").collect()
    bounds = [drawn[i * len(drawn) // ranges]["k"] for i in range(1, ranges)] if len(drawn) >= ranges else [r["k"] for r in drawn[1:]]
    kind = df.select(key.alias("k")).schema["k"].dataType
    bound = spark.createDataFrame([(bounds,)], f"bounds array<{kind.simpleString()}>") if bounds else None
    if bound is None:
        placed = df.withColumn("_range", F.lit(0))
    else:
        placed = df.crossJoin(F.broadcast(bound)).withColumn("_range", F.size(F.filter("bounds", lambda b: b <= key))).drop("bounds")  # one row
    counts = [(r["_range"], r["n"]) for r in placed.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect()]
    starts, sum_ = [], 0
    for at, n in counts:
        starts.append((at, sum_))
        sum_ += n
    starts = F.broadcast(spark.createDataFrame(starts, "_range int, _start long"))
    own = F.row_number().over(W.partitionBy("_range").orderBy(*by))
    out = placed.withColumn("_own", own).join(starts, "_range")
    return out.withColumns({ordinal: F.col("_start") + F.col("_own"), total: F.lit(sum_).cast("long")}).drop("_range", "_own", "_start")
