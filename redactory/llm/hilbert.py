"""Sharding along a Hilbert curve over several quantised metadata dimensions.

Each row gets a cell of a dims x 2^bits grid; rows are sorted by the cell's place on the curve (range-partitioned,
so that no task holds more than its share, a hot cell included) and the sorted sequence is cut into runs of equal
counts. A shard then covers a small box of every dimension, which min/max statistics can prune by.

Text categories are quantised by their rank among the distinct values. Cases: null metadata takes cell 0 of its
dimension; null texts have size 1 and the checksum of no bytes; ties on the curve go by checksum and id, so that equal
texts of one cell follow one another; equal texts whose metadata or ids differ may lie in different shards. An empty
table gives no rows. Rows repeated in full get slots of their own. Columns besides the stated ones do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._common import kept


def category_bounds(docs: DataFrame, col: str, bits: int) -> list[tuple[int, str]]:
    """(cell, least value) of a text column's cells: its distinct values in order, cut into 2^bits runs of equal
    counts. At most 2^bits rows reach the driver, however many values there are."""
    values, n = ranked(docs.select(F.col(col).alias("v")).filter("v IS NOT NULL").distinct(), ["v"])
    cell = F.expr(f"cast((rank * {1 << bits}L) div {max(n, 1)}L AS int)")
    return sorted((r["cell"], r["v"]) for r in values.groupBy(cell.alias("cell")).agg(F.min("v").alias("v")).collect())


def category_cell(col: Column, bounds: list[tuple[int, str]]) -> Column:
    """Cell of a text value; cells are in the order of values, so that a shard's least and greatest value prune."""
    out = F.lit(0)
    for cell, least in bounds:  # each later bound that the value reaches replaces the one before
        out = F.when(col >= F.lit(least), F.lit(cell)).otherwise(out)
    return out.cast("int")


def log_cell(col: Column, bits: int) -> Column:
    """The number of a positive value's binary digits after the first."""
    return F.least(F.lit((1 << bits) - 1), F.coalesce(F.length(F.bin(F.greatest(col, F.lit(1)))) - 1, F.lit(0))).cast("int")


def range_cell(col: Column, low: Column, high: Column, bits: int) -> Column:
    """Cell of equal width between low and high."""
    part = (col - low).cast("double") / F.greatest(high - low + 1, F.lit(1)).cast("double")
    return F.coalesce(F.least(F.lit((1 << bits) - 1), F.floor(part * (1 << bits))), F.lit(0)).cast("int")


def with_curve(df: DataFrame, cells: list[str], bits: int, out: str = "curve") -> DataFrame:
    """Adds the index on the Hilbert curve of the integer columns cells (each below 2^bits).

    The axes are undone from the top bit down, then Gray-coded; each step is a projection of its own, as the
    first axis is read by all of them."""
    x = [f"_x{i}" for i in range(len(cells))]
    rest = df.columns
    df = df.withColumns({v: F.col(c) for v, c in zip(x, cells, strict=True)})
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i, v in enumerate(x):
            on = F.col(v).bitwiseAND(q) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(v)).bitwiseAND(p)
            step = {x[0]: F.when(on, F.col(x[0]).bitwiseXOR(F.lit(p))).otherwise(F.col(x[0]).bitwiseXOR(swap))}
            if i:
                step[v] = F.when(on, F.col(v)).otherwise(F.col(v).bitwiseXOR(swap))
            df = df.withColumns(step)
    for a, b in zip(x, x[1:], strict=False):
        df = df.withColumn(b, F.col(a).bitwiseXOR(F.col(b)))
    flip = F.lit(0)
    for b in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(1 << b) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_flip", flip)
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for v in x:
            index = F.shiftleft(index, 1) + F.shiftright(F.col(v).bitwiseXOR(F.col("_flip")), b).bitwiseAND(1)
    return df.withColumn(out, index).select(*rest, out)


def ranked(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """df with rank long, 0 upwards in that order, and its number of rows. Sorted by ranges; a task's rows are
    numbered where they are and a table of one row a task gives the offsets."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = kept(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sums = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = sums.select("_part", (F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    out = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return out.withColumn("rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_start"), placed.count()


def hilbert_shards(docs: DataFrame, shards: int = 8, bits: int = 4, id_col: str = "doc_id", text_col: str = "text", categories: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """id, size, text_crc32, curve, shard, slot: law "rows", shard sizes differ by one row at most."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    df = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *(category_cell(F.col(c), category_bounds(docs, c, bits)).alias(f"_c{i}") for i, c in enumerate(categories)))
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    df = df.withColumns({"_size": log_cell(F.col("size"), bits), "_id": range_cell(F.col("id"), F.lit(low or 0), F.lit(high or 0), bits)})
    cells = [f"_c{i}" for i in range(len(categories))] + ["_size", "_id"]
    df, n = ranked(with_curve(df, cells, bits).drop(*cells), ["curve", "text_crc32", "id"])
    shard = F.expr(f"(rank * {shards} + {shards - 1}) div {max(n, 1)}L")
    df = df.withColumn("shard", shard.cast("int"))
    return df.withColumn("slot", F.col("rank") - F.expr(f"(shard * {n}L) div {shards}L")).drop("rank")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The rows of docs in one folder a shard, each file sorted along the curve."""
    keys = placed.select(F.col("id").alias("_id"), "shard", "slot")
    rows = docs.join(keys, docs[id_col] == keys["_id"]).drop("_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
