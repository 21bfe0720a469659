"""Vector codes: product quantisation learnt over distinct integer parts.

Each component x becomes the integer floor(scale * x) and a vector is cut into `parts` equal runs of components.
Copies and near copies of vectors share parts, so what is clustered is not the vectors but, for each position, the
distinct parts with the number of vectors that have them. Lloyd's rounds read that table alone: a task finds the
nearest entry of each of its parts and returns one weighted sum an entry, so a round sends parts * entries rows to
the driver, whatever the input. At last the distinct parts get their codes and errors, which are joined back to the
vectors; a part that very many vectors share is broadcast instead of being shuffled to one task.

All arithmetic is on integers: distances are exact (in doubles only where every sum stays below 2^53), means are floors.

Cases: a vector that is null, or holds a null, a NaN or an infinity, gives no row, and neither does one whose length is
not that of most vectors (ties: the smaller length); a length that `parts` does not divide is an error. Codebooks start
from the rows of smallest id, rows of one id in order of their vectors; rows without an id are coded like all others and
start an entry only where there are fewer others than entries. Repeated rows have rows of their own. Null labels
are one label. Fewer rows than entries make smaller codebooks; an empty table gives no rows. Components beyond
the exact range of 64 bits are an error. Columns besides the three stated ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import kept, skew_join, written

BLOCK = 4096


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the entry of book nearest to each row of x; of equal ones the first."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for lo in range(0, len(x), BLOCK):
        a, b = x[lo : lo + BLOCK], book
        most = 4.0 * a.shape[1] * max(np.abs(a.astype(float)).max(initial=0), np.abs(b.astype(float)).max(initial=0)) ** 2
        if most >= 2**63:
            raise OverflowError("components are too large for exact distances")
        if most < 2**53:  # each product and sum is a whole number that doubles hold
            a, b = a.astype(float), b.astype(float)
        d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        i = d.argmin(1)
        at[lo : lo + BLOCK], far[lo : lo + BLOCK] = i, d[np.arange(len(i)), i]
    return at, far


def integer_parts(vectors: DataFrame, parts: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """row (unique), id, label and parts, an array of `parts` arrays of integers, of each whole vector; written."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.filter(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    common = v.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    size = common["n"] if common else 0
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    cut = F.array(*(F.slice(whole, k * (size // parts) + 1, size // parts) for k in range(parts)))
    return written(v.filter(F.size("v") == size).select(F.monotonically_increasing_id().alias("row"), "id", "label", cut.alias("parts")), "vector_parts")


def exploded(rows: DataFrame, *keep: str) -> DataFrame:
    """A row each part: part, a struct of its position p and its value."""
    return rows.select(*keep, F.posexplode("parts").alias("p", "value")).select(*keep, F.struct("p", "value").alias("part"))


def distinct_parts(rows: DataFrame) -> DataFrame:
    """part, n: the distinct parts of each position and how many vectors have them; written."""
    return written(exploded(rows).groupBy("part").agg(F.count("*").alias("n")), "distinct_parts")


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values (a matrix) of the column part."""
    p, value = batch.column("part").flatten()
    return p.to_numpy(), value.flatten().to_numpy().reshape(len(p), -1)


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The codebooks before the first round: parts x entries x components."""
    seeds = rows.orderBy(F.asc_nulls_last("id"), "parts").limit(entries).select("parts").collect()
    return np.array([r["parts"] for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2) if seeds else np.zeros((parts, 0, 0), np.int64)


def moved(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """books after one round of Lloyd's algorithm; entries that no part is nearest to stay."""
    entries, wide = books.shape[1:]

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            p, x = _numbers(b)
            n = b.column("n").to_numpy()
            at = np.empty(len(p), np.int64)
            for k in np.unique(p):
                at[p == k] = nearest(x[p == k], books[k])[0]
            np.add.at(count, (p, at), n)
            np.add.at(total, (p, at), x * n[:, None])
        p, at = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_pydict({"p": pa.array(p.astype(np.int32)), "entry": pa.array(at.astype(np.int32)), "n": pa.array(count[p, at]), "total": pa.array(list(total[p, at]), pa.list_(pa.int64()))})

    sums = distinct.mapInArrow(summed, "p int, entry int, n long, total array<long>")
    sums = sums.groupBy("p", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[j]) for j in range(wide))).alias("total"))
    out = books.copy()
    for r in sums.collect():  # parts * entries rows at most
        out[r["p"], r["entry"]] = np.array(r["total"], np.int64) // r["n"]
    return out


def coded(distinct: DataFrame, books: np.ndarray) -> DataFrame:
    """part, n, code, error of the distinct parts; written."""

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, x = _numbers(b)
            at, far = np.empty(len(p), np.int64), np.empty(len(p), np.int64)
            for k in np.unique(p):
                at[p == k], far[p == k] = nearest(x[p == k], books[k])
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("n"), pa.array(at), pa.array(far)], ["part", "n", "code", "error"])

    return written(distinct.mapInArrow(placed, "part struct<p:int,value:array<long>>, n long, code long, error long"), "coded_parts")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def books_table(spark: SparkSession, books: np.ndarray) -> DataFrame:
    """part, entry, components: the codebooks as a table of bounded size."""
    return spark.createDataFrame([(p, e, x.tolist()) for p, book in enumerate(books) for e, x in enumerate(book)], "part int, entry int, components array<long>")


def fit(distinct: DataFrame, books: np.ndarray, rounds: int = 4) -> np.ndarray:
    """The codebooks after so many weighted rounds over the distinct parts."""
    for _ in range(rounds if books.shape[1] else 0):
        books = moved(distinct, books)
    return books


def vector_codes(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(id, code, error, label_error for every whole vector; the codebooks). code has two hex digits a part; label_error
    is the sum of the errors of all rows with the row's label."""
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits has 256 entries at most")
    rows = integer_parts(vectors, parts, scale, id_col, vector_col, label_col)
    distinct = distinct_parts(rows)
    books = fit(distinct, first_books(rows, parts, entries), rounds)
    told = skew_join(exploded(rows, "row", "id", "label"), coded(distinct, books), "part", "n")
    digits = F.transform(F.array_sort(F.collect_list(F.struct("part.p", "code"))), lambda x: F.lower(F.lpad(F.hex(x["code"]), 2, "0")))
    per = told.groupBy("row", "id", "label").agg(F.array_join(digits, "").alias("code"), F.sum("error").alias("error"))
    per = kept(per.withColumn("_label", F.coalesce(F.col("label").cast("string"), F.lit("\0null"))))
    sums = per.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n"))
    return skew_join(per, kept(sums), "_label", "_n").select("id", "code", "error", "label_error"), books
