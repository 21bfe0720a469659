"""MinHash near-dedup by one-permutation hashing.

A shingle set is hashed once: the range of hashes is cut into bands * rows equal bins, and a bin's value is the least hash
in it. An empty bin takes the value of the first filled one in a random order of bins of its own (optimal
densification: the order does not depend on the set, so two sets take from the same bin wherever both can). `rows`
bins make a band, and sets whose band is equal meet in a bucket. set_links.linked() compares each set of a
bucket with one elected set, so that candidate edges form stars and grow with the rows and not with the pairs, confirms
edges on whole sets, and finds what stars cannot show by an exact prefix filter over the buckets that are left open.

Two sets at index j share a bin's value with a chance of about j, so they share no bucket with one of (1 - j^rows)^bands:
8 in ten million at 0.85 with 24 bands of 5 bins. Equal sets are one node before any of this.

Cases: null, empty and blank texts have the empty set, are linked with nothing and stay; a text with fewer words than a
shingle is one shingle; texts of any length are read whole; sets are compared by 64-bit hashes of shingles. Rows
that repeat an id are one document in the sense that they stay or go together. Rows with a null id have a
component like all others and carry links on; a component is named by its smallest id, null where none of its rows has
an id, and such rows stay. An empty table gives no rows. Columns besides the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import kept, skew_join, written
from .set_links import linked, named, shingle_hashes


def bin_orders(bins: int, seed: int = 11) -> np.ndarray:
    """For each bin the order in which it looks for a filled one, itself first."""
    rng = np.random.default_rng(seed)
    out = np.array([rng.permutation(bins) for _ in range(bins)])
    rows, at = np.arange(bins), np.argsort(out, axis=1)
    own = at[rows, rows]  # where a bin stands in its own order
    out[rows, own] = out[:, 0]
    out[:, 0] = rows
    return out


def signature(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """One value a bin, from the sorted distinct hashes of a set that is not empty."""
    bins = len(orders)
    of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))  # hashes ascend, so the first of a bin is its least
    value, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    value[of[head]], filled[of[head]] = hashes[head], True
    return value[orders[np.arange(bins), filled[orders].argmax(1)]]


def bands_of(values: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit number a band of a signature."""
    out = np.zeros(bands, np.uint64)
    for column in values.reshape(bands, -1).T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def sketched(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """id, text, row (unique), n (shingles in the set), key (equal for equal sets; null without words) and bands; written."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = bin_orders(bands * rows)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                b = batch.slice(lo, 1000)
                sets = [np.unique(shingle_hashes(t.as_py() or "", shingle)) for t in b["text"]]
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                told = [bands_of(signature(s, orders), bands) if len(s) else s for s in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, told)]), pa.int32()), pa.array(np.concatenate(told).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b["id"], b["text"], pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.binary()), lists], ["id", "text", "n", "key", "bands"])

    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(docs.mapInArrow(made, "id long, text string, n long, key binary, bands array<long>").withColumn("row", F.monotonically_increasing_id()), "sketched")


def minhash_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, least: tuple[int, int] = (17, 20), bands: int = 24, rows: int = 5) -> DataFrame:
    """id, n_shingles, component (the smallest id that a chain of links reaches), kept, for every row of docs. Texts are
    linked where the Jaccard index of their shingle sets is least[0] / least[1] or more."""
    own = sketched(docs, id_col, text_col, shingle, bands, rows)
    nodes = kept(own.filter("n > 0").groupBy("key").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.count("*").alias("size")))
    reps = own.join(nodes.select(F.col("node").alias("row")).hint("merge"), "row", "left_semi")
    buckets = reps.select(F.col("row").alias("node"), F.posexplode("bands").alias("t", "band")).select(F.xxhash64("t", "band").alias("bucket"), "node")
    edges = linked(buckets, own, shingle, least)
    found = kept(named(nodes, edges).select("key", "size", "component"))
    together = skew_join(own.select("id", "n", "key"), found, "key", "size").select("id", "n", "component")
    alone = own.filter("n = 0").select("id", "n", F.col("id").alias("component"))
    return together.unionByName(alone).select("id", F.col("n").alias("n_shingles"), "component", F.col("id").eqNullSafe(F.col("component")).alias("kept"))
