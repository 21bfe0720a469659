"""Target-distribution importance resampling over hashed word n-grams.

The corpus and a target text collection are both described by how often each of `buckets` hashed n-grams (of 1 to `most`
words) occurs. A bucket's gain is the logarithm of the ratio of its smoothed shares, a document's weight the sum of its
n-grams' gains, and its score the weight plus Gumbel noise drawn from its id, so that taking the highest scores draws
documents without replacement in proportion to their importance.

Texts differ in length by orders of magnitude, so long ones are cut: a chunk owns chunk_words starting positions and
carries the most - 1 words that follow, so that each n-gram is counted in the one chunk where it starts, and
none is lost at a border. Texts of one chunk are hashed where they are read; the chunks of longer texts are dealt evenly
over all tasks first. Hashes are written once (2 or 4 bytes each) and read twice: tasks add up bucket counts, of which
`buckets` rows reach the driver, and then sum gains a chunk; chunk counts and weights are summed by document.

Documents are ranked by range partitions with an offset a partition; no task sorts more than its share.

Cases: null and blank texts have no n-grams and weight 0; texts with fewer words than `least_words` are scored and never
drawn; texts of any length are counted whole; rows that repeat an id are documents of their own with the same noise; a
null id has the noise of the word "null" and loses ties; equal scores go to the smaller id. Without target texts
all shares of the target are equal; an empty table gives no rows. Columns besides the id and the text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written
from .hilbert import ranked

#: Every ASCII byte but 0-9 and a-z (A-Z are lower-cased first) stands between words.
BREAKS = bytes(c if c > 127 or chr(c).isdigit() or chr(c).islower() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words in order: runs of digits, letters and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().lower().translate(BREAKS).split()


def chunks(words: list[bytes], size: int, most: int) -> Iterator[tuple[list[bytes], int]]:
    """(words of a chunk with those it carries, how many starting positions it owns); no words are one empty chunk."""
    for lo in range(0, max(1, len(words)), size):
        yield words[lo : lo + size + most - 1], min(size, len(words) - lo)


def hashed(words: list[bytes], own: int, most: int, buckets: int) -> np.ndarray:
    """The buckets of all n-grams of up to `most` words that start at the first `own` words."""
    parts = []
    for n in range(1, most + 1):
        count = min(own, len(words) - n + 1)
        if count > 0:
            grams = words[:count] if n == 1 else (b" ".join(words[i : i + n]) for i in range(count))
            parts.append(np.fromiter(map(zlib.crc32, grams), np.uint32, count))
    return np.concatenate(parts) % np.uint32(buckets) if parts else np.zeros(0, np.uint32)


def hashed_chunks(docs: DataFrame, most: int, buckets: int, chunk_words: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(row, id, own, hashes) of the texts of one chunk, and of each chunk of the longer ones; both written. row is one
    number a document, own the number of words it (or the chunk) has."""
    kind, wide = "row long, id long, own long, hashes binary", np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                out: dict[str, list] = {n: [] for n in ("row", "id", "chunk", "own", "hashes", "text")}
                for row, i, t in zip(b["row"].to_pylist(), b["id"].to_pylist(), b["text"], strict=True):
                    words = words_of(t.as_py())
                    whole = len(words) <= chunk_words
                    for k, (part, own) in enumerate(chunks(words, chunk_words, most)):
                        told = (hashed(part, own, most, buckets).astype(wide).tobytes(), None) if whole else (None, b" ".join(part))
                        for n, x in zip(out, (row, i, k, own, *told), strict=True):
                            out[n].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if n in ("hashes", "text") else pa.int64()) for n, v in out.items()], list(out))

    def rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [hashed(t.as_py().split(b" "), own, most, buckets).astype(wide).tobytes() for t, own in zip(b["text"], b["own"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["row"], b["id"], b["own"], pa.array(got, pa.binary())], ["row", "id", "own", "hashes"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = written(rows.mapInArrow(cut, "row long, id long, chunk long, own long, hashes binary, text binary"), "chunks")
    short = table.filter("text IS NULL").select("row", "id", "own", "hashes")
    dealt = table.filter("text IS NOT NULL").select("row", "id", "chunk", "own", "text").repartition("row", "chunk")
    return short, written(dealt.mapInArrow(rest, kind), "long_chunks")


def bucket_counts(parts: list[DataFrame], buckets: int) -> np.ndarray:
    """How often each bucket occurs in all of parts (with a column hashes); `buckets` rows at most reach the driver."""
    wide = "<u2" if buckets <= 1 << 16 else "<u4"

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b["hashes"].to_pylist()), wide), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for part in parts:
        for r in part.select("hashes").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[r["bucket"]] += r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln) of the ratio of each bucket's shares in target and corpus, one added to every count."""
    a, b, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(scale * math.log((t + 1.0) * (a + n) / ((s + 1.0) * (b + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(part: DataFrame, gain: np.ndarray) -> DataFrame:
    """row, id, own, n_features, weight of each chunk."""
    wide = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [np.frombuffer(h.as_buffer(), wide) for h in b["hashes"]]
            n, w = pa.array([len(x) for x in each], pa.int64()), pa.array([int(gain[x].sum()) for x in each], pa.int64())
            yield pa.RecordBatch.from_arrays([b["row"], b["id"], b["own"], n, w], ["row", "id", "n_words", "n_features", "weight"])

    return part.mapInArrow(summed, "row long, id long, n_words long, n_features long, weight long")


def importance(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, share: int = 10, least_words: int = 20, seed: int = 2024, chunk_words: int = 4096,
               id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """id, n_words, n_features, weight, score, rank for every row of docs. Of the documents of at least least_words words
    `share` per cent are drawn, those of the highest scores; rank counts them from 1 and is null for all others."""
    own = hashed_chunks(docs, most, buckets, chunk_words, id_col, text_col)
    like = hashed_chunks(target.select(F.lit(None).cast("long").alias("id"), F.col(target_text).alias("text")), most, buckets, chunk_words, "id", "text")
    gain = gains(bucket_counts(list(own), buckets), bucket_counts(list(like), buckets))
    short, long = (weighed(part, gain) for part in own)
    long = long.groupBy("row", "id").agg(*(F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = written(short.unionByName(long).withColumn("score", F.col("weight") + noise), "scored")
    able, n = ranked(scored.filter(F.col("n_words") >= least_words), [F.desc("score"), F.asc_nulls_last("id"), "weight", "n_features", "row"])
    rank = F.when(F.col("rank") < share * n // 100, F.col("rank") + 1)
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return able.withColumn("rank", rank).unionByName(rest).drop("row")


def resampled(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of docs that importance() draws. Rows without an id cannot be referred to and are left out."""
    key = how.get("id_col", "doc_id")
    drawn = importance(docs, target, **how).filter("rank IS NOT NULL").select(F.col("id").alias(key)).distinct()
    return docs.join(drawn, key, "left_semi")
