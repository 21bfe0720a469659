"""SimHash near-dedup by covering locality-sensitive hashing.

64-bit fingerprints of word shingles are compared through 2^(r+1)-1 tables of masked fingerprints. Bit i has a
nonzero vector v(i) of r+1 bits, and the mask of table t keeps the bits whose vector has an odd product with t. Any r
differing bits leave some t that is orthogonal to all their vectors, so every pair within radius r collides in
that table: no pair is missed (Pagh, Covering LSH).

Rows are first reduced to distinct fingerprints. Within a bucket only spanning links leave the task (each joins two
parts), so no group emits its pairs; large buckets probe all neighbours within the radius over
the bits the mask leaves free instead of comparing pairs. Connected components alternate large-star and
small-star rounds, each written to the shared folder.

similar_documents() links by similarity of the shingle sets instead of bits. At a Jaccard index of 0.8 two fingerprints
differ in about 10 of 64 bits, and covering that radius would take thousands of tables. So besides the covering tables
of the whole document's fingerprint, whose links are candidates, a document gets `samples` further fingerprints, each
the SimHash of `width` shingles, those of least hash under permutations of the sample's own; equal ones (radius 0, one
table each) are buckets. A pair at index j shares no bucket with a chance of (1 - j^width)^samples, 3 in a million at 0.8;
of the pairs that share one, set_links.linked() loses none: it compares each row with one elected row of its buckets and
finds what that leaves open by an exact prefix filter.

Cases: null, empty and blank texts have fingerprint zero and are linked like any other; texts with fewer words
than a shingle are one shingle; texts of any length are hashed in blocks; repeated rows share a fingerprint. Rows with a
null id have a component like all others and carry links on; a component is named by its smallest id, null where none of
its rows has an id. An empty table gives no rows. Columns besides the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import kept, skew_join, written
from .set_links import _then_none, components, linked, named, shingle_hashes, shingle_set  # noqa: F401 components are part of this module too

BLOCK, PAIRWISE = 1 << 15, 6000


def majority(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes."""
    one = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), BLOCK):
        one += np.unpackbits(hashes[lo : lo + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * one > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """id, fp (the fingerprint as a signed long)."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py() or "", shingle, seed) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(hashed, "id long, fp long")


def masks(radius: int, bits: int = 64) -> list[int]:
    """The covering masks; the nonzero vectors are dealt to the bits in turn."""
    vector = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & t).bit_count() % 2) for t in range(1, 2 ** (radius + 1))]


def neighbours(free: list[int], radius: int) -> np.ndarray:
    """All nonzero patterns of up to radius of the free bits."""
    out, last = [], [(0, -1)]
    for _ in range(radius):
        last = [(p | 1 << free[j], j) for p, i in last for j in range(i + 1, len(free))]
        out += [p for p, _ in last]
    return np.array(out, np.uint64)


def spanning(fp: np.ndarray, node: np.ndarray, radius: int, mask: int, bits: int = 64) -> list[tuple[int, int]]:
    """(a, b), b < a, within the radius: as few links as join all parts of one bucket."""
    order = np.argsort(node)
    fp, node = fp[order], node[order]
    up, out = np.arange(len(fp)), []

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            i, j = find(x), find(y)
            if i != j:
                up[max(i, j)] = min(i, j)
                out.append((int(node[max(x, y)]), int(node[min(x, y)])))

    if len(fp) <= PAIRWISE:
        for i in range(len(fp) - 1):
            j = i + 1 + np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= radius)
            if j.size:
                join(np.full(j.size, i), j)
    else:  # linear in the bucket: each fingerprint looks its neighbours up
        by = np.argsort(fp)
        ranked = fp[by]
        for p in neighbours([i for i in range(bits) if not mask >> i & 1], radius):
            want = ranked ^ p
            at = np.minimum(np.searchsorted(ranked, want), len(ranked) - 1)
            hit = np.flatnonzero((ranked[at] == want) & (want > ranked))
            if hit.size:
                join(by[hit], by[at[hit]])
    return out


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Spanning links (a, b), b < a, of nodes (fp, node), one row a fingerprint."""
    tables = masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    keyed = nodes.select("fp", "node", F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)))).alias("k")).select("k.*", "fp", "node")

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("t", "key", "fp", "node")
        held = None
        for batch in _then_none(batches):
            if batch is not None:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
                held = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if held is None or not len(held[0]):
                continue
            t, key, fp, node = held
            cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            cut = np.concatenate([[0], cut, [len(t)]])
            whole = len(cut) - 2 if batch is not None else len(cut) - 1  # the last bucket may go on
            out = []
            for g in np.flatnonzero(np.diff(cut[: whole + 1]) > 1):
                lo, hi = cut[g], cut[g + 1]
                out += spanning(fp[lo:hi].view(np.uint64), node[lo:hi], radius, tables[t[lo]])
            held = [x[cut[whole] :] for x in held]
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return keyed.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """id, fp, component: the smallest id that a chain of links reaches, for every row of docs."""
    own = kept(fingerprints(docs, id_col, text_col, shingle))
    nodes = kept(own.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")).withColumn("node", F.col("fp")))
    nodes = kept(named(nodes, links(nodes.select("fp", "node"), radius)).select("fp", "n", "component"))
    return skew_join(own, nodes, "fp", "n").select("id", "fp", "component")


def permutations(samples: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of permutations of 32-bit numbers, a column each."""
    odd, add = np.random.default_rng(samples * 1000 + width).integers(0, 2**32, (2, samples * width, 1), dtype=np.uint32)
    return odd | np.uint32(1), add


def sample_fingerprints(hashes: np.ndarray, odd: np.ndarray, add: np.ndarray, samples: int) -> np.ndarray:
    """One SimHash a sample of shingles; a sample has the shingle of least hash of each of its permutations."""
    high, least = (hashes >> np.uint64(32)).astype(np.uint32), None
    for lo in range(0, len(high), BLOCK // 16):
        part = (high[lo : lo + BLOCK // 16] * odd + add).min(1)
        least = part if least is None else np.minimum(least, part)
    full = (least.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)  # 64 bits of each
    full ^= full >> np.uint64(31)
    full *= np.uint64(0xC2B2AE3D27D4EB4F)
    full ^= full >> np.uint64(29)
    one = np.unpackbits(full.view(np.uint8).reshape(samples, -1, 8), axis=2, bitorder="little").sum(1)
    return np.packbits(2 * one > len(odd) // samples, axis=1, bitorder="little").view("<u8").ravel()


def described(docs: DataFrame, id_col: str, text_col: str, shingle: int, samples: int, width: int) -> DataFrame:
    """id, text, row (unique), fp, key (equal for equal sets) and sig, an array of sample fingerprints; written."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, add = permutations(samples, width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                b = batch.slice(lo, 1000)
                texts = [t.as_py() or "" for t in b.column("text")]
                each = [shingle_hashes(t, shingle) for t in texts]
                sets = list(map(shingle_set, each))
                sig = np.array([sample_fingerprints(s, odd, add, samples) for s in sets]).view(np.int64)
                fp = np.fromiter(map(majority, each), np.uint64, len(texts)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * samples), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text"), pa.array(fp), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), lists], ["id", "text", "fp", "key", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(made, "id long, text string, fp long, key binary, sig array<long>").withColumn("row", F.monotonically_increasing_id()), "described")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: tuple[int, int] = (4, 5), radius: int = 3, samples: int = 24, width: int = 4) -> DataFrame:
    """id, fp, component: the smallest id that a chain of similar pairs reaches, for every row of docs."""
    own = described(docs, id_col, text_col, shingle, samples, width)
    nodes = kept(own.groupBy("key").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.count("*").alias("size")))
    reps = own.join(nodes.select(F.col("node").alias("row")).hint("merge"), "row", "left_semi").select(F.col("row").alias("node"), "fp", "sig")
    rows = reps.select("node", F.posexplode("sig").alias("t", "key")).select(F.xxhash64("t", "key").alias("bucket"), "node")
    # candidates by the whole fingerprint: rows with an equal one are a bucket, and links join unequal ones
    prints = kept(reps.select("node", "fp"))
    heads = prints.groupBy("fp").agg(F.min("node").alias("node"))
    rows = rows.union(prints.select(F.xxhash64(F.lit(-1), "fp"), "node"))
    edges = linked(rows, own, shingle, least, links(heads.select("fp", "node"), radius))
    found = kept(named(nodes, edges).select("key", "size", "component"))
    return skew_join(own.select("id", "fp", "key"), found, "key", "size").select("id", "fp", "component")
