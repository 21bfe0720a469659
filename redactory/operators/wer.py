"""Word error rate: alignment of word lists, per pair and over a batch.

No built-in expresses the dynamic program over both lists, so it runs in Arrow functions. They keep a row of its matrix as
two bit vectors, of the steps up and down from one cell to the next, and make a row from the one before by a few operations
on whole vectors. Counts of short pairs are taken side by side, a pair a lane of 64 bits. For longer ones, and for the
pairs of words themselves, the rows are numbers of any length, and of those only the ones around the place that is being
traced are kept: the matrix is halved until a part has ROWS rows, each half made again from the state at its top.
Texts are cleaned and the rates formed by built-in expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_sum
from ..functions.text import wer_words

ALIGNED = "struct<s:int,i:int,d:int,pairs:array<struct<ref:string,hyp:string>>>"
ROWS = 256
#: The most hypothesis and reference words of a pair that is counted in a lane, and how many lanes go side by side.
LANE, LANE_ROWS, LANES = 63, 256, 4096


def _next(same: int, up: int, down: int, whole: int) -> tuple[int, int, int]:
    """The next row's vectors from a row's: bit j of up (down) says that cell j + 1 costs one more (less) than cell j. Also
    the bits j whose cell j costs one less than the cell above it; same are the columns whose word is the row's."""
    x = same | down
    diagonal = (((x & up) + up) ^ up) | x
    less = up & diagonal
    x = ((down | ~(up | diagonal)) << 1) | 1
    return ((less << 1) | ~(x | diagonal)) & whole, x & diagonal & whole, (less << 1) & whole


def _trace(ref: list, where: dict, lo: int, hi: int, up: int, down: int, j: int) -> Iterator[str]:
    """The steps from cell (hi, j) back to row lo, whose vectors are up and down; returns the column there."""
    whole = (1 << j) - 1
    up, down = up & whole, down & whole
    if hi - lo > ROWS:
        mid, a, b = (lo + hi) // 2, up, down
        for i in range(lo, mid):
            a, b, _ = _next(where.get(ref[i], 0) & whole, a, b, whole)
        j = yield from _trace(ref, where, mid, hi, a, b, j)
        return (yield from _trace(ref, where, lo, mid, up, down, j))
    rows = []
    for i in range(lo, hi):
        same = where.get(ref[i], 0) & whole
        above = down
        up, down, less = _next(same, up, down, whole)
        rows.append((same, less & ~same, above & ~same & ~less))
    i = hi
    while i > lo:
        same, insert, delete = rows[i - lo - 1]
        bit = 1 << j >> 1
        if not bit or delete & bit:
            i, step = i - 1, "D"
        elif insert & bit:
            j, step = j - 1, "I"
        else:
            i, j, step = i - 1, j - 1, "M" if same & bit else "S"
        yield step
    return j


def _steps(ref: list, hyp: list) -> Iterator[str]:
    """The steps of the alignment from its end: M, S, I and D. Equal words match; of equal costs a substitution goes
    first, then an insertion."""
    where: dict = {}
    for j, h in enumerate(hyp):
        where[h] = where.get(h, 0) | 1 << j
    left = yield from _trace(ref, where, 0, len(ref), (1 << len(hyp)) - 1, 0, len(hyp))
    yield from "I" * left


def align(ref: list[str], hyp: list[str]) -> tuple[int, int, int, list[dict]]:
    """(substitutions, insertions, deletions, pairs). A null side of a pair is a gap."""
    i, j, n, pairs = len(ref), len(hyp), {"S": 0, "I": 0, "D": 0, "M": 0}, []
    for step in _steps(ref, hyp):
        n[step] += 1
        i, j = i - (step != "I"), j - (step != "D")
        pairs.append({"ref": ref[i] if step != "I" else None, "hyp": hyp[j] if step != "D" else None})
    return n["S"], n["I"], n["D"], pairs[::-1]


def _lanes(ref: np.ndarray, hyp: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(substitutions, insertions, deletions) of each lane: rows of word numbers ref and hyp, m and n of them; the rest of
    a row is padding that equals nothing."""
    one = np.uint64(1)
    whole = (one << n.astype(np.uint64)) - one
    up, down = whole.copy(), np.zeros(len(m), np.uint64)
    place = one << np.arange(hyp.shape[1], dtype=np.uint64)
    same, insert, delete = (np.zeros((ref.shape[1], len(m)), np.uint64) for _ in range(3))
    for i in range(ref.shape[1]):
        same[i] = ((ref[:, i, None] == hyp) * place).sum(1, dtype=np.uint64)
        x = same[i] | down
        diagonal = (((x & up) + up) ^ up) | x
        less = up & diagonal
        insert[i] = (less << one) & whole & ~same[i]
        delete[i] = down & ~same[i] & ~insert[i]
        x = ((down | ~(up | diagonal)) << one) | one
        up, down = ((less << one) | ~(x | diagonal)) & whole, x & diagonal & whole
    out = np.zeros((len(m), 3), np.int64)
    lane, i, j = np.arange(len(m)), m.astype(np.int64), n.astype(np.int64)
    while True:
        on = np.flatnonzero((i > 0) & (j > 0))
        if not len(on):
            break
        bit = one << (j[on] - 1).astype(np.uint64)
        ins, dele, eq = ((x[i[on] - 1, lane[on]] & bit) != 0 for x in (insert, delete, same))
        out[on, 0] += ~(ins | dele | eq)
        out[on, 1] += ins
        out[on, 2] += dele
        i[on] -= ~ins
        j[on] -= ~dele
    out[:, 1] += j
    out[:, 2] += i
    return out


def counted(refs: pa.Array, hyps: pa.Array) -> np.ndarray:
    """(substitutions, insertions, deletions) of each pair of word lists."""
    m, n = (x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (refs, hyps))
    words = pa.concat_arrays([refs.flatten(), hyps.flatten()]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first, second = np.cumsum(m) - m, m.sum() + np.cumsum(n) - n
    out = np.zeros((len(m), 3), np.int64)
    short = (n <= LANE) & (m <= LANE_ROWS)
    by = np.flatnonzero(short)
    by = by[np.lexsort((n[by], m[by]))]  # lanes of like lengths side by side
    for lo in range(0, len(by), LANES):
        at = by[lo : lo + LANES]
        sides = []
        for start, size, pad in ((first[at], m[at], -1), (second[at], n[at], -2)):
            k = np.arange(size.max())
            sides.append(np.where(k < size[:, None], words[np.minimum(start[:, None] + k, len(words) - 1)], pad) if len(words) and len(k) else np.zeros((len(at), len(k)), np.int64))
        out[at] = _lanes(*sides, m[at], n[at])
    for k in np.flatnonzero(~short):
        tally = {"S": 0, "I": 0, "D": 0, "M": 0}
        for step in _steps(words[first[k] : first[k] + m[k]].tolist(), words[second[k] : second[k] + n[k]].tolist()):
            tally[step] += 1
        out[k] = tally["S"], tally["I"], tally["D"]
    return out


def _counts(refs: pa.Array, hyps: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in counted(refs, hyps).T], ["s", "i", "d"])


def _aligned(refs: pa.Array, hyps: pa.Array) -> pa.Array:
    got = [align(r, h) for r, h in zip(refs.to_pylist(), hyps.to_pylist(), strict=True)]
    return pa.array([{"s": s, "i": i, "d": d, "pairs": p} for s, i, d, p in got], pa.struct([("s", pa.int32()), ("i", pa.int32()), ("d", pa.int32()), ("pairs", pa.list_(pa.struct([("ref", pa.string()), ("hyp", pa.string())])))]))


def rate(s: Column, i: Column, d: Column, n_ref: Column, n_hyp: Column) -> Column:
    return F.when((n_ref == 0) & (n_hyp == 0), 0.0).when(n_ref == 0, F.lit(float("inf"))).otherwise((s + i + d) / F.greatest(n_ref, F.lit(1)))


def wer(pairs: DataFrame, reference: str = "reference", hypothesis: str = "hypothesis", aligned: bool = True) -> DataFrame:
    """pairs with wer, substitutions, insertions, deletions, reference_words, hypothesis_words and, with aligned,
    aligned_pairs. The counts alone take far less time."""
    f = F.arrow_udf(_aligned, ALIGNED) if aligned else F.arrow_udf(_counts, "struct<s:int,i:int,d:int>")
    df = pairs.withColumns({"_r": wer_words(F.col(reference)), "_h": wer_words(F.col(hypothesis))})
    df = df.withColumn("_a", f("_r", "_h")).withColumns({"reference_words": F.size("_r"), "hypothesis_words": F.size("_h")})
    df = df.withColumns({"substitutions": F.col("_a.s"), "insertions": F.col("_a.i"), "deletions": F.col("_a.d"), **({"aligned_pairs": F.col("_a.pairs")} if aligned else {})})
    return df.withColumn("wer", rate(*map(F.col, ("substitutions", "insertions", "deletions", "reference_words", "hypothesis_words")))).drop("_r", "_h", "_a")


def batch(rows: DataFrame) -> DataFrame:
    """One row: aggregate_wer, mean_wer (over pairs with reference words), mean_wer_all (over all), sums, num_samples."""
    s = F.sum(F.col("substitutions") + F.col("insertions") + F.col("deletions"))
    n = F.sum("reference_words")
    mean = lambda x: F.try_divide(exact_sum(x), F.count(x))
    return rows.agg(
        F.coalesce(F.when(n > 0, s / n), F.lit(0.0)).alias("aggregate_wer"), F.coalesce(mean(F.when(F.col("reference_words") > 0, F.col("wer"))), F.lit(0.0)).alias("mean_wer"), mean(F.col("wer")).alias("mean_wer_all"),
        F.sum("substitutions").alias("substitutions"), F.sum("insertions").alias("insertions"), F.sum("deletions").alias("deletions"), n.alias("reference_words"), F.count("*").alias("num_samples"))


def errors(aligned_pairs: Column, most: int = 20) -> Column:
    """The first `most` pairs that differ, labelled SUB, DEL or INS."""
    kind = lambda p: F.when(p["hyp"].isNull(), "DEL").when(p["ref"].isNull(), "INS").otherwise("SUB")
    wrong = F.filter(aligned_pairs, lambda p: ~p["ref"].eqNullSafe(p["hyp"]))
    return F.transform(F.slice(wrong, 1, most), lambda p: F.struct(kind(p).alias("kind"), p["ref"].alias("ref"), p["hyp"].alias("hyp")))
