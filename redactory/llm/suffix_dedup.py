"""Exact substring dedup with a logarithmic family of suffix arrays.

A byte is removed where a string of `length` bytes that covers it also starts in a document with a smaller id.
Only the first `length` bytes of a suffix matter, so a suffix array here is the sorted list of those prefixes, each
with its document (truncated suffix array).

To spread the suffixes over tasks so that equal prefixes meet, each one goes to a bucket by the least 16-gram hash
in its prefix (a minimiser; equal strings have equal minimisers). Consecutive suffixes with one minimiser travel
together as a run, at most RUN of them with their text. SuffixIndex keeps a family of levels below a path. A level is the
documents of one or more batches, packed into units of about unit_bytes with their runs in order of the minimisers, and a
table of sorted minimisers by bucket and unit, which says where long matches can be. add() takes a batch whose ids are
larger than those it has:

1. While a level is at most twice as large as the next, the two are merged: their tables of minimisers become one.
2. The batch's documents are packed and become the newest level, with a table of its own.
3. The batch's minimisers are merge-scanned against those of all levels, a bucket at a time: which of them another document
   has, there or in the batch (a bit each for the units on both sides).
4. Units send the runs of those. Runs whose text repeats inside a unit are sent once, from the smallest id, which
   bounds what a passage shared by very many documents puts into one bucket: at most one run a unit.
5. In a bucket whole runs go through one family of suffix arrays in memory (Suffixes; truncated at the run's own length) and
   the suffixes of runs first met there through another; the answer is a bit for each suffix of the batch.
6. The batch's units turn the answers into removed bytes.

Buckets are a power of two that follows the bytes of the family, so a bucket's task stays as large as it is while the
family grows; a level's table is dealt to more buckets when it is read. What one minimiser has is not divided further.

Cases: null texts are empty; texts shorter than `length` lose nothing; rows with a null id are neither searched
nor looked up, and kept whole; rows with one id are one document in the sense that they never remove each other's
bytes; texts of any length are scanned in segments of SEGMENT bytes; a kept text may end within a character, so it is
binary; an empty batch gives no rows and no level. Columns besides the id and the text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bytes_at, dropped, shared_path, there, written

GRAM, RUN, SEGMENT = 16, 64, 1 << 19
#: Bytes of replies that are sent to every task, so that the units they are for are not shuffled.
SENT_BYTES = 48 << 20
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Suffixes:
    """Levels of (sorted prefixes, the smallest document of each). Prefixes are fixed-width byte strings."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """For each key the smallest document that holds it, in this batch or an earlier one. docs ascend, and no
        document of an earlier batch may be larger than one of this."""
        order = np.argsort(keys, kind="stable")  # the batch's suffix array; ties by document
        ranked = keys[order]
        head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        own, first = ranked[head], docs[order[head]]
        new = np.ones(len(own), bool)
        for level, of in self.levels:
            at = np.minimum(np.searchsorted(level, own), len(level) - 1)
            hit = level[at] == own
            first[hit], new[hit] = of[at[hit]], False
        out = np.empty(len(keys), np.int64)
        out[order] = np.repeat(first, np.diff(np.append(head, len(keys))))
        if new.any():
            self.levels.append((own[new], first[new]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels[-2:]
            key = np.concatenate([a, b])
            order = np.argsort(key, kind="stable")  # two sorted runs
            self.levels[-2:] = [(key[order], np.concatenate([x, y])[order])]
        return out


def padded(texts: list[bytes], width: int) -> np.ndarray:
    """Byte strings of one width: the texts, zeros, the texts' lengths and a last byte that is not zero."""
    return np.array([t.ljust(width, b"\0") + len(t).to_bytes(2, "big") + b"\1" for t in texts], f"S{width + 3}")


def window_hash(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the strings of that length that start at `at`."""
    words = np.ndarray((len(buf) - 7,), "<u8", buf.tobytes(), strides=(1,))
    h = np.zeros(len(at), np.uint64)
    for k in [*range(0, length - 8, 8), length - 8]:
        h = (h ^ words[at + k]) * C1
        h ^= h >> np.uint64(29)
    return h


def minimisers(buf: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, count, hash) of the runs in buf, whose documents end at ends."""
    found = []
    starts = np.concatenate([[0], ends[:-1]])
    wide = length - GRAM + 1
    for lo in range(0, len(buf), SEGMENT):
        part = buf[lo : lo + SEGMENT + length - 1]
        if len(part) < length:
            break
        u = np.ndarray((len(part) - 7,), "<u8", part.tobytes(), strides=(1,))
        m = u[:-8] * C1 + u[8:] * C2
        m ^= m >> np.uint64(32)
        m *= C1
        m ^= m >> np.uint64(29)
        step = 1
        while 2 * step <= wide:
            m, step = np.minimum(m[:-step], m[step:]), 2 * step
        if step < wide:
            m = np.minimum(m[: -(wide - step)], m[wide - step :])
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, lo + len(m), "left")
        # each document's whole windows in this segment
        a, b = np.maximum(starts[first:last], lo) - lo, np.minimum(ends[first:last] - length + 1, lo + len(m)) - lo
        ok = b > a
        a, b, doc = a[ok], b[ok], np.arange(first, last)[ok]
        edge = np.zeros(len(m) + 1, bool)
        edge[1:-1] = m[1:] != m[:-1]
        edge[a] = edge[b] = True
        cut = np.flatnonzero(edge)
        own = np.searchsorted(a, cut, "right") - 1
        keep = (own >= 0) & (cut < b[np.maximum(own, 0)]) if len(a) else np.zeros(len(cut), bool)
        n = np.diff(np.append(cut, len(m)))[keep]
        cut, own = cut[keep], own[keep]
        more = -(-n // RUN)  # long runs, as in repetitive text, go in pieces
        k = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        cut, n, own = np.repeat(cut, more) + k * RUN, np.repeat(n, more) - k * RUN, np.repeat(own, more)
        found.append((doc[own], cut + lo, np.minimum(n, RUN), m[cut]))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


UNITS = "unit string, n_bytes long, low long, high long, ids binary, runs binary, text binary"
CODES = "bucket int, unit string, codes binary, many binary"


def packed(ids: list[int], texts: list[bytes], length: int) -> dict:
    """A row of UNITS: documents by id, and their runs by minimiser."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    head = np.array([[ids[i] for i in order], [len(texts[i]) for i in order]], "<i8")
    raw = b"".join(texts[i] for i in order)
    _, start, count, h = minimisers(np.frombuffer(raw, np.uint8), np.cumsum(head[1]), length)
    by = np.argsort(h, kind="stable")
    pack = zstd.ZstdCompressor(level=3)
    runs = h[by].astype("<u8").tobytes() + start[by].astype("<u4").tobytes() + count[by].astype("u1").tobytes()
    return {"unit": uuid.uuid4().hex, "n_bytes": len(raw), "low": int(head[0][0]), "high": int(head[0][-1]), "ids": pack.compress(head.tobytes()), "runs": runs, "text": pack.compress(raw)}


class Unit:
    """A unit's documents, by id, and its runs; without the texts where those are not needed."""

    def __init__(self, row: dict, length: int, buckets: int):
        unpack = zstd.ZstdDecompressor()
        self.ids, size = np.frombuffer(unpack.decompress(row["ids"]), "<i8").reshape(2, -1)
        self.raw, self.length = unpack.decompress(row["text"]) if row.get("text") is not None else b"", length
        self.ends = np.cumsum(size)
        n = len(row["runs"]) // 13
        self.h = np.frombuffer(row["runs"], "<u8", n)
        self.start = np.frombuffer(row["runs"], "<u4", n, 8 * n).astype(np.int64)
        self.count = np.frombuffer(row["runs"], "u1", n, 12 * n).astype(np.int64)
        self.doc = np.searchsorted(self.ends, self.start, "right")
        self.code = (self.h >> np.uint64(32)).astype(np.uint32)
        bucket = (self.h & np.uint64(buckets - 1)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")  # runs of a bucket stay in order of their minimisers
        cut = np.flatnonzero(np.diff(bucket[by])) + 1
        self.groups = {int(bucket[g[0]]): g for g in np.split(by, cut) if len(g)}

    def codes(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct minimisers of a bucket, sorted, and whether more than one document has each."""
        g = self.groups[bucket]
        h = self.h[g]
        head = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        ids = self.ids[self.doc[g]]
        return h[head], np.minimum.reduceat(ids, head) < np.maximum.reduceat(ids, head)

    def wanted(self, bits: dict[int, bytes]) -> dict[int, tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """By bucket: texts of the runs to be sent, their run numbers; of all asked-for runs the number and the place
        of the sent run that answers for them, or -1 where a smaller document of the unit has the same text."""
        out = {}
        for b, packed in bits.items():
            g = self.groups[b]
            code, _ = self.codes(b)
            asked = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(code)).astype(bool)
            g = g[asked[np.searchsorted(code, self.h[g])]]
            seen: dict[bytes, tuple[int, int]] = {}
            texts, sent, answer = [], [], []
            for r, d, s, n in zip(g.tolist(), self.ids[self.doc[g]].tolist(), self.start[g].tolist(), self.count[g].tolist(), strict=True):
                text = self.raw[s : s + n + self.length - 1]
                got = seen.get(text)
                if got is None:
                    got = seen[text] = (d, len(texts))
                    texts.append(text)
                    sent.append(r)
                answer.append(got[1] if got[0] == d else -1)
            if texts:
                out[b] = texts, np.array(sent), g, np.array(answer)
        return out


def answers(docs: np.ndarray, codes: np.ndarray, texts: list[bytes], length: int, batch: int = 20_000) -> np.ndarray:
    """A 64-bit mask for each run of a bucket: the suffixes whose prefix a smaller document has."""
    order = np.argsort(docs, kind="stable")
    out = np.zeros(len(docs), np.uint64)

    def batches(which: np.ndarray, own: np.ndarray = docs, batch: int = batch) -> Iterator[np.ndarray]:
        lo = 0
        while lo < len(which):  # a document is not divided
            hi = lo + batch
            while hi < len(which) and own[which[hi]] == own[which[hi - 1]]:
                hi += 1
            yield which[lo:hi]
            lo = hi

    whole, fresh = Suffixes(), []
    width = length - 1 + RUN
    for part in batches(order):
        own = docs[part]
        first = whole.add(padded([texts[i] for i in part], width), own)
        old = part[first < own]
        out[old] = [(1 << (len(texts[i]) - length + 1)) - 1 for i in old.tolist()]
        fresh.append(part[first == own])
    fresh = np.concatenate(fresh) if fresh else order
    # suffixes can only match across runs of one minimiser whose texts differ
    of = [int(c) for c in codes[fresh]]
    kinds: dict[int, int] = {}
    for c, _ in {(c, texts[i]) for c, i in zip(of, fresh.tolist(), strict=True)}:
        kinds[c] = kinds.get(c, 0) + 1
    fresh = fresh[np.fromiter((kinds[c] > 1 for c in of), bool, len(fresh))]
    if not len(fresh):
        return out
    size = np.array([len(texts[i]) for i in fresh])
    n = size - length + 1
    buf = np.frombuffer(b"".join(texts[i] for i in fresh), np.uint8)
    run = np.repeat(np.arange(len(fresh)), n)
    place = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(size) - size)[run] + place
    # and a suffix whose prefix has a hash of its own has no match
    h = window_hash(buf, at, length)
    by = np.argsort(h)
    twin = np.flatnonzero(h[by][1:] == h[by][:-1])
    pick = np.zeros(len(h), bool)
    pick[by[twin]] = pick[by[twin + 1]] = True
    run, place, at = run[pick], place[pick], at[pick]
    single, own = Suffixes(), docs[fresh][run]
    for part in batches(np.arange(len(run)), own, 16 * batch):
        keys = buf[at[part][:, None] + np.arange(length)].reshape(-1).view(f"S{length}")
        hit = part[single.add(keys, own[part]) < own[part]]
        np.bitwise_or.at(out, fresh[run[hit]], np.uint64(1) << place[hit].astype(np.uint64))
    return out


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in b.schema.names}


def _out(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(cols)


def _unpacked(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def dealt(codes: DataFrame, buckets: int) -> DataFrame:
    """CODES dealt to so many buckets, of a table that has as many or fewer; a power of two."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            h = np.frombuffer(r["codes"], "<u8")
            many, of = _unpacked(r["many"], len(h)), (h & np.uint64(buckets - 1)).astype(np.int64)
            parts = [(int(b), of == b) for b in np.unique(of)]
            yield _out(bucket=pa.array([b for b, _ in parts], pa.int32()), unit=[r["unit"]] * len(parts), codes=[h[at].tobytes() for _, at in parts], many=[np.packbits(many[at]).tobytes() for _, at in parts])

    return codes.mapInArrow(split, CODES)


class Level(NamedTuple):
    """Folders of units, the folder of their minimisers, their bytes, the buckets these are in, and the largest id."""

    units: list[str]
    codes: str
    n_bytes: int
    buckets: int
    high: int


LEVEL = "units array<string>, codes string, n_bytes long, buckets int, high long"


class SuffixIndex:
    """A logarithmic family of levels below a path, which all executors share. Opened again, it goes on where it was."""

    def __init__(self, spark: SparkSession, path: str | None = None, length: int = 50, unit_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20, buckets: int | None = None):
        if not GRAM < length < 1 << 15:
            raise ValueError(f"length must lie above {GRAM}")
        self.spark, self.path, self.length = spark, path or shared_path(spark, "suffixes"), length
        self.unit_bytes, self.bucket_bytes, self.least = unit_bytes, bucket_bytes, buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.state, self.levels = 0, []
        while there(spark, f"{self.path}/family-{self.state + 1:09}/_SUCCESS"):
            self.state += 1
        if self.state:
            rows = spark.read.schema(f"place int, {LEVEL}").parquet(f"{self.path}/family-{self.state:09}").orderBy("place").collect()
            self.levels = [Level(*r[1:]) for r in rows]

    def _save(self) -> None:
        """Names the levels in a new state; the one before stays whole until the new one is."""
        rows = [(k, *level) for k, level in enumerate(self.levels)]
        self.spark.createDataFrame(rows, f"place int, {LEVEL}").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/family-{self.state + 1:09}")
        self.state += 1

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex}"

    def merge(self) -> None:
        """Joins the tables of neighbouring levels while one is at most twice as large as the next; units stay in place."""
        while len(self.levels) > 1 and self.levels[-2].n_bytes <= 2 * self.levels[-1].n_bytes:
            a, b = self.levels[-2:]
            wide = max(a.buckets, b.buckets)
            both = dealt(self._codes(a), wide).unionByName(dealt(self._codes(b), wide))
            codes = both.repartition("bucket").sortWithinPartitions("bucket", "unit")
            folder = self._folder("codes")
            codes.write.parquet(folder)
            self.levels[-2:] = [Level(a.units + b.units, folder, a.n_bytes + b.n_bytes, wide, max(a.high, b.high))]
            self._save()
            for old in (a, b):
                dropped(self.spark, old.codes)

    def _codes(self, level: Level) -> DataFrame:
        return self.spark.read.schema(CODES).parquet(level.codes)

    def _units(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(UNITS).parquet(*folders)

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """id, n_bytes, n_removed, n_spans long and kept binary (the bytes that stay) for every row of batch, whose ids must
        not lie below those of earlier batches; the batch becomes a level."""
        self.merge()
        length, unit_bytes = self.length, self.unit_bytes
        rows = batch.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, texts, size = [], [], 0
            for r in _rows(batches):
                if ids and size >= unit_bytes:
                    yield pa.RecordBatch.from_pylist([packed(ids, texts, length)])
                    ids, texts, size = [], [], 0
                ids.append(r["id"])
                texts.append(r["text"].encode())
                size += len(texts[-1])
            if ids:
                yield pa.RecordBatch.from_pylist([packed(ids, texts, length)])

        # a unit's name is drawn anew when a task is repeated; what is read below is the one that was committed
        new = self._folder("units")
        rows.filter("id IS NOT NULL").mapInArrow(pack, UNITS).write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(new)
        text = F.col("text").cast("binary")
        lone = rows.filter("id IS NULL").select("id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), text.alias("kept"))
        sums = self._units([new]).agg(F.sum("n_bytes").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).first()
        if sums["n"] is None:
            return lone
        if self.levels and sums["low"] < max(level.high for level in self.levels):
            raise ValueError("a batch's ids must not lie below those of earlier batches")
        whole = sums["n"] + sum(level.n_bytes for level in self.levels)
        buckets = 1 << max(self.least - 1, whole // self.bucket_bytes).bit_length()
        codes = self._folder("codes")
        self._units([new]).select("unit", "ids", "runs").mapInArrow(_told(length, buckets), CODES).write.parquet(codes)
        answers_ = self._answers(new, codes, buckets)
        self.levels.append(Level([new], codes, sums["n"], buckets, sums["high"]))
        self._save()
        return answers_.unionByName(lone)

    def _answers(self, new: str, codes: str, buckets: int) -> DataFrame:
        """The results of the batch whose units are in the folder new and whose minimisers in codes."""
        length, spark = self.length, self.spark
        told = spark.read.schema(CODES).parquet(codes).withColumn("new", F.lit(True))
        for level in self.levels:
            told = told.unionByName(dealt(self._codes(level), buckets).withColumn("new", F.lit(False)))
        hits_at, masks_at = shared_path(spark, "hits"), shared_path(spark, "masks")
        hits = written(told.groupBy("bucket").applyInArrow(_shared, "unit string, bucket int, new boolean, bits binary"), "hits", hits_at)

        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pack = zstd.ZstdCompressor(level=3)
            for r in _rows(batches):
                unit = Unit(r, length, buckets)
                out = []
                for b, (texts, sent, _, _) in unit.wanted(_by_bucket(r, "bits")).items():
                    head = unit.ids[unit.doc[sent]].astype("<i8").tobytes() + unit.code[sent].astype("<u4").tobytes() + np.array([len(t) for t in texts], "<u2").tobytes()
                    out.append((b, len(texts), pack.compress(head + b"".join(texts))))
                if out:
                    yield _out(bucket=pa.array([x[0] for x in out], pa.int32()), unit=[r["unit"]] * len(out), new=[r["got"][0]["new"]] * len(out), n=pa.array([x[1] for x in out], pa.int32()), runs=[x[2] for x in out])

        def settle(table: pa.Table) -> pa.Table:
            docs_, codes, texts = [], [], []
            unpack = zstd.ZstdDecompressor()
            for n, blob in zip(table["n"].to_pylist(), table["runs"], strict=True):
                raw = unpack.decompress(blob.as_py())
                docs_.append(np.frombuffer(raw, "<i8", n))
                codes.append(np.frombuffer(raw, "<u4", n, 8 * n))
                at = 14 * n
                for k in np.frombuffer(raw, "<u2", n, 12 * n).tolist():
                    texts.append(raw[at : at + k])
                    at += k
            got = answers(np.concatenate(docs_), np.concatenate(codes), texts, length)
            ends, fresh = np.cumsum([0, *table["n"].to_pylist()]), table["new"].to_pylist()
            pack = zstd.ZstdCompressor(level=1)
            masks = [pack.compress(got[a:b].astype("<u8").tobytes()) for a, b, own in zip(ends, ends[1:], fresh, strict=False) if own]
            own = table.filter(table["new"])
            return pa.table({"unit": own["unit"], "bucket": own["bucket"], "masks": pa.array(masks, pa.binary())})

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unpack = zstd.ZstdDecompressor()
            for r in _rows(batches):
                unit = Unit(r, length, buckets)
                masks = _by_bucket(r, "masks")
                starts = []
                for b, (_, _, g, answer) in unit.wanted(_by_bucket(r, "bits")).items():
                    got = np.append(np.frombuffer(unpack.decompress(masks[b]), "<u8"), np.uint64(2**64 - 1))[answer]  # -1: all
                    g, got = g[got != 0], got[got != 0]
                    n = unit.count[g]
                    run = np.repeat(np.arange(len(g)), n)
                    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    starts.append((unit.start[g][run] + k)[(got[run] >> k.astype(np.uint64)) & np.uint64(1) == 1])
                s, size = np.concatenate([*starts, np.zeros(0, np.int64)]), len(unit.raw) + 1
                gone = np.cumsum(np.bincount(s, minlength=size) - np.bincount(s + length, minlength=size))[:-1] > 0
                raw = np.frombuffer(unit.raw, np.uint8)
                out: list[list] = [[], [], [], [], []]
                for i, a, e in zip(unit.ids.tolist(), [0, *unit.ends[:-1].tolist()], unit.ends.tolist(), strict=True):
                    off = gone[a:e]
                    spans = int(off[:1].sum() + (off[1:] & ~off[:-1]).sum())
                    for col, x in zip(out, (i, e - a, int(off.sum()), spans, raw[a:e][~off].tobytes()), strict=True):
                        col.append(x)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

        def with_replies(folders: list[str], replies: DataFrame, at: str, how: str, *what: str) -> DataFrame:
            by_unit = replies.groupBy("unit").agg(F.collect_list(F.struct("bucket", *what)).alias("got"))
            return self._units(folders).join(F.broadcast(by_unit) if bytes_at(spark, at) <= SENT_BYTES else by_unit.hint("merge"), "unit", how)

        every = [new, *(u for level in self.levels for u in level.units)]
        runs = with_replies(every, hits, hits_at, "inner", "new", "bits").mapInArrow(send, "bucket int, unit string, new boolean, n int, runs binary")
        masks = runs.groupBy("bucket").applyInArrow(settle, "unit string, bucket int, masks binary")
        both = written(hits.filter("new").join(masks, ["unit", "bucket"]).select("unit", "bucket", "bits", "masks"), "masks", masks_at)
        return with_replies([new], both, masks_at, "left", "bits", "masks").mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _told(length: int, buckets: int):
    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            unit = Unit(r, length, buckets)
            got = [(b, *unit.codes(b)) for b in unit.groups]
            if got:
                yield _out(bucket=pa.array([b for b, *_ in got], pa.int32()), unit=[r["unit"]] * len(got), codes=[c.tobytes() for _, c, _ in got], many=[np.packbits(m).tobytes() for *_, m in got])

    return tell


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket's units, with bits for the minimisers that a document of the batch shares with another one."""
    codes = [np.frombuffer(c.as_py(), "<u8") for c in table["codes"]]
    many = [_unpacked(m.as_py(), len(c)) for c, m in zip(codes, table["many"], strict=True)]
    fresh = table["new"].to_pylist()
    twice = [c[m] for c, m, own in zip(codes, many, fresh, strict=True) if own]
    value, n = np.unique(np.concatenate([*codes, *twice]), return_counts=True)
    own = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c for c, own in zip(codes, fresh, strict=True) if own)]))
    value = np.intersect1d(value[n > 1], own, assume_unique=True)
    hits = [np.isin(c, value, assume_unique=True) for c in codes]
    keep = pa.array([i for i, h in enumerate(hits) if h.any()], pa.int64())
    return pa.table({"unit": table["unit"].take(keep), "bucket": table["bucket"].take(keep), "new": table["new"].take(keep), "bits": pa.array([np.packbits(hits[i]).tobytes() for i in keep.to_pylist()], pa.binary())})


def _by_bucket(row: dict, name: str) -> dict[int, bytes]:
    return {x["bucket"]: x[name] for x in row["got"] or ()}


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", unit_bytes: int = 4 << 20, buckets: int | None = None, batches: int = 2, index: SuffixIndex | None = None) -> DataFrame:
    """id, n_bytes, n_removed, n_spans long and kept binary (the bytes that stay) for every row of docs, which are added to a
    family in so many batches, cut at quantiles of the ids, those of smallest ids first; rows without an id go with the last."""
    index = index or SuffixIndex(docs.sparkSession, length=length, unit_bytes=unit_bytes, buckets=buckets)
    cuts = sorted(set(docs.agg(F.percentile_approx(id_col, [k / batches for k in range(1, batches)], 1000)).first()[0] or [])) if batches > 1 else []
    rank = F.coalesce(sum(((F.col(id_col) >= c).cast("int") for c in cuts), F.lit(0)), F.lit(len(cuts)))
    out = None
    for k in range(len(cuts) + 1):
        part = index.add(docs.filter(rank == k), id_col, text_col)
        out = part if out is None else out.unionByName(part)
    return out
