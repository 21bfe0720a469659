"""Byte-level BPE by length-bucketed padded numpy matrices.

Texts are cut by the tokenizer's pattern. The distinct pieces of a chunk that the worker has not met yet are put
into matrices of token ids by length, padded to the bucket's width. In each round every row merges its leftmost
pair of least rank; pairs are looked up in an open-addressing hash table held in two arrays, rows that have no
pair left are written out, and the others are moved up (compaction). Pieces over LONG bytes, which a matrix would
merge in quadratic time, go through a heap of pairs instead, in the same order of merges.

Cases: null texts are empty and have no ids; texts of any length are cut piecewise; ids decode to the exact
UTF-8 bytes; equal rows are encoded alike; an empty table gives no rows; all columns of the input stay as they
are, and ids / decoded replace columns of those names.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NONE, LONG, CACHED, CHUNK = np.int32(2**31 - 1), 256, 300_000, 400_000
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"  # all letters among the characters that PLAIN leaves
PLAIN = re.compile(r"[^\t\n\r -~À-ɏ]")
EMPTY = np.uint64(2**64 - 1)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts without a match of PLAIN, where \\p{L} and \\p{N} are short lists; re runs it faster."""
    inner = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9"), pattern)
    plain = inner.replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", "[0-9]")
    return None if r"\p" in plain.lower() else re.compile(plain)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """rank of a pair of ids, for arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {(ranks[t[:i]] << 32) | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        keys, values = np.fromiter(found, np.uint64, len(found)), np.fromiter(found.values(), np.int32, len(found))
        self.bits = max(4, int(len(found) * 3).bit_length())
        self.keys, self.values = np.full(1 << self.bits, EMPTY), np.full(1 << self.bits, NONE)
        left, self.probes = np.arange(len(keys)), 0
        while left.size:
            slot = (self.slot(keys[left]) + self.probes) & ((1 << self.bits) - 1)
            free = self.keys[slot] == EMPTY
            self.keys[slot[free]] = keys[left[free]]  # of keys that want one slot the last gets it
            won = self.keys[slot] == keys[left]
            self.values[slot[won]] = values[left[won]]
            left, self.probes = left[~won], self.probes + 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * GOLD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = ((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)).ravel()
        slot, out, todo = self.slot(keys), np.full(keys.size, NONE), None
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == keys
            if todo is None:
                out[hit] = self.values[slot[hit]]
                todo = np.flatnonzero(~hit & (there != EMPTY))
            else:
                out[todo[hit]] = self.values[slot[hit]]
                todo = todo[~hit & (there != EMPTY)]
            if not todo.size:
                break
            keys, slot = keys[~hit & (there != EMPTY)], (slot[~hit & (there != EMPTY)] + 1) & ((1 << self.bits) - 1)
        return out.reshape(a.shape)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.cut, self.pairs, self.ranks = regex.compile(pattern), PairTable(ranks), ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.token[r] = t
        self.plain = plain_pattern(pattern)
        self.blob = np.frombuffer(b"".join(self.token), np.uint8)
        self.size = np.fromiter(map(len, self.token), np.int64, len(self.token))
        self.start = np.cumsum(self.size) - self.size
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        return (self.plain if self.plain and not PLAIN.search(text) else self.cut).findall(text)

    def merged(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids and lengths after all merges; rows of ids are padded with -1 after n ids."""
        out, out_n, row = np.full_like(ids, -1), n.copy(), np.arange(len(ids))
        at = np.arange(ids.shape[1])
        ranks = np.full(ids.shape, NONE)
        ranks[:, :-1] = self.pairs.get(ids[:, :-1] & 0xFFFFFF, ids[:, 1:] & 0xFFFFFF)
        ranks[at[None, :] >= (n - 1)[:, None]] = NONE
        while True:
            j = ranks.argmin(1)
            best = ranks[np.arange(len(row)), j]
            live = best != NONE
            if not live.all():
                done = ~live
                out[row[done], : ids.shape[1]], out_n[row[done]] = ids[done], n[done]
                ids, n, row, ranks, j, best = ids[live], n[live], row[live], ranks[live], j[live], best[live]
            if not len(row):
                return out, out_n
            n = n - 1
            width = int(n.max())
            k = np.arange(len(row))
            ids[k, j] = best
            src = at[:width] + (at[:width] > j[:, None])  # what stands right of the pair moves up
            ids = np.take_along_axis(ids, src, 1)
            ranks = np.take_along_axis(ranks, src, 1)
            for d in (0, -1):  # only the pairs that the new id is part of have changed
                p = j + d
                ok = (p >= 0) & (p < n - 1)
                ranks[k[(p >= 0) & (p < width) & ~ok], p[(p >= 0) & (p < width) & ~ok]] = NONE
                ranks[k[ok], p[ok]] = self.pairs.get(ids[k[ok], p[ok]], ids[k[ok], p[ok] + 1])

    def heaped(self, piece: bytes) -> bytes:
        """A long piece: pairs wait in a heap by rank, then place; entries whose pair has changed are skipped."""
        part = [piece[i : i + 1] for i in range(len(piece))]
        after, before = [*range(1, len(part)), -1], [*range(-1, len(part) - 1)]
        rank = lambda i: self.ranks.get(part[i] + part[after[i]]) if after[i] >= 0 else None
        heap = [(r, i) for i in range(len(part)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if part[i] is None or rank(i) != r:
                continue
            k = after[i]
            part[i], after[i], part[k] = part[i] + part[k], after[k], None
            if after[i] >= 0:
                before[after[i]] = i
            for x in (i, before[i]):
                if x >= 0 and (r := rank(x)) is not None:
                    heapq.heappush(heap, (r, x))
        return np.array([self.ranks[p] for p in part if p is not None], "<u4").tobytes()

    def learn(self, pieces: Iterable[str]) -> None:
        """Encodes pieces that are not known yet."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode()
            if len(b) > LONG:
                self.known[p] = self.heaped(b)
            else:
                buckets.setdefault(-(-len(b) // 4), []).append((p, b))
        for width, rows in buckets.items():
            for lo in range(0, len(rows), step := max(1, (1 << 18) // (4 * width))):
                part = rows[lo : lo + step]
                n = np.fromiter((len(b) for _, b in part), np.int64, len(part))
                raw = np.frombuffer(b"".join(b.ljust(4 * width, b"\0") for _, b in part), np.uint8).reshape(len(part), -1)
                ids, n = self.merged(self.of_byte[raw], n)
                flat, w = ids.astype("<u4").tobytes(), 16 * width
                self.known.update((p, flat[i * w : i * w + 4 * k]) for i, ((p, _), k) in enumerate(zip(part, n.tolist(), strict=True)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit integers."""
        cut = [self.pieces(t) for t in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        self.learn(set().union(*cut).difference(self.known))
        return [b"".join(map(self.known.__getitem__, p)) for p in cut]

    def encode_long(self, text: str) -> bytes:
        pieces, out = self.cut.finditer(text), []
        while part := [m[0] for m in islice(pieces, CHUNK // 4)]:
            if len(self.known) > CACHED:
                self.known.clear()
            self.learn(set(part).difference(self.known))
            out.append(b"".join(map(self.known.__getitem__, part)))
        return b"".join(out)

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids, gathered for all of them at once."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = self.size[flat]
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = self.blob[np.repeat(self.start[flat] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One a worker process and vocabulary."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def byte_bpe(df: DataFrame, path: str, pattern: str, text_col: str = "text", decode: bool = True, keep: list[str] | None = None) -> DataFrame:
    """The columns keep (all of df's if not given), ids binary (little-endian unsigned 32-bit) and, if asked for,
    decoded binary (ids turned back into bytes)."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("ids", "decoded")]
    new = ["ids", *["decoded"] * decode]
    types = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*(types[c] for c in keep), *(T.StructField(c, T.BinaryType()) for c in new)])

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            lo, texts, sizes = 0, batch.column(text_col), batch.column(text_col)
            sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in texts]
            while lo < batch.num_rows:  # about CHUNK bytes of text at a time
                hi, size = lo + 1, sizes[lo]
                while hi < batch.num_rows and size + sizes[hi] <= CHUNK:
                    size, hi = size + sizes[hi], hi + 1
                part = [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]
                ids = bpe.encode(part) if size <= 4 * CHUNK else [bpe.encode_long(t) for t in part]
                got = [ids] + ([bpe.decode(ids)] if decode else [])
                own = [batch.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays(own + [pa.array(x, pa.binary()) for x in got], [*keep, *new])
                lo = hi

    return df.select(*dict.fromkeys([*keep, text_col])).mapInArrow(coded, schema)
