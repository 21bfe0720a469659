"""Links between texts by the Jaccard index of their shingle sets, and the components that links make.

linked() starts from buckets: rows (bucket, node) that a sketch puts together. It goes in two steps, so that no bucket
emits its pairs and no link is lost:

1. The star. In each bucket every row is compared, on whole sets, with one elected row; rows that are elected once tend
   to be elected in other buckets too. A bucket gives pairs in proportion to its rows.
2. The rest, exactly. A bucket whose rows are then of more than one component may hide links between rows that are not
   the elected one. All rows of such buckets go through a prefix filter: shingles are ordered by how many of these
   sets hold them, rarest first, and two sets can only reach the index if they share one of their first shingles, as many
   as the index leaves free. Pairs of one component are left out, and the others must pass exact bounds (set sizes,
   places of the shared shingle, differing bits of a parity bitmap) before whole sets are compared. A shingle
   that very many sets begin with is dealt in blocks, each pair of blocks a unit of work.

So every pair that shares a bucket and reaches the index ends in one component; which pairs share a bucket is the
sketch's part, and its docstring states the chance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import dropped, kept, shared_path, skew_join, written

#: Ids of 8 bytes each that are sent to every task instead of being shuffled.
SENT = 500_000
#: Edges whose components are found in one task.
SMALL = 1_000_000
#: Rows of a block of a frequent shingle, and 64-bit words of a parity bitmap.
UNIT, WORDS = 2048, 16


def shingle_hashes(text: str, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """The XXH64 of each shingle in turn; none where there is no word."""
    words = text.encode().lower().split()  # bytes.lower() and bytes.split() know A-Z and \x09-\x0D, space only
    if not words:
        return np.zeros(0, np.uint64)
    hash_of = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return np.array([hash_of(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    return np.fromiter((hash_of(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), np.uint64, n)


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """The distinct ones, sorted; a blank text has one element, zero, so that blank texts are equal."""
    return np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)


def _then_none(items: Iterable) -> Iterator:
    yield from items
    yield None


def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """components() of all edges in one pass."""
    parts = [[b.column(c).to_numpy() for c in ("a", "b")] for b in batches]
    if not parts:
        return
    a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
    name, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(name)))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        i, j = find(i), find(j)
        up[max(i, j)] = min(i, j)
    least = np.fromiter((find(i) for i in range(len(up))), np.int64, len(up))
    own = np.flatnonzero(least != np.arange(len(up)))
    yield pa.RecordBatch.from_arrays([pa.array(name[own]), pa.array(name[least[own]])], ["node", "component"])


def components(edges: DataFrame, most_rounds: int = 60, small: int = SMALL) -> DataFrame:
    """node, component (its smallest reachable node) for every node of edges (a, b), b < a, that reaches a smaller one.

    Up to `small` edges, of 16 bytes each, are joined in one task; more of them in rounds of distributed stars."""
    edges, before = kept(edges), None
    if edges.count() <= small:
        return edges.coalesce(1).mapInArrow(joined, "node long, component long")
    for _ in range(most_rounds):
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
        # large-star: larger neighbours of a node go to its smallest one
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        # small-star: a node and its smaller neighbours go to the smallest of those
        star = kept(star)
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        small_star = star.join(least.hint("merge"), "a")
        edges = kept(small_star.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").union(least.select("a", "m")).distinct())
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")


def named(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (node, least, ...) with component: the smallest `least` that a chain of edges reaches."""
    found = nodes.join(components(edges).hint("merge"), "node", "left").withColumn("_c", F.coalesce("component", "node")).drop("component")
    found = kept(found)
    linked = found.filter("_c <> node").select("_c").distinct()  # most nodes stand alone
    best = kept(found.join(linked.hint("merge"), "_c", "left_semi").groupBy("_c").agg(F.min("least").alias("component"), F.count("*").alias("_n")))
    together = skew_join(found, best, "_c", "_n").drop("_n")
    alone = found.join(best.select("_c").hint("merge"), "_c", "left_anti").withColumn("component", F.col("least"))
    return together.unionByName(alone).drop("_c")


def verified(pairs: DataFrame, own: DataFrame, shingle: int, least: tuple[int, int], salts: int = 64) -> DataFrame:
    """The distinct pairs (a, b) of rows of own whose whole sets have a Jaccard index of least[0] / least[1] or more; kept.

    The set of b stands once before those of its many a; it is held, they stream by. A b of very many pairs is dealt
    to as many as `salts` places."""
    p, q = least

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                b = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([shingle_set(shingle_hashes(t.as_py() or "", shingle)).tobytes() for t in b.column("text")], pa.binary())], ["node", "bits"])

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b, bits) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("bits"), strict=True)):
                own_set = np.frombuffer(bits.as_buffer(), np.uint64)
                if a is None:
                    at, held = b, own_set.copy()
                    continue
                if at != b:
                    raise ValueError("a pair came without its other set")
                n, m = len(own_set), len(held)
                if q * min(n, m) >= p * max(n, m):
                    both = len(np.intersect1d(own_set, held, assume_unique=True))
                    keep[i] = q * both >= p * (n + m - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    pairs = kept(pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(salts)).alias("salt")))
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    few = pairs.count() < SENT
    sets = own.join(F.broadcast(nodes) if few else nodes.hint("merge"), own["row"] == nodes["node"]).select("node", "text")
    path = shared_path(own.sparkSession, "sets")
    sets = written(sets.mapInArrow(hashed, "node long, bits binary"), "sets", path)
    told = pairs.join(sets.withColumnRenamed("node", "a").hint("merge"), "a").select("a", "b", "salt", "bits")
    heads = pairs.select("b", "salt").distinct().join(sets.withColumnRenamed("node", "b").hint("merge"), "b")
    heads = heads.select(F.lit(None).cast("long").alias("a"), "b", "salt", "bits")
    both = told.unionByName(heads).repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    out = kept(both.mapInArrow(compared, "a long, b long"))
    dropped(own.sparkSession, path)
    return out


def parity(tokens: np.ndarray) -> bytes:
    """The parity of the tokens that fall on each of 64 * WORDS bits: differing bits of two are at most as many as
    tokens that only one of both sets has."""
    n = np.bincount((tokens % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS)
    return np.packbits((n & 1).astype(np.uint8), bitorder="little").tobytes()


def near_pairs(node: np.ndarray, comp: np.ndarray, size: np.ndarray, place: np.ndarray, bits: np.ndarray, first: np.ndarray, second: np.ndarray, least: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b) of the pairs of one row of first and one of second (row numbers) that the bounds allow: of different
    components, of sizes, places of the shared token and bitmaps that let them reach the index."""
    p, q = least
    for i in first.tolist():
        j = second[second > i] if first is second else second
        j = j[comp[j] != comp[i]]
        j = j[q * np.minimum(size[j], size[i]) >= p * np.maximum(size[j], size[i])]
        both = size[j] + size[i]
        j = j[(p + q) * np.minimum(size[j] - place[j], size[i] - place[i]) >= p * both]
        if len(j):
            differ = np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64)
            j = j[(p + q) * differ <= (q - p) * (size[j] + size[i])]
        if len(j):
            yield np.maximum(node[j], node[i]), np.minimum(node[j], node[i])


def completed(open_nodes: DataFrame, own: DataFrame, shingle: int, least: tuple[int, int]) -> DataFrame:
    """Candidate pairs (a, b), b < a, distinct: every pair of open_nodes (node, g) of different g that reaches the index is
    among them. own has the rows' texts (row, text)."""
    p, q = least

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                b = batch.slice(lo, 500)
                sets = [shingle_set(shingle_hashes(t.as_py() or "", shingle)) for t in b.column("text")]
                tokens = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b["node"], b["g"], pa.array(list(map(len, sets)), pa.int32()), pa.array(list(map(parity, sets)), pa.binary()), tokens], ["node", "g", "size", "bits", "tokens"])

    few = open_nodes.count() < SENT
    texts = own.join(F.broadcast(open_nodes) if few else open_nodes.hint("merge"), own["row"] == open_nodes["node"]).select("node", "g", "text")
    path = shared_path(own.sparkSession, "open_sets")
    sets = written(texts.mapInArrow(hashed, "node long, g long, size int, bits binary, tokens array<long>"), "open_sets", path)
    # shingles that only one set has come first in every set, and cannot be shared
    tokens = sets.select("node", F.explode("tokens").alias("h"))
    df = kept(tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"))
    shared = skew_join(tokens, df, "h", "df").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("s"))
    free = F.expr(f"size - int(({p}L * size + {q - 1}) div {q}) + 1")  # a set's first shingles, one more than it may lack
    alone = F.col("size") - F.size("s")
    prefix = sets.select("node", "g", "size", "bits").join(shared.hint("merge"), "node").withColumn("alone", alone)
    prefix = prefix.filter(free > F.col("alone")).select("node", "g", "size", "bits", "alone", F.posexplode(F.slice("s", F.lit(1), free - F.col("alone"))).alias("k", "x"))
    posts = written(prefix.select(F.col("x.h").alias("h"), "node", "g", "size", (F.col("alone") + F.col("k")).alias("place"), "bits"), "posts")
    lists = kept(posts.groupBy("h").agg(F.count("*").alias("m"), F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi").select("h", "m"))
    dealt = skew_join(posts, lists, "h", "m").withColumn("blocks", F.expr(f"int((m + {UNIT - 1}) div {UNIT})"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    units = dealt.select("h", F.least("block", "other").alias("u"), F.greatest("block", "other").alias("v"), "block", "node", "g", "size", "place", "bits")

    def paired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _then_none(batches):
            if batch is not None:
                cols = [batch[c].to_numpy(zero_copy_only=False) for c in ("h", "u", "v", "block", "node", "g", "size", "place")]
                cols.append(np.frombuffer(b"".join(batch["bits"].to_pylist()), "<u8").reshape(-1, WORDS))
                held = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if held is None or not len(held[0]):
                continue
            h, u, v = held[:3]
            cut = np.concatenate([[0], np.flatnonzero((h[1:] != h[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])) + 1, [len(h)]])
            whole = len(cut) - 2 if batch is not None else len(cut) - 1  # the last unit may go on
            out = []
            for k in np.flatnonzero(np.diff(cut[: whole + 1]) > 1):
                at = slice(cut[k], cut[k + 1])
                block, node, g, size, place, bits = (x[at] for x in held[3:])
                if u[cut[k]] == v[cut[k]]:
                    first = second = np.arange(len(node))
                else:
                    first, second = (np.flatnonzero(block == b) for b in (u[cut[k]], v[cut[k]]))
                out += near_pairs(node, g, size.astype(np.int64), place.astype(np.int64), bits, first, second, least)
            held = [x[cut[whole] :] for x in held]
            if out:
                a, b = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    pairs = kept(units.repartition("h", "u", "v").sortWithinPartitions("h", "u", "v").mapInArrow(paired, "a long, b long").distinct())
    dropped(own.sparkSession, path)
    return pairs


def ordered(pairs: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) with b < a."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def linked(rows: DataFrame, own: DataFrame, shingle: int, least: tuple[int, int], more: DataFrame | None = None) -> DataFrame:
    """Links (a, b), b < a, that join every two nodes that share a bucket of rows (bucket, node) and whose sets have a
    Jaccard index of least[0] / least[1] or more. more: further candidate pairs (a, b). own: (row, text) of all nodes."""
    rows = written(rows, "buckets")
    lead = F.min(F.struct(F.xxhash64("node").alias("lot"), "node"))["node"]
    centers = kept(rows.groupBy("bucket").agg(F.count("*").alias("n"), lead.alias("center")).filter("n > 1"))
    rows = written(skew_join(rows, centers, "bucket", "n").select("bucket", "node", "center"), "buckets")
    star = rows.filter("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b"))
    tried = kept((star.union(more) if more is not None else star).distinct())
    edges = verified(tried, own, shingle, least)
    group = components(ordered(edges))
    told = written(rows.select("bucket", "node").join(group.hint("merge"), "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("g")), "told")
    open_ = kept(told.groupBy("bucket").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("bucket", "n"))
    open_nodes = kept(skew_join(told, open_, "bucket", "n").select("node", "g").distinct())
    if open_nodes.isEmpty():
        return ordered(edges)
    new = completed(open_nodes, own, shingle, least).join(ordered(tried).hint("merge"), ["a", "b"], "left_anti")
    return ordered(kept(edges.union(verified(new, own, shingle, least))))
