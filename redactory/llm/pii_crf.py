"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone). A CRF adds spans: its nodes are the words that hold a
digit or an "@", its labels the four kinds and "other". A node's own potentials come from its shape, from whether its
digits pass Luhn's test or are four octets, and from the word before it. Chain edges join nodes that stand at most two
words apart. Skip edges join nodes that share a key, however far away: the same digits, the same last seven digits, the
same word, or the part of an address before its "@" (six characters at least). They run through one shared node a key,
so a token repeated n times has n edges and every repeat is two steps from every other. Words inside base spans are
observed; loopy belief propagation carries their labels along both kinds of edges until the messages settle, so that
equal and similar tokens are labelled alike throughout the document. A word outside all base spans is added where its
marginal for a kind is at least `sure`.

Weights are fitted by pseudo-likelihood (softmax regression on a node's own features, its neighbours' base labels and
the commonest label of other nodes with its key) on a bounded sample: the nodes of fit_docs documents with the smallest
hashed ids, fit_nodes nodes at most.

Cases: null and empty texts have no spans; texts of any length are read whole, and every pattern takes time linear
in the text; equal rows get equal spans; where the sample has no base span nothing is added; offsets are code
points, end exclusive. An empty table gives no rows. Columns besides the id and the text are not read; null ids stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import count, islice, takewhile
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A match that starts inside a run of digits exists only where one from the run's start does.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^ \x09-\x0D]*[0-9@][^ \x09-\x0D]*")
NODE = re.compile(r"[^ \x09-\x0D]+")
EDGES = "\"'()[]{}<>,;:!?*#$%&|."
FEATURES, LABELS = 196, 5


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    odd, even = map(int, digits[::-1][::2]), (int(d) for d in digits[::-1][1::2])
    return (sum(odd) + sum(2 * d - 9 * (d > 4) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted; kind is an index of KINDS."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def node_features(word: str, before: str) -> list[int]:
    """Indices below FEATURES of a word's shape, what its digits are, and the word before it."""
    own = "".join(filter(str.isdecimal, word))
    digits, letters = len(own), sum(map(str.isalpha, word))
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "0", word)))[:24]
    parts = word.split(".")
    octets = len(parts) == 4 and all(x.isascii() and x.isdecimal() and len(x) < 4 and int(x) < 256 for x in parts)
    card = 14 <= digits <= 19 and not letters and own.isascii() and luhn(own)
    return [min(digits, 20), 21 + min(letters, 10), 32 + min(word.count("."), 4), 37 + min(word.count("-"), 4), 42 + word.startswith("+"), 44 + ("@" in word), 46 + min(len(word) // 2, 15), 64 + crc32(shape.encode()) % 64,
            128 + card, 130 + octets, 132 + crc32(before.lower().encode()) % 64]


def keys_of(word: str) -> list[str]:
    """What makes two nodes similar."""
    low, digits = word.lower(), "".join(filter(str.isdecimal, word))
    out = [low] if len(low) >= 6 else []
    if len(low.partition("@")[0]) >= 6 and "@" in low:
        out.append(low.partition("@")[0])
    if len(digits) >= 6 and not any(map(str.isalpha, word)):
        out += ["=" + digits, *(["~" + digits[-7:]] if len(digits) >= 7 else [])]
    return out


def graph(text: str, base: list[tuple[int, int, int]]) -> tuple[list, list, list, list]:
    """Nodes (start, end, features), their observed labels (0 outside base spans, else kind + 1), chain edges, and the
    groups of nodes that share a key."""
    nodes, label, chain, groups, b = [], [], [], {}, 0
    before = None
    for m in WORD.finditer(text):
        start, end = m.span()
        while start < end and text[start] in EDGES:
            start += 1
        while end > start and text[end - 1] in EDGES:
            end -= 1
        if start == end:
            continue
        while b < len(base) and base[b][2] <= start:
            b += 1
        near = takewhile(lambda x, end=end: x[0] < end, islice(base, b, None))  # spans ascend by start
        seen = next((k + 1 for _, k, e in near if start < e), 0)
        word, i = text[start:end], len(nodes)
        lead = text[max(0, start - 40) : start].split()
        nodes.append((start, end, node_features(word, lead[-1] if lead else "")))
        label.append(seen)
        if before is not None and len(gap := text[before[1] : start]) <= 40 and len(gap.split()) <= 1:
            chain.append((before[0], i))
        before = (i, m.end())
        for key in keys_of(word):
            groups.setdefault(key, []).append(i)
    return nodes, label, chain, [g for g in groups.values() if len(g) > 1]


def neighbours(label: list[int], chain: list, groups: list) -> list[tuple[list[int], list[int]]]:
    """Of each node the labels of its chain neighbours, and of each of its groups the commonest label of the others."""
    near: list = [([], []) for _ in label]
    for x, y in chain:
        near[x][0].append(label[y])
        near[y][0].append(label[x])
    for g in groups:
        n = np.bincount([label[i] for i in g], minlength=LABELS)
        for i in g:
            n[label[i]] -= 1
            near[i][1].append(int(n[1:].argmax()) + 1 if n[1:].any() else 0)
            n[label[i]] += 1
    return near


def fit(rows: list[tuple[list[int], int, list[int], list[int]]], steps: int = 800, l2: float = 1e-4) -> dict | None:
    """Weights from (features, label, chain neighbours' labels, skip neighbours' labels) of nodes."""
    if not any(r[1] for r in rows):
        return None
    x = np.zeros((len(rows), FEATURES + 2 * LABELS))
    for i, (f, _, c, s) in enumerate(rows):
        x[i, f] = 1
        np.add.at(x[i], [FEATURES + k for k in c], 1)
        np.add.at(x[i], [FEATURES + LABELS + k for k in s], 1)
    y = np.eye(LABELS)[[r[1] for r in rows]]
    w = v = np.zeros((x.shape[1], LABELS))
    rate = 2 / (np.linalg.norm(x, 2) ** 2 / len(x) + 2 * l2)
    for k in range(steps):
        z = x @ v
        p = np.exp(z - z.max(1, keepdims=True))
        new = v - rate * (x.T @ (p / p.sum(1, keepdims=True) - y) / len(y) + l2 * v)
        v, w = new + k / (k + 3) * (new - w), new
    pair = [w[a : a + LABELS] for a in (FEATURES, FEATURES + LABELS)]
    return {"own": w[:FEATURES], "chain": (pair[0] + pair[0].T) / 2, "skip": (pair[1] + pair[1].T) / 2}


def marginals(own: np.ndarray, chain: np.ndarray, skip: np.ndarray, model: dict, damping: float = 0.3, settled: float = 1e-4) -> np.ndarray:
    """Loopy sum-product over log potentials own (nodes x labels) and edges (pairs of node indices), until no message
    changes by more than `settled`. Messages are damped ever more, from round 500 on by a fixed share a round, so that
    circles come to rest: a step is then smaller than `settled` after some 700 rounds more, whatever the potentials."""
    edges = np.concatenate([chain.reshape(-1, 2), skip.reshape(-1, 2)]).astype(np.int64)
    src, dst = np.concatenate([edges, edges[:, ::-1]]).T
    kind = np.tile(np.repeat([0, 1], [len(chain), len(skip)]), 2)
    pair = np.exp(np.clip(np.stack([model["chain"], model["skip"]]), -10, 10))[kind]
    back = np.roll(np.arange(len(src)), len(edges))
    msg = np.full((len(src), LABELS), -np.log(LABELS))
    belief = own + np.stack([np.bincount(dst, msg[:, k], len(own)) for k in range(LABELS)], 1)
    for turn in count() if len(edges) else ():
        into = belief[src] - msg[back]
        into = np.exp(into - into.max(1, keepdims=True))
        new = np.log(np.einsum("ea,eab->eb", into, pair) + 1e-300)
        new -= np.log(np.exp(new - new.max(1, keepdims=True)).sum(1, keepdims=True)) + new.max(1, keepdims=True)
        keep = 1 - (1 - damping) / (1 + turn / 100) * 0.99 ** max(0, turn - 500)
        new = keep * msg + (1 - keep) * new
        change, msg = np.abs(np.exp(new) - np.exp(msg)).max(), new
        belief = own + np.stack([np.bincount(dst, msg[:, k], len(own)) for k in range(LABELS)], 1)
        if change < settled:
            break
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added(graphs: list[tuple], model: dict | None, sure: float) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind, end) that the field adds in each document of a chunk; all documents form one graph."""
    out: list = [[] for _ in graphs]
    first = np.cumsum([0, *(len(g[0]) for g in graphs)])
    if model is None or not first[-1]:
        return out
    label = np.array([k for g in graphs for k in g[1]])
    own = np.array([model["own"][n[2]].sum(0) for g in graphs for n in g[0]])
    own[label > 0] = -30
    own[label > 0, label[label > 0]] = 30
    chain = np.array([(a + f, b + f) for g, f in zip(graphs, first, strict=False) for a, b in g[2]], np.int64).reshape(-1, 2)
    groups = [(f, x) for g, f in zip(graphs, first, strict=False) for x in g[3]]
    skip = np.array([(i + f, first[-1] + h) for h, (f, x) in enumerate(groups) for i in x], np.int64).reshape(-1, 2)
    p = marginals(np.concatenate([own, np.zeros((len(groups), LABELS))]), chain, skip, model)[: first[-1]]
    for i in np.flatnonzero((label == 0) & (p[:, 1:].max(1) >= sure)):
        d = int(np.searchsorted(first, i, "right")) - 1
        start, end, _ = graphs[d][0][i - first[d]]
        out[d].append((start, int(p[i, 1:].argmax()), end))
    return out


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = 1500, fit_nodes: int = 20_000) -> dict | None:
    texts = _texts(docs, id_col, text_col)
    ids = texts.select("id").filter(F.col("text").rlike("[0-9@]")).orderBy(F.xxhash64("id"), "id").limit(fit_docs)
    chosen = texts.join(F.broadcast(ids), "id", "left_semi")  # fit_docs ids at most

    def nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = []
            for i, t in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
                t = t.as_py()
                own, label, chain, groups = graph(t, base_spans(t))
                near = neighbours(label, chain, groups)
                out += [{"id": i, "at": n[0], "f": n[2], "y": y, "c": c, "s": s} for n, y, (c, s) in zip(own, label, near, strict=True)]
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("id", pa.int64()), ("at", pa.int64()), ("f", pa.list_(pa.int32())), ("y", pa.int32()), ("c", pa.list_(pa.int32())), ("s", pa.list_(pa.int32()))]))

    got = chosen.mapInArrow(nodes, "id long, at long, f array<int>, y int, c array<int>, s array<int>").orderBy(F.xxhash64("id", "at"), "id", "at").limit(fit_nodes).collect()
    return fit([(r["f"], r["y"], r["c"], r["s"]) for r in got])


def find_pii(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", sure: float = 0.95) -> DataFrame:
    """id, base and spans: array<struct<kind string, start int, end int>> by start, then kind as in KINDS."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)]
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                texts = [t.as_py() for t in part.column("text")]
                base = [base_spans(t) for t in texts]
                more = added([graph(t, s) for t, s in zip(texts, base, strict=True)], model, sure)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([told(s) for s in base], span), pa.array([told(s + m) for s, m in zip(base, more, strict=True)], span)], ["id", "base", "spans"])

    kind = "array<struct<kind:string,start:int,end:int>>"
    return _texts(docs, id_col, text_col).mapInArrow(found, f"id long, base {kind}, spans {kind}")


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
