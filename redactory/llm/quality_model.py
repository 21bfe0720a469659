"""Quality classifier by co-training.

Two views of a document: its text (byte and hashed byte-pair frequencies and a few shares of words, of the whole
text) and its metadata (language, source, length). Each view has a logistic classifier. In every round both
score all unlabelled documents; the `exchange` documents each is surest of join, with its labels, the other view's
training set. Labels of less than 0.95 probability are not exchanged. Half of the labelled sample is held out of the
rounds: on it each view is calibrated and the calibrated views are combined by weights between 0 and 1. Every document
is then scored on its whole text.

Bounds of the fit: labelled_rows labelled documents, those with the smallest hashed ids, and rounds * exchange pseudo-
labels a view; nothing else is sampled. Fits run in one task, whose input these bounds hold; the driver gets the
weights. A document is rejected where its score lies below the threshold: 0.5, or lower if need be so that about
`most_lost` of the good documents fall below it. That quantile is read off an exponential tail fitted to the lowest
twentieth of the held-out good documents, so that one rule serves few documents and many.

Cases: null and empty texts have no bytes and no words, null metadata and categories that the sample lacks have a value
of their own; documents with equal ids are scored each by itself, and trained on by the least of their texts; with
fewer than two labelled documents of a class (an empty table, no labels) there is nothing to learn from: scores are
null and all are kept. Columns that clash with the new ones are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._common import written

PAIRS, SHARES, STEP = 1024, 5, 1 << 20
TEXT_SIZE = 256 + PAIRS + SHARES


def shares(text: str) -> list[float]:
    """Length, characters a word, and the shares of distinct words, words that repeat the one before them, and of the
    commonest word."""
    words = text.split()
    n, counts = max(1, len(words)), Counter(words)
    return [np.log1p(len(text)) / 10, len(text) / n / 10, np.log1p(len(counts)) / np.log1p(n), sum(map(eq, words, words[1:])) / n, max(counts.values(), default=0) / n]


def text_view(text: str) -> np.ndarray:
    """Square roots of byte frequencies and hashed byte-pair frequencies, then shares()."""
    raw = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(TEXT_SIZE, np.float32)
    for lo in range(0, len(raw), STEP):
        part = raw[lo : lo + STEP + 1]
        out[:256] += np.bincount(part[:STEP], minlength=256)
        pair = (part[:-1].astype(np.uint32) << np.uint32(8) | part[1:]) * np.uint32(2654435761) >> np.uint32(22)
        out[256:-SHARES] += np.bincount(pair, minlength=PAIRS)
    out = np.sqrt(out / max(len(raw), 1))
    out[-SHARES:] = shares(text)
    return out


def meta_view(rows: list[tuple], kinds: list[list[str]]) -> np.ndarray:
    """One-hot language, source (places in kinds, others first) and bit length of the number of characters."""
    places = [{k: i + 1 for i, k in enumerate(ks)} for ks in kinds]
    first = [0, 1 + len(kinds[0]), 2 + len(kinds[0]) + len(kinds[1])]
    out = np.zeros((len(rows), first[2] + 34), np.float32)
    for i, (lang, source, n_chars) in enumerate(rows):
        out[i, first[0] + places[0].get(lang, 0)] = out[i, first[1] + places[1].get(source, 0)] = 1
        out[i, first[2] + (33 if n_chars is None else min(32, max(int(n_chars), 0).bit_length()))] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Weights and a bias (last), by Nesterov's gradient method on standard-scaled columns."""
    mean, std = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-6
    z = np.empty((len(x), x.shape[1] + 1), np.float32)
    z[:, :-1], z[:, -1] = (x - mean.astype(np.float32)) / std.astype(np.float32), 1
    w = v = np.zeros(z.shape[1], np.float32)
    top = np.ones(z.shape[1], np.float32)
    for _ in range(30):  # the largest squared singular value, from below
        top = z.T @ (z @ top)
        norm = float(np.linalg.norm(top))
        top /= max(norm, 1e-12)
    rate = np.float32(4 / (1.1 * norm / len(z) + 4 * l2))
    y = y.astype(np.float32)
    for k in range(steps):
        g = z.T @ (sigmoid(z @ v) - y) / np.float32(len(y)) + np.float32(l2) * v
        new = v - rate * g
        v, w = new + np.float32(k / (k + 3)) * (new - w), new
    w = w.astype(np.float64)
    return np.append(w[:-1] / std, w[-1] - (w[:-1] / std) @ mean)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def margin(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def surest(ids: np.ndarray, score: np.ndarray, most: tuple[int, int], sure: float = 0.95) -> list[tuple[int, int, float]]:
    """(id, label, how sure) of at most most[label] documents a label: those of largest margin, `sure` at least."""
    out = []
    for label in (0, 1):
        side = score if label else -score
        at = np.flatnonzero(sigmoid(side) >= sure)
        at = at[np.lexsort((ids[at], -side[at]))][: most[label]]
        out += [(int(ids[i]), label, float(side[i])) for i in at]
    return out


def combined(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights in [0, 1] of calibrated log-odds (a column a view), with a bias: prior + sum of w * (odds - prior), the
    w of least log loss. A view that tells nothing has odds near the prior, so no weight makes it matter."""
    prior = np.log(y.mean() / (1 - y.mean()))
    best, least = (0.0, 0.0), np.inf
    for a in np.linspace(0, 1, 21):
        for b in np.linspace(0, 1, 21):
            z = prior + (odds - prior) @ (a, b)
            loss = np.logaddexp(0, np.where(y > 0, -z, z)).mean()
            if loss < least - 1e-9:
                best, least = (a, b), loss
    return np.array([*best, prior * (1 - sum(best))])


def tail_threshold(good: np.ndarray, most_lost: float, share: float = 0.05) -> float:
    """The log-odds below which about most_lost of the good lie, by an exponential tail below their lowest `share`."""
    low = np.sort(good)[: max(2, int(np.ceil(share * len(good))))]
    spread = max(float((low[-1] - low[:-1]).mean()), 1e-6) if len(low) > 1 else 1.0
    return float(low[-1]) - spread * max(0.0, float(np.log(len(low) / (most_lost * (len(good) + 1)))))


COLUMNS = {"id": "doc_id", "text": "text", "lang": "lang", "source": "source", "n_chars": "n_chars"}
FEATURES = "id long, y double, view int, text_x binary, lang string, source string, n_chars long"
WEIGHTS = "text binary, meta binary, scale binary, mix binary, threshold double, score binary, held binary"


def viewed(docs: DataFrame, cols: dict[str, str]) -> DataFrame:
    return docs.select(*(F.col(c).cast("long").alias(n) if n in ("id", "n_chars") else F.col(c).cast("string").alias(n) for n, c in cols.items()))


def features(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """FEATURES of the documents of ids (id, y, view), a bounded table; written."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([text_view(t.as_py() or "").tobytes() for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(n) if n != "text_x" else x for n in names], names)

    names = [f.split()[0] for f in FEATURES.split(", ")]
    rest = ["text", "lang", "source", "n_chars"]
    own = docs.join(F.broadcast(ids), "id").groupBy("id", "y", "view").agg(F.min(F.struct(*rest)).alias("d")).select("id", "y", "view", *(f"d.{c}" for c in rest))
    return written(own.mapInArrow(made, FEATURES), "features")


def trained(rows: DataFrame, kinds: list[list[str]], most_lost: float) -> dict:
    """The model from FEATURES rows: view -1 is held out, 0 and 1 are seen by that view alone, 2 by both. One task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        table = table.take(pa.array(np.lexsort((table["view"].to_numpy(), table["id"].to_numpy()))))
        y, view = table["y"].to_numpy(), table["view"].to_numpy()
        x = [np.frombuffer(b"".join(t.as_py() for t in table["text_x"]), np.float32).reshape(-1, TEXT_SIZE),
             meta_view(list(zip(*(table[c].to_pylist() for c in ("lang", "source", "n_chars")), strict=True)), kinds)]
        models = [logistic(v[(view == 2) | (view == k)], y[(view == 2) | (view == k)]) for k, v in enumerate(x)]
        held = view == -1
        out = [margin(m, v[held]) for m, v in zip(models, x, strict=True)]
        scale = [logistic(m[:, None], y[held]) for m in out]  # Platt's calibration of each view
        odds = np.column_stack([margin(s, m[:, None]) for s, m in zip(scale, out, strict=True)])
        mix = combined(odds, y[held])
        z = margin(mix, odds)
        threshold = min(0.5, float(sigmoid(tail_threshold(z[y[held] == 1], most_lost))))
        made = [models[0], models[1], np.array(scale), mix, threshold, sigmoid(z), y[held]]
        yield pa.RecordBatch.from_arrays([pa.array([m if isinstance(m, float) else np.asarray(m, np.float64).tobytes()]) for m in made], [f.split()[0] for f in WEIGHTS.split(", ")])

    got = rows.coalesce(1).mapInArrow(run, WEIGHTS).first().asDict()
    arrays = {k: v if isinstance(v, float) else np.frombuffer(bytes(v), np.float64) for k, v in got.items()}
    return arrays | {"scale": arrays["scale"].reshape(2, 2), "kinds": kinds, "held_out": (arrays.pop("score"), arrays.pop("held"))}


def margins(model: dict, texts: list[str], rows: list[tuple]) -> list[np.ndarray]:
    """Each view's own margin."""
    return [margin(model["text"], np.array([text_view(t) for t in texts])), margin(model["meta"], meta_view(rows, model["kinds"]))]


def exchanged(docs: DataFrame, model: dict, seen: DataFrame, most: tuple[int, int]) -> DataFrame:
    """(id, y, view): the documents that each view is surest of, for the other view. All but the seen ids are scored;
    each task, then each of 256 parts, passes on no more than the most that can be taken."""
    part = {k: model[k] for k in ("text", "meta", "kinds")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = [[], []]
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                texts = [t.as_py() or "" for t in b.column("text")]
                ids = b.column("id").to_numpy()
                for k, m in enumerate(margins(part, texts, list(zip(*(b.column(c).to_pylist() for c in ("lang", "source", "n_chars")), strict=True)))):
                    found[k] += surest(ids, m, most)
            for k in (0, 1):
                found[k] = [x for y in (0, 1) for x in sorted((f for f in found[k] if f[1] == y), key=lambda f: (-f[2], f[0]))[: most[y]]]
        for k in (0, 1):
            if found[k]:
                i, y, m = zip(*found[k], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(y, pa.float64()), pa.array([1 - k] * len(i), pa.int32()), pa.array(m, pa.float64())], ["id", "y", "view", "m"])

    new = docs.filter("id IS NOT NULL").join(F.broadcast(seen.select("id").distinct()), "id", "left_anti")
    got = new.mapInArrow(run, "id long, y double, view int, m double").withColumn("p", F.pmod(F.xxhash64("id"), F.lit(256)))
    room = F.when(F.col("y") == 1, most[1]).otherwise(most[0])
    for by in (["view", "y", "p"], ["view", "y"]):
        got = got.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("m"), "id"))).filter(F.col("r") <= max(most)).filter(F.col("r") <= room)
    return got.select("id", "y", "view").distinct()


def fit(docs: DataFrame, labels: DataFrame, cols: dict[str, str] = COLUMNS, label_col: str = "quality", labelled_rows: int = 4000, rounds: int = 2, exchange: int = 200, most_lost: float = 0.002) -> dict | None:
    """text, meta (weights), kinds, scale, mix (of the calibrated margins, with bias), threshold, held_out; None where
    a class has fewer than two labelled documents."""
    docs = viewed(docs, cols)
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min(F.col(label_col).cast("double")).alias("y"))
    known = known.join(docs.select("id").distinct().hint("merge"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(labelled_rows)
    # the halves alternate within a class in the order of hashed ids, so that each has its share of both
    turn = F.row_number().over(W.partitionBy("y").orderBy(F.xxhash64("id"), "id"))
    known = written(known.select("id", "y", F.when(turn % 2 == 0, -1).otherwise(2).alias("view")), "labelled")
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if min(count.get(0.0, 0), count.get(1.0, 0)) < 2:
        return None
    rows = features(docs, known)
    kinds = [sorted(r[0] for r in rows.select(c).distinct().collect() if r[0] is not None) for c in ("lang", "source")]  # labelled_rows at most
    bad = max(1, round(exchange * count[0.0] / (count[0.0] + count[1.0])))
    for _ in range(rounds):
        model = trained(rows, kinds, most_lost)
        rows = rows.unionByName(features(docs, exchanged(docs, model, rows, (bad, max(1, exchange - bad)))))
    return trained(rows, kinds, most_lost)


def score(docs: DataFrame, model: dict | None, cols: dict[str, str] = COLUMNS, keep: list[str] | None = None) -> DataFrame:
    """The columns keep (all of docs' if not given) with p_text, p_meta, score double and kept boolean, in place of
    columns of those names."""
    new = ["p_text", "p_meta", "score", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    if model is None:
        return docs.select(*keep, *(F.lit(None).cast("double").alias(c) for c in new[:3]), F.lit(True).alias("kept"))
    need = list(dict.fromkeys([*keep, *cols.values()]))
    part = {k: model[k] for k in ("text", "meta", "kinds", "scale", "mix", "threshold")}

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part_b = b.slice(lo, 512)
                get = lambda n: part_b.column(cols[n]).to_pylist()  # noqa: B023, E731
                own = margins(part, [t or "" for t in get("text")], list(zip(get("lang"), get("source"), get("n_chars"), strict=True)))
                m = [margin(s, v[:, None]) for s, v in zip(part["scale"], own, strict=True)]
                p = sigmoid(margin(part["mix"], np.column_stack(m)))
                yield pa.RecordBatch.from_arrays([*(part_b.column(c) for c in keep), *(pa.array(v) for v in (sigmoid(m[0]), sigmoid(m[1]), p, p >= part["threshold"]))], [*keep, *new])

    fields = {f.name: f for f in docs.schema.fields}
    schema = type(docs.schema)([fields[c] for c in keep]).add("p_text", "double").add("p_meta", "double").add("score", "double").add("kept", "boolean")
    return docs.select(*need).mapInArrow(scored, schema)
