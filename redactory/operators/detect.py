"""Detection of vocabulary in transcripts.

words: (id, seg, idx, word, start_time, end_time), idx running over the whole conversation.
matches: (id, word_idx, n_words, text, category, start_time, end_time, confidence, is_fuzzy).

Words are shuffled once, by conversation. In one pass over its words in order, phrases are looked up in the broadcast
vocabulary where a word opens a term, and words that may be misspelt in the index of functions.spelling; what is found
streams, in order, through a function that keeps the last chosen phrase's end alone.

Where a conversation is a row already, as transcripts are, spans() finds the same in its array of words: nothing is
shuffled or sorted, and each distinct word of a batch is looked up once. operators.talks makes such rows of segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from ..functions.lexicon import first_by_rank, rows
from ..functions.phrases import terms_in
from ..functions.spelling import MIN_CONFIDENCE, can_be_near, near_term, nearest
from ..functions.text import AROUND, may_is_month, normalize_word, normalized, speaks_of_month

MATCH = ["id", "word_idx", "n_words", "text", "category", "start_time", "end_time", "confidence", "is_fuzzy"]
#: All of them but id.
MATCH_TYPES = "word_idx int, n_words int, text string, category string, start_time double, end_time double, confidence double, is_fuzzy boolean"

#: Of spans(): the place of the first word, how many words, and what they are.
SPANS = "array<struct<word_idx:int,n_words:int,category:string,confidence:double,is_fuzzy:boolean>>"


def words_of(transcripts: DataFrame) -> DataFrame:
    """words from (id, segments array<struct<text, start, end, words array<struct<word, start, end, confidence>>>>)."""
    segs = transcripts.select("id", F.posexplode_outer("segments").alias("seg", "s"))
    flat = segs.select("id", "seg", F.posexplode("s.words").alias("pos", "w"))
    order = W.partitionBy("id").orderBy("seg", "pos")
    return flat.select("id", "seg", (F.row_number().over(order) - 1).alias("idx"), F.col("w.word").alias("word"), F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"))


def _extra(may_context: bool) -> dict[str, str] | None:
    return {"may": "month"} if may_context else None


def _with_months(words: DataFrame, order) -> DataFrame:
    """words (with norm) with _month: of "may", may_is_month() among its neighbours, as many as the characters looked at, each
    being one at least."""
    near = {f"_m{k}": F.lag("word", -k).over(order) for k in range(-AROUND - 1, AROUND + 2) if k}
    w = words.withColumns(near).withColumn("_first", F.lag("idx").over(order).isNull())
    may = F.col("norm") == "may"
    side = lambda ks: F.array_join(F.array(*(F.col(f"_m{k}") if k else F.col("word") for k in ks)), " ")
    w = w.withColumns({"_before": F.when(may & ~F.col("_first"), F.concat(side(range(-AROUND - 1, 0)), F.lit(" "))).otherwise(""), "_after": F.when(may, side(range(AROUND + 2)))})
    w = w.withColumns({"_text": F.concat("_before", "_after"), "_at": F.length("_before")})
    w = w.withColumn("_month", F.when(may, may_is_month(F.col("_text"), F.col("_at"), F.col("_at") + len("may"))))
    return w.drop(*near, "_first", "_before", "_after", "_text", "_at")


def _candidates(words: DataFrame, may_context: bool, longest: int, phrases: bool = True, misspelt: bool = True) -> DataFrame:
    """MATCH of every phrase of up to `longest` words that is a term, and of every word that is near one, overlaps
    included; in order of (id, word_idx) in each partition."""
    order = W.partitionBy("id").orderBy("idx")
    w = words.withColumn("norm", normalize_word(F.col("word")))
    terms = first_by_rank(words.sparkSession, _extra(may_context))
    opens = F.lit(False)
    if phrases:
        ahead = [(F.lead("norm", k).over(order), F.lead("word", k).over(order), F.lead("end_time", k).over(order)) for k in range(1, longest)]
        w = w.withColumns({f"_{n}{k}": c for k, cols in enumerate(ahead, 1) for n, c in zip("nwe", cols, strict=True)})
        if may_context:
            w = _with_months(w, order)
        opens = F.col("norm").isin(*sorted({r["term"].split()[0] for r in terms.collect()}))  # 260 terms
    near = can_be_near(F.col("norm")) if misspelt else F.lit(False)
    forms = [F.when(near, F.struct(F.lit(0).alias("n"), F.col("norm").alias("phrase"), F.col("word").alias("text"), F.col("end_time")))]
    for n in range(1, longest + 1 if phrases else 1):
        phrase, text = (F.concat_ws(" ", F.col(c), *(F.col(f"_{p}{k}") for k in range(1, n))) for c, p in (("norm", "n"), ("word", "w")))
        whole = F.col(f"_n{n - 1}").isNotNull() if n > 1 else F.lit(True)
        forms.append(F.when(opens & whole, F.struct(F.lit(n).alias("n"), phrase.alias("phrase"), text.alias("text"), (F.col(f"_e{n - 1}") if n > 1 else F.col("end_time")).alias("end_time"))))
    kept = ["id", "idx", "start_time", *(["_month"] if may_context and phrases else [])]
    w = w.filter(opens | near).select(*kept, F.explode(F.array(*forms)).alias("g")).filter("g IS NOT NULL").select(*kept, "g.*")
    terms = F.broadcast(terms.select(F.col("term").alias("_term"), F.col("n_words").alias("_n"), "category"))
    w = w.join(terms, (F.col("phrase") == F.col("_term")) & (F.col("n") == F.col("_n")), "left").filter("n = 0 OR _term IS NOT NULL")
    if may_context and phrases:
        w = w.filter((F.col("n") == 0) | (F.col("phrase") != "may") | F.col("_month"))
    fuzzy = F.col("n") == 0
    if misspelt:
        w = w.withColumn("_near", near_term(F.when(fuzzy, F.col("phrase")))).filter(~fuzzy | F.col("_near").isNotNull())
        w = w.withColumns({"category": F.coalesce("_near.category", "category"), "confidence": F.coalesce("_near.confidence", F.lit(1.0))})
    else:
        w = w.withColumn("confidence", F.lit(1.0))
    return w.select("id", F.col("idx").alias("word_idx"), F.greatest("n", F.lit(1)).alias("n_words"), "text", "category", "start_time", "end_time", "confidence", fuzzy.alias("is_fuzzy"))


def _leftmost(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates that are chosen, of rows in order of id (nth = 1 opens one), word_idx, exact before fuzzy, longest
    first: exact ones that begin where the one chosen before has ended, and fuzzy ones outside of those."""
    free = 0
    for b in batches:
        keep = []
        for k, (nth, at, n, fuzzy) in enumerate(zip(*(b[c].to_pylist() for c in ("nth", "word_idx", "n_words", "is_fuzzy")), strict=True)):
            if nth == 1:
                free = at
            if at >= free:
                keep.append(k)
                if not fuzzy:
                    free = at + n
        yield b.take(pa.array(keep, pa.int64())).drop_columns(["nth"])


def _picked(candidates: DataFrame) -> DataFrame:
    """MATCH of the chosen candidates. The window asks for the order that the function relies on: it sorts within
    conversations, and shuffles only what is not dealt by conversation yet."""
    order = W.partitionBy("id").orderBy("word_idx", "is_fuzzy", F.desc("n_words"))
    numbered = candidates.withColumn("nth", F.row_number().over(order))
    return numbered.mapInArrow(_leftmost, StructType([f for f in numbered.schema if f.name != "nth"])).select(MATCH)


def exact(words: DataFrame, may_context: bool = False, longest: int = 3) -> DataFrame:
    """Leftmost, then longest phrases of up to `longest` words."""
    return _picked(_candidates(words, may_context, longest, misspelt=False))


def covered(matches: DataFrame) -> DataFrame:
    """(id, idx, first) for every word in a match, with the match's category."""
    return matches.select("id", F.explode(F.sequence(F.col("word_idx"), F.col("word_idx") + F.col("n_words") - 1)).alias("idx"), "word_idx", "category")


def fuzzy_terms(tokens: DataFrame) -> DataFrame:
    """norm, term, category, d, confidence: the nearest single-word term of each distinct token (norm) that has one; ties go
    by rank."""
    own = tokens.select("norm").filter(can_be_near(F.col("norm"))).distinct().withColumn("b", near_term(F.col("norm")))
    return own.filter("b IS NOT NULL").select("norm", "b.*")


def fuzzy(words: DataFrame, found: DataFrame) -> DataFrame:
    """Single words outside the exact matches `found` that are near a term."""
    near = _candidates(words, False, 1, phrases=False)
    return near.join(covered(found).select("id", F.col("idx").alias("word_idx")), ["id", "word_idx"], "left_anti").select(MATCH)


def detect(words: DataFrame, may_context: bool = False) -> DataFrame:
    """Exact and fuzzy matches; see placed() for their order."""
    return _picked(_candidates(words, may_context, 3))


@cache
def _terms(may_context: bool) -> tuple[dict[str, tuple[str, int]], set[str]]:
    """(category, words) of each term, of two categories the first in rank; the words that open terms of several."""
    out: dict[str, tuple[str, int]] = {}
    for term, category, _, n, *_ in rows(_extra(may_context)):
        out.setdefault(term, (category, n))
    return out, {t.split()[0] for t, (_, n) in out.items() if n > 1}


@lru_cache(maxsize=200_000)
def _known(word: str, may_context: bool) -> tuple[str, str | None, bool, tuple | None]:
    """(normal form, category if it is a term, whether it opens longer ones, nearest()) of a word."""
    norm = normalized(word)
    terms, opening = _terms(may_context)
    category, n = terms.get(norm, (None, 1))
    return norm, category if n == 1 else None, norm in opening, nearest(norm)


def _said_month(told: Callable[[int], str | None], at: int, first: int, end: int) -> bool:
    """Whether the words around the "may" at that place speak of the month, see _with_months(); first and end bound its
    conversation. No more words are put together than the characters looked at."""
    before, k = "", at
    while len(before) < AROUND and k > max(first, at - AROUND - 1):
        k -= 1
        before = before if (w := told(k)) is None else f"{w} {before}"
    before = before or (" " if at > first else "")
    after, k = told(at), at + 1
    while len(after) < len("may") + AROUND and k < min(end, at + AROUND + 2):
        after = after if (w := told(k)) is None else f"{after} {w}"
        k += 1
    return speaks_of_month(before + after, len(before), len(before) + len("may"))


def _phrases_in(codes: np.ndarray, ends: np.ndarray, of: list[tuple], opens: np.ndarray, place: dict[str, int], terms: dict[str, tuple[str, int]], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the first word, how many words, kind) of the leftmost, then longest terms of several words. Each distinct run
    of words that opens as one is looked up once."""
    at = np.flatnonzero(opens)
    room = ends[np.searchsorted(ends, at, "right")] - at
    size, kind = np.ones(len(at), np.int64), np.zeros(len(at), np.int32)
    rest, run = np.arange(len(at)), codes[at].astype(np.int64)
    for k in range(2, longest + 1):
        fits = room[rest] >= k
        rest = rest[fits]
        distinct, one, run = np.unique(run[fits] * len(of) + codes[at[rest] + k - 1], return_index=True, return_inverse=True)
        got = [terms.get(" ".join([of[x][0] for x in codes[i : i + k].tolist()])) for i in at[rest[one]].tolist()]
        kinds = np.fromiter((place[g[0]] if g and g[1] == k else -1 for g in got), np.int32, len(distinct))[run]
        hit = rest[kinds >= 0]
        size[hit], kind[hit] = k, kinds[kinds >= 0]
    some = size > 1
    at, size, kind = at[some], size[some], kind[some]
    if (at[1:] < (at + size)[:-1]).any():  # a phrase begins in another
        free, keep = 0, []
        for j, (i, k) in enumerate(zip(at.tolist(), size.tolist(), strict=True)):
            if i >= free:
                keep.append(j)
                free = i + k
        at, size, kind = at[keep], size[keep], kind[keep]
    return at, size, kind


def found_in(lists: pa.Array, may_context: bool = False, longest: int = 3, misspelt: bool = True) -> pa.Array:
    """SPANS of each list of words: leftmost, then longest phrases, and words outside of them that are near a term."""
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    coded = flat.fill_null("").dictionary_encode()
    spoken = coded.dictionary.to_pylist()
    of = [_known(w, may_context) for w in spoken]
    kinds = sorted({x for _, c, _, near in of for x in (c, near and near[1]) if x} | {c for c, _ in _terms(may_context)[0].values()})
    place = {c: k for k, c in enumerate(kinds)}
    told = lambda xs, kind: np.fromiter(xs, kind, len(of))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    exact = told((c is not None for _, c, *_ in of), bool)[codes]
    fuzzy = told((misspelt and c is None and near is not None for _, c, _, near in of), bool)[codes]
    if may_context:
        none = set(np.flatnonzero(flat.is_null().to_numpy(zero_copy_only=False)).tolist()) if flat.null_count else ()
        word = lambda k: None if k in none else spoken[codes[k]]
        for i in np.flatnonzero(told((norm == "may" and c is not None for norm, c, *_ in of), bool)[codes]).tolist():
            r = int(np.searchsorted(ends, i, "right"))
            exact[i] = _said_month(word, i, int(ends[r - 1]), int(ends[r]))
    opened, n, of_phrase = _phrases_in(codes, ends, of, told((opens for _, _, opens, _ in of), bool)[codes], place, _terms(may_context)[0], longest)
    inner = np.repeat(opened + 1, n - 1) + np.arange((n - 1).sum()) - np.repeat(np.cumsum(n - 1) - (n - 1), n - 1)
    exact[opened], exact[inner], fuzzy[opened], fuzzy[inner] = True, False, False, False
    at = np.flatnonzero(exact | fuzzy)
    unsure, own = fuzzy[at], codes[at]
    near_kind = told((place[near[1]] if near else 0 for *_, near in of), np.int32)
    kind = np.where(unsure, near_kind[own], told((place[c] if c else 0 for _, c, *_ in of), np.int32)[own])
    sure = np.where(unsure, told((near[3] if near else 1.0 for *_, near in of), float)[own], 1.0)
    size = np.ones(len(at), np.int32)
    here = np.searchsorted(at, opened)
    size[here], kind[here] = n, of_phrase
    first = at - np.repeat(ends[:-1], np.diff(np.searchsorted(at, ends)))
    columns = [pa.array(first, pa.int32()), pa.array(size), pa.array(kinds, pa.string()).take(pa.array(kind)), pa.array(sure), pa.array(unsure)]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, ends), pa.int32()), pa.StructArray.from_arrays(columns, ["word_idx", "n_words", "category", "confidence", "is_fuzzy"]))


def spans(words: Column, may_context: bool = False, longest: int = 3, misspelt: bool = True) -> Column:
    """SPANS of each array of a conversation's words, in order: what detect() finds, or exact() without misspelt. The array
    must not be null. Called nondeterministic so that it is run once, whatever is made of it."""

    def run(lists: pa.Array) -> pa.Array:
        return found_in(lists, may_context, longest, misspelt)

    return F.arrow_udf(run, SPANS).asNondeterministic()(words)


def matches_of(talks: DataFrame) -> DataFrame:
    """MATCH of conversations (id, words array<struct<word, start_time, end_time>>, spans), a row a match."""
    m = talks.select("id", "words", F.explode("spans").alias("m"))
    first, n = F.col("m.word_idx"), F.col("m.n_words")
    text = F.when(n == 1, F.get("words", first)["word"]).otherwise(F.array_join(F.slice("words", first + 1, n)["word"], " "))
    start, end = F.get("words", first)["start_time"], F.get("words", first + n - 1)["end_time"]
    return m.select("id", "m.word_idx", "m.n_words", text.alias("text"), "m.category", start.alias("start_time"), end.alias("end_time"), "m.confidence", "m.is_fuzzy")


def placed(matches: DataFrame, *by: str) -> DataFrame:
    """matches with place (1, 2, ...) in their conversation, as a reader is shown them: of detect() by start_time, exact
    before fuzzy; of detect_in_text() by start."""
    by = by or (("start_time", "is_fuzzy", "word_idx") if "word_idx" in matches.columns else ("start",))
    return matches.withColumn("place", F.row_number().over(W.partitionBy("id").orderBy(*by)))


def placed_spans(talks: DataFrame) -> DataFrame:
    """(id, word_idx, is_fuzzy, place) as placed() has them, of conversations with words and spans."""
    start = lambda m: F.get("words", m["word_idx"])["start_time"].alias("start_time")
    in_time = F.array_sort(F.transform("spans", lambda m: F.struct(start(m), m["is_fuzzy"].alias("is_fuzzy"), m["word_idx"].alias("word_idx"))))
    return talks.select("id", F.posexplode(in_time).alias("k", "m")).select("id", "m.word_idx", "m.is_fuzzy", (F.col("k") + 1).alias("place"))


def detect_in_text(texts: DataFrame, may_context: bool = False) -> DataFrame:
    """(id, text, category, start, end) of whole-word terms in (id, text): longest terms first over the whole text,
    no overlaps, no plurals, nothing fuzzy. Offsets are code points, end exclusive."""
    return texts.select("id", F.explode(terms_in(F.col("text"), may_context)).alias("p")).select("id", "p.*")
