"""The vocabulary term that a misspelt word stands for, by an index of deletions.

Two words are within two edits only if deleting up to two characters of each can make them equal. The index holds
every string that deletions make of a term, so a word is looked up by its own deletions and compared with the few terms
found there, not with all. What is found depends on the word alone, so a task keeps its answers."""

from __future__ import annotations

from functools import cache, lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import NEVER_FUZZY, rows

# How far a word may be from a term.
MAX_DISTANCE, MIN_CONFIDENCE, MIN_LENGTH, LENGTH_FOR_TWO, MOST_RELATIVE = 2, 0.7, 5, 7, 0.25
# End of fixed values.

#: (term, category) that words are compared with, in rank order, and the length of the longest word that can be near one.
TERMS = [(r[0], r[1]) for r in rows() if r[3] == 1 and r[4] >= MIN_LENGTH]
MAX_LENGTH = max(len(t) for t, _ in TERMS) + MAX_DISTANCE
FOUND = "struct<term:string,category:string,d:int,confidence:double>"


def deletions(word: str, most: int = MAX_DISTANCE) -> set[str]:
    """word less any up to `most` of its characters."""
    out = {word}
    for n in range(1, min(most, len(word)) + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in gone) for gone in combinations(range(len(word)), n)}
    return out


def distance(a: str, b: str) -> int:
    """Edits (insertions, deletions, substitutions) between two words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, diagonal = i, row[0]
        row[0] = i
        for j, y in enumerate(b, 1):
            left = min(left + 1, row[j] + 1, diagonal + (x != y))
            diagonal, row[j] = row[j], left
    return row[-1]


@cache
def index() -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for k, (term, _) in enumerate(TERMS):
        for d in deletions(term):
            out.setdefault(d, []).append(k)
    return out


@lru_cache(maxsize=100_000)
def nearest(word: str) -> tuple[str, str, int, float] | None:
    """(term, category, edits, confidence) of the term nearest to a normal form; of equally near ones the first in rank.
    None for short words, listed ones and those that are near no term."""
    if not MIN_LENGTH <= len(word) <= MAX_LENGTH or word in NEVER_FUZZY:
        return None
    best = None
    for k in sorted({k for d in deletions(word) for k in index().get(d, ())}):
        term = TERMS[k][0]
        d = distance(word, term)
        if 0 < d <= (MAX_DISTANCE if len(word) >= LENGTH_FOR_TWO else 1) and d / max(len(word), len(term)) <= MOST_RELATIVE and (best is None or d < best[0]):
            best = d, k
    if best is None:
        return None
    d, (term, category) = best[0], TERMS[best[1]]
    confidence = 1 - d / max(len(word), len(term))
    return (term, category, d, confidence) if confidence >= MIN_CONFIDENCE else None


def _looked_up(words: pa.Array) -> pa.Array:
    coded = words.dictionary_encode()  # a batch's repeated words are looked up once
    found = [None if w is None else nearest(w) for w in coded.dictionary.to_pylist()]
    kind = pa.struct([("term", pa.string()), ("category", pa.string()), ("d", pa.int32()), ("confidence", pa.float64())])
    return pa.array([None if f is None else dict(zip(("term", "category", "d", "confidence"), f, strict=True)) for f in found], kind).take(coded.indices)


def near_term(normal_form: Column) -> Column:
    """FOUND of each normal form, null where no term is near. Called nondeterministic so that a filter on what is found is not
    pushed below it, which would look every word up twice."""
    return F.arrow_udf(_looked_up, FOUND).asNondeterministic()(normal_form)


def can_be_near(normal_form: Column) -> Column:
    """Whether near_term() is worth asking: by length and the words that are never matched."""
    return F.length(normal_form).between(MIN_LENGTH, MAX_LENGTH) & ~normal_form.isin(*NEVER_FUZZY)
