"""Whole terms in running text, by one pass of an automaton of all terms.

A term counts where neither neighbour is a letter, digit or underscore. Terms are chosen by rank over the whole text,
each where it does not touch what was chosen before; a byte a character marks that, so the time is linear in the text and
in what the automaton finds."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import rows
from .text import speaks_of_month

FOUND = "array<struct<text:string,category:string,start:int,end:int>>"
#: Characters that count as their neighbour where case is ignored, beside those that lower() maps.
FOLD = {0x17F: "s", 0x131: "i"}


@cache
def automaton(may_context: bool):
    """(the automaton, category of each rank); of terms in two categories the first in rank counts."""
    import ahocorasick

    out, category = ahocorasick.Automaton(), []
    for term, kind, *_ in rows({"may": "month"} if may_context else None):
        if not out.exists(term):
            out.add_word(term, (len(category), len(term)))
            category.append(kind)
    out.make_automaton()
    return out, category


def _part(c: str) -> bool:
    return c.isalnum() or c == "_"


def find(text: str | None, may_context: bool = False) -> list[tuple[str, str, int, int]]:
    """(text, category, start, end) of the chosen terms by place. Places are those of the lower-cased text."""
    if not text:
        return []
    terms, category = automaton(may_context)
    low = text.lower().translate(FOLD)
    seen = []
    for last, (rank, n) in terms.iter(low):
        a, b = last + 1 - n, last + 1
        if not (a and _part(low[a - 1])) and not (b < len(low) and _part(low[b])):
            seen.append((rank, a, b))
    taken, out = bytearray(len(low)) if seen else b"", []
    for rank, a, b in sorted(seen):
        if taken.find(1, a, b) < 0 and not (low[a:b] == "may" and not speaks_of_month(text, a, b)):
            taken[a:b] = b"\1" * (b - a)
            out.append((text[a:b], category[rank], a, b))
    return sorted(out, key=lambda x: x[2])


def _leaked(found: str) -> bool:
    """Labels are none."""
    return not found.startswith("[") and not found.endswith("]")


@cache
def _any_term() -> str:
    """A pattern of ASCII texts in which find() finds something."""
    return r"(?i)(?:^|[^0-9a-z_])(?:" + "|".join(sorted(term for term, *_ in rows())) + r")(?:$|[^0-9a-z_])"


def leaks(texts: pa.Array) -> pa.Array:
    """How many terms find() finds in each text, labels left out. Few texts, once masked, hold any: plain ones are first asked
    for that by one pattern."""
    texts = texts.fill_null("")
    asked = pc.or_(pc.invert(pc.string_is_ascii(texts)), pc.match_substring_regex(texts, _any_term())).to_numpy(zero_copy_only=False)
    n = np.zeros(len(texts), np.int64)
    n[asked] = [sum(_leaked(x[0]) for x in find(t)) for t in texts.filter(pa.array(asked)).to_pylist()]
    return pa.array(n)


def terms_in(text: Column, may_context: bool = False) -> Column:
    """FOUND of each text; empty where there is none."""

    def run(texts: pa.Array) -> pa.Array:
        got = [find(t, may_context) for t in texts.to_pylist()]
        flat = [x for g in got for x in g]
        ends = [0]
        for g in got:
            ends.append(ends[-1] + len(g))
        columns = [pa.array([x[k] for x in flat], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int32()))]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["text", "category", "start", "end"]))

    return F.arrow_udf(run, FOUND)(text)
