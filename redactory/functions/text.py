"""Column functions over words and texts. All are built-in expressions; nulls count as empty text unless stated."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import LABELS, SINGULARS

#: The last s of a known plural. It is found by its letter first, so the list is read only for words that end in one.
PLURAL = rf"s\z(?<=^(?:{'|'.join(x for x in SINGULARS if x[-1] != 's')})s)"


def normalize_word(word: Column) -> Column:
    """Lower case, possessive 's off (before punctuation), closing then opening punctuation off, known plurals cut."""
    w = F.lower(F.coalesce(word, F.lit("")))
    w = F.regexp_replace(w, "'s$", "")
    w = F.regexp_replace(F.regexp_replace(w, "[.,!?;:\"']+$", ""), "^[\"']+", "")
    return F.regexp_replace(w, PLURAL, "")


#: Where Java's $ matches: at the end, or before a last line break.
_END = "(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\\Z)"
_POSSESSIVE, _CLOSING, _OPENING = (re.compile(x) for x in (f"'s{_END}", f"[.,!?;:\"']+{_END}", "^[\"']+"))
_PLURALS = frozenset(f"{x}s" for x in SINGULARS if x[-1] != "s")


def normalized(word: str | None) -> str:
    """normalize_word() of one word, for functions that run in tasks."""
    w = _POSSESSIVE.sub("", (word or "").lower())
    w = _OPENING.sub("", _CLOSING.sub("", w))
    return w[:-1] if w in _PLURALS else w


def split_words(text: Column) -> Column:
    """Runs of characters that are not white space (any Unicode white space)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def normalize_phrase(text: Column) -> Column:
    return F.array_join(F.transform(split_words(text), normalize_word), " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


# What tells the month from the verb, in the lower-cased characters around it, and how many of those.
MONTH_CUES = (
    r"\b(?:in|during|last|next|this|of|since|before|after|until|by)\s+may\b",
    r"\bmay\s+\d{1,2}(?:st|nd|rd|th)?\b",
    r"\bmay\s+of\s+\d{4}\b",
    r"^may\s+\d",
)
AROUND = 20
# End of fixed values.
_CUES = tuple(map(re.compile, MONTH_CUES))


def may_is_month(text: Column, start: Column, end: Column) -> Column:
    """Whether the characters around [start, end) speak of the month: a preposition before "may", a day number after
    it, "may of" with a year, or the window opens with "may" and a digit. Any "may" in the window counts."""
    low = F.greatest(start - AROUND, F.lit(0))
    window = F.lower(F.substring(text, low + 1, F.least(F.length(text), end + AROUND) - low))
    out = F.lit(False)
    for cue in MONTH_CUES:
        out = out | window.rlike(f"(?U){cue}")
    return out


def speaks_of_month(text: str, start: int, end: int) -> bool:
    """may_is_month() of one text, for functions that run in tasks."""
    window = text[max(0, start - AROUND) : end + AROUND].lower()
    return any(cue.search(window) for cue in _CUES)


def label_of(category: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv))
    return F.coalesce(F.try_element_at(known, category), F.concat(F.lit("["), F.upper(category), F.lit("]")))


def stem(path: Column) -> Column:
    """The file's name without its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def full_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: strip(s["text"])), " ")


def flat_words(segments: Column) -> Column:
    return F.flatten(F.transform(segments, lambda s: s["words"]))


def wer_words(text: Column) -> Column:
    return split_words(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\w\s']", " "))


def _plain(text: Column) -> Column:
    return F.array_join(split_words(F.lower(F.regexp_replace(text, r"(?U)[^\w\s]", " "))), " ")


def clean_human(text: Column) -> Column:
    """A human transcript without time stamps, speaker and other tags, and punctuation."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\[\d+\.\d+\]", " ")
    return _plain(F.regexp_replace(t, r"<[^>]+>", " "))


def clean_asr(segments: Column, redacted_text: Column, text: Column) -> Column:
    joined = F.array_join(F.transform(segments, lambda s: s["text"]), " ")
    return _plain(F.when(segments.isNotNull(), joined).otherwise(F.coalesce(redacted_text, text, F.lit(""))))


def bar(value: Column, most: Column, width: int = 50) -> Column:
    return F.repeat(F.lit("█"), F.when(most > 0, F.floor(value / most * width)).otherwise(0).cast("int"))
