"""Reports and transcripts as text. Each part is a relation of lines that Spark makes and sorts; only what a reader is shown
(`most` rows of a part) reaches the driver."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bar
from . import report

# How much of an id, an error and a text is shown, and how many redactions of a transcript.
ID_CHARS, ERROR_CHARS, TEXT_CHARS, REDACTIONS = 30, 60, 200, 10
# End of fixed values.


def _row(*cells: Column) -> Column:
    return F.concat_ws("  ", *(F.coalesce(c.cast("string"), F.lit("-")) for c in cells))


def chart_lines(counts: DataFrame, label: str, value: str, width: int = 40) -> DataFrame:
    """(place, line) of bars by value, largest first, then by label."""
    b = report.bars(counts, label, value, width)
    return b.select(F.struct((-F.col("value")).alias("by"), F.col("label").cast("string").alias("name")).alias("place"), _row(F.col("value"), F.col("label"), F.col("bar")).alias("line"))


def time_lines(times: DataFrame, width: int = 30) -> DataFrame:
    """(place, line) of the processing times (conversation_id, processing_time_s) by id."""
    longest = F.broadcast(times.agg(F.max("processing_time_s").alias("_most")))  # one row
    t = times.crossJoin(longest)
    shown = _row(F.format_string("%.1f", "processing_time_s"), F.substring("conversation_id", 1, ID_CHARS), bar(F.col("processing_time_s"), F.col("_most"), width))
    return t.select(F.col("conversation_id").alias("place"), shown.alias("line"))


def failure_lines(failures: DataFrame) -> DataFrame:
    """(place, line) of failures (conversation_id, stage, error) by id and stage."""
    return failures.select(F.struct("conversation_id", "stage", "error").alias("place"), _row(F.col("stage"), F.col("conversation_id"), F.substring("error", 1, ERROR_CHARS)).alias("line"))


def part(title: str, lines: DataFrame, most: int = 1000) -> Iterator[str]:
    """A titled part of a text: its first lines in order, and how many more there are."""
    yield f"[{title}]"
    shown = lines.orderBy("place").limit(most + 1).select("line").collect()
    yield from (f"  {r['line']}" for r in shown[:most]) if shown else ["  (no data)"]
    if len(shown) > most:
        yield f"  and {lines.count() - most} more"


def report_text(totals: DataFrame, statuses: DataFrame, times: DataFrame, failures: DataFrame, most: int = 1000) -> str:
    """A batch as text, from the rows of report.summary(), (status, n), (conversation_id, processing_time_s) and
    (conversation_id, stage, error)."""
    out, row = ["[batch]"], totals.first()
    out += [f"  {value if value is not None else '-'}  {name.replace('_', ' ')}" for name, value in (row.asDict() if row else {}).items()]
    out += part("status", chart_lines(statuses, "status", "n"), most)
    spent = report.times(times).first()
    out += part("seconds", time_lines(times), most)
    if spent and spent["total"] is not None:
        out.append(f"  {spent['total']:.1f} in all, {spent['average']:.1f} on average, {spent['longest']:.1f} at most")
    return "\n".join([*out, *part("failures", failure_lines(failures), most)])


def transcript_texts(deid: DataFrame) -> DataFrame:
    """(conversation_id, shown): each de-identified transcript (conversation_id, original_text, redacted_text, pii_count,
    redactions) as text: counts a category, the first redactions, the beginnings of both texts."""
    found = F.coalesce("redactions", F.array().cast(deid.schema["redactions"].dataType))
    kinds = F.array_sort(F.array_distinct(F.transform(found, lambda r: r["category"])))
    counts = F.transform(kinds, lambda k: F.concat_ws("  ", F.lit(" "), F.size(F.filter(found, lambda r: r["category"] == k)), k))
    first = F.transform(F.slice(found, 1, REDACTIONS), lambda r: F.concat(F.lit("    "), r["replacement"], F.lit(" for "), F.coalesce(r["original"], F.lit("-"))))
    more = F.when(F.size(found) > REDACTIONS, F.array(F.concat(F.lit("    and "), F.size(found) - REDACTIONS, F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    head = F.concat(F.lit("["), F.coalesce("conversation_id", F.lit("-")), F.lit("] "), F.coalesce("pii_count", F.lit(0)), F.lit(" found"))
    texts = F.array(*(F.concat(F.lit(f"  {name}: "), F.coalesce(F.substring(c, 1, TEXT_CHARS), F.lit("-"))) for name, c in (("before", "original_text"), ("after", "redacted_text"))))
    return deid.select("conversation_id", F.array_join(F.concat(F.array(head), counts, first, more, texts), "\n").alias("shown"))


def percent(rate: float) -> str:
    return f"{rate:.2%}" if math.isfinite(rate) else "inf"


def word_errors(row: dict, shown: list = ()) -> str:
    """One pair's rates and counts, and its first errors (kind, ref, hyp) if given."""
    lines = [f"Word Error Rate: {percent(row['wer'])}"]
    lines += [f"  {k.replace('_', ' ').capitalize()}: {row[k]}" for k in ("substitutions", "insertions", "deletions", "reference_words", "hypothesis_words")]
    if shown:
        lines += ["", f"First {len(shown)} errors:"]
        side = {"SUB": lambda e: f"'{e['ref']}' → '{e['hyp']}'", "DEL": lambda e: f"'{e['ref']}'", "INS": lambda e: f"'{e['hyp']}'"}
        lines += [f"  {e['kind']}: {side[e['kind']](e)}" for e in shown]
    return "\n".join(lines)
