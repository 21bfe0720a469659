"""Reports and de-identified transcripts as text; python -m redactory.plans.show."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import render, report, verify

REPORT = """timestamp string, verification_status map<string,bigint>, processing_times map<string,double>, failures array<struct<conversation_id:string,stage:string,error:string>>,
    summary struct<total_conversations:bigint,successful:bigint,failed:bigint,total_duration_sec:double,total_duration_min:double,total_pii_redacted:bigint>"""
DEIDENTIFIED = "conversation_id string, original_text string, redacted_text string, pii_count bigint, redactions array<struct<original:string,replacement:string,category:string>>"


def load_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(totals, statuses, times, failures) of the report file below path, as render.report_text() takes them; its maps are
    JSON objects, whose ids must not become columns."""
    row = spark.read.schema(REPORT).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    times = row.select(F.explode("processing_times").alias("conversation_id", "processing_time_s"))
    return row.select("summary.*"), row.select(F.explode("verification_status").alias("status", "n")), times, row.select(F.explode("failures").alias("f")).select("f.*")


def load_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The same from the table of results that the chain writes, whatever its size."""
    rows = spark.read.parquet(path)
    return report.summary(rows), verify.status_counts(rows.filter("success"), "status"), rows.select("conversation_id", "processing_time_s"), report.failures(rows)


def transcripts(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """De-identified transcripts below path: one a line, as the chain writes them, or one a file."""
    return spark.read.schema(DEIDENTIFIED).option("multiLine", whole_files).option("recursiveFileLookup", True).json(path)


def main(argv: list[str] | None = None) -> int:
    """Prints the report and the first transcripts, or writes all transcripts as text below --output."""
    p = argparse.ArgumentParser(description="Show results")
    p.add_argument("--report", help="a processing report")
    p.add_argument("--results", help="the chain's table of results")
    p.add_argument("--transcripts", help="a file or folder of de-identified transcripts")
    p.add_argument("--whole-files", action="store_true", help="each file is one transcript, over several lines")
    p.add_argument("--most", type=int, default=100, help="lines of a part, and transcripts, that are printed")
    p.add_argument("--output", help="a folder for the texts of all transcripts")
    a = p.parse_args(argv)
    if not a.report and not a.results and not a.transcripts:
        p.error("--report, --results or --transcripts")
    spark = SparkSession.builder.appName("redactory").getOrCreate()
    if a.report or a.results:
        print(render.report_text(*(load_report(spark, a.report) if a.report else load_results(spark, a.results)), a.most))
    if a.transcripts:
        texts = render.transcript_texts(transcripts(spark, a.transcripts, a.whole_files))
        if a.output:
            texts.select("shown").write.mode("overwrite").text(a.output)
        for r in texts.orderBy("conversation_id").limit(a.most).collect():
            print(r["shown"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
