"""Word error rates of transcripts against human ones; python -m redactory.plans.accuracy."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import render, wer
from ..sources import files as io
from ..sources import trees

#: Where transcripts are looked for if no folder is named: those of the chain's export, and human ones.
ASR_DIR, HUMAN_DIR = "output/transcripts_raw/train", "data/transcripts_human"
COLUMNS = ["conversation_id", "wer", "substitutions", "insertions", "deletions", "reference_words", "hypothesis_words"]


def rates(asr: DataFrame, human: DataFrame, aligned: bool = True) -> DataFrame:
    """COLUMNS and, with aligned, aligned_pairs of each ASR transcript (id, segments, redacted_text, text) that has a human one (id, path,
    text) of the same id."""
    return wer.wer(io.pair_by_stem(asr, human), aligned=aligned).select(F.col("id").alias("conversation_id"), *COLUMNS[1:], *(["aligned_pairs"] if aligned else []))


def file_pair(spark: SparkSession, asr_path: str, human_path: str) -> DataFrame:
    """One row for two files, whatever their names."""
    human = io.human_transcripts(spark, human_path).select("path", "text")
    asr = io.transcripts(spark, asr_path).withColumn("id", io.stem(F.col("key")))
    return rates(asr, human.crossJoin(F.broadcast(asr.select("id"))))  # a row each


def totals(rows: DataFrame) -> DataFrame:
    """One row: aggregate_wer, mean_wer over all pairs, files_analyzed, total_reference_words, total_errors."""
    errors = F.col("substitutions") + F.col("insertions") + F.col("deletions")
    return wer.batch(rows).select("aggregate_wer", F.coalesce("mean_wer_all", F.lit(0.0)).alias("mean_wer"), F.col("num_samples").alias("files_analyzed"), F.coalesce("reference_words", F.lit(0)).alias("total_reference_words"), F.coalesce(errors, F.lit(0)).alias("total_errors"))


def main(argv: list[str] | None = None) -> int:
    """Prints one pair's rates, or a batch's; 1 if there is nothing to compare. With --output the rows of all pairs are
    written as JSON below <output>/individual, the batch's row below <output>/totals, and both as one object in
    <output>/results.json."""
    p = argparse.ArgumentParser(description="Word error rates between ASR and human transcripts")
    p.add_argument("--asr", help="one ASR transcript (JSON)")
    p.add_argument("--human", help="its human transcript (text)")
    p.add_argument("--asr-dir", default=ASR_DIR, help="a folder of ASR transcripts")
    p.add_argument("--human-dir", default=HUMAN_DIR, help="a folder of human transcripts")
    p.add_argument("--output", help="folder for the results")
    p.add_argument("--errors", type=int, default=20, help="errors shown of one pair")
    a = p.parse_args(argv)
    single = a.asr and a.human
    if not single and (a.asr or a.human):
        p.error("--asr and --human go together")
    spark = SparkSession.builder.appName("redactory").getOrCreate()
    if single:
        for r in file_pair(spark, a.asr, a.human).withColumn("shown", wer.errors(F.col("aligned_pairs"), a.errors)).drop("aligned_pairs").collect():
            print(f"WER ANALYSIS: {r['conversation_id']}\n{render.word_errors(r.asDict(), r['shown'])}")
        return 0
    try:
        rows = rates(io.transcripts(spark, a.asr_dir), io.human_transcripts(spark, a.human_dir), aligned=False)
    except FileNotFoundError as e:
        print(e)
        return 1
    if a.output:
        rows.write.mode("overwrite").json(f"{a.output}/individual", ignoreNullFields=False)
        rows = spark.read.schema(rows.schema).json(f"{a.output}/individual")
    all_ = totals(rows)
    if a.output:
        io.write_report(all_, f"{a.output}/totals")
        trees.write_with_totals(all_.first().asDict(), "individual_results", rows, f"{a.output}/results.json", ["conversation_id", "wer"])
    t = all_.first()
    if not t["files_analyzed"]:
        print("No matching files found")
        return 1
    print(f"Files analyzed: {t['files_analyzed']}\nAggregate WER: {render.percent(t['aggregate_wer'])}\nMean WER: {render.percent(t['mean_wer'])}\nTotal reference words: {t['total_reference_words']}\nTotal errors: {t['total_errors']}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
