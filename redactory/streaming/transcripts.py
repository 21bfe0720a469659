"""Redaction of transcripts as they arrive: each micro-batch goes through the batch chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pipeline import Config, redact_transcripts
from ..sources.files import parsed


def redact_stream(spark: SparkSession, source: str, target: str, checkpoint: str, config: Config | None = None):
    """A started query: JSON transcripts that land in source are redacted into Parquet below target: redacted texts, and
    below `<target>_results` a row each of how it went. A conversation is one row, so there is no state between batches;
    a batch that is repeated overwrites its own folders. Rows are told apart by their files' paths, as in the batch reader."""
    files = spark.readStream.option("wholetext", True).option("recursiveFileLookup", True).text(source)
    df = parsed(files.select(F.col("_metadata.file_path").alias("path"), "value"))

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        got = redact_transcripts(batch, config)
        got.redacted.write.mode("overwrite").parquet(f"{target}/batch={number}")
        got.results.write.mode("overwrite").parquet(f"{target}_results/batch={number}")
        batch.unpersist()

    return df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
