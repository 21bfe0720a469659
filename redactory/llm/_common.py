"""Helpers shared by the training-data operators: shared storage, byte-safe text, skew-safe joins."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BREAKS = r"[ \x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or a temporary one where that is unset and the driver is
    the only machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="redactory-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder, so that readers of few columns read no others."""
    path = path or shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as that spells it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def bytes_at(spark: SparkSession, path: str) -> int:
    """The bytes of the files below a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder; a lost executor costs nothing of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() does the same, and faster, where every character is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The runs of characters other than space and \\x09-\\x0D; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAKS), lambda w: w != "")


def skew_join(left: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner", most_hot: int = 4000) -> DataFrame:
    """left joined with groups (one row a key; `size` counts left's rows of that key), however uneven the keys are.

    A key with more than rows / most_hot rows is hot. There are fewer than most_hot of those, whatever the
    input, so their groups are broadcast; all other keys meet in a sort-merge join. Both inputs are read twice:
    pass tables that are already written (see kept()). Null keys match nothing.
    """
    rows = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(groups.filter(F.col(size) > max(1000, -(-rows // most_hot))))
    cold = left.join(hot.select(key), key, "left_anti")
    return left.join(hot, key).unionByName(cold.join(groups.filter(F.col(size) <= max(1000, -(-rows // most_hot))).hint("merge"), key, how))
