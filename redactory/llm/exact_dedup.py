"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by SHA-256 digest; its number of buckets follows the first batch and is
kept beside it. A batch is first reduced to one row per digest (partial aggregation, so that a group of any size leaves
each task as one row), then anti-joined with the index by sort-merge, and what is new is appended. exact_dedup() adds a
table in `batches` parts by id, those first whose ids win. Only DataFrame functions are used.

Cases: null texts count as empty, and all empty texts are equal; repeated rows are copies of each other; ties
on the id cannot be told apart and stay or go together with the id; a null id stays only where all ids of its text are
null; texts of any length are hashed whole; an empty table gives no rows. Only the id and text columns are read, so other
columns and their names do not matter.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import ascii_lower, kept, qualified, shared_path, skew_join, there


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest (binary SHA-256 of the text, A-Z lower-cased; null as empty)."""
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def buckets_for(rows: int) -> int:
    """A power of two of buckets, of about a million digests each."""
    return 1 << max(4, (rows // 1_000_000).bit_length())


class DigestIndex:
    """digest binary, keep_id long, group_size long (of the part that brought the digest), at a shared path.

    The session's catalogue knows the table by a hash of the whole path, so indexes of one name in several folders are
    indexes of their own; one path, however it is spelt, is one index."""

    SCHEMA = "digest BINARY, keep_id BIGINT, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 32):
        self.spark, self.path = spark, qualified(spark, path or shared_path(spark, "digest_index"))
        spec = f"{self.path}_spec"
        if path and there(spark, spec):
            buckets = spark.read.parquet(spec).first()["buckets"]
        else:
            spark.range(1, numPartitions=1).select(F.lit(buckets).alias("buckets")).write.parquet(spec)
        self.buckets = buckets
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:32]
        place = self.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({self.SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'")
        found = spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").filter("col_name = 'Location'").first()["data_type"]
        if qualified(spark, found) != self.path:
            raise ValueError(f"the catalogue's {self.table} lies at {found}, not at {self.path}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, batch: DataFrame, keep: str = "max") -> DataFrame:
        """Append the digests of batch (from digests()) that the index lacks; returns the index after that.

        keep: whether the largest ("max") or smallest ("min") id of the batch's equal texts stays."""
        best = (F.max if keep == "max" else F.min)("id")
        found = batch.groupBy("digest").agg(best.alias("keep_id"), F.count("*").alias("group_size"))
        new = found.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (new.repartition(self.buckets, "digest").select("digest", "keep_id", "group_size")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)
        return self.rows()


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", batches: int = 2) -> DataFrame:
    """id, keep_id, group_size, kept, digest for every row of docs; a text that the index had before keeps none.

    group_size counts the equal texts of docs. Ids are divided into batches at quantiles; the ids that win come first,
    so that a later part finds its copies in the index."""
    own = kept(digests(docs, id_col, text_col))
    cuts = own.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)], 1000), F.count("*")).first()
    index = index or DigestIndex(docs.sparkSession, buckets=buckets_for(cuts[1]))
    rank = sum(((F.col("id") >= c).cast("int") for c in cuts[0] or []), F.lit(0))
    part = F.coalesce(F.lit(batches - 1) - rank if keep == "max" else rank, F.lit(batches - 1))  # null ids last
    for k in range(batches):
        index.add(own.filter(part == k), keep)
    # the batch's own counts tell hot keys, since the index has those of the part that came first
    sizes = own.groupBy("digest").agg(F.count("*").alias("n_here"))
    groups = kept(index.rows().drop("group_size").join(sizes.hint("merge"), "digest"))
    out = skew_join(own, groups, "digest", "n_here")
    return out.select("id", "keep_id", F.col("n_here").alias("group_size"), F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
