"""A training corpus from `documents`: rejected by quality, exact and near copies out, mixed, tokenised.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns a DataFrame; all but the last keep the
columns of documents.

Cases: rows with a null doc_id cannot be referred to: they pass the dedup stages and enter the mix once. Null and empty
texts are equal, so one of them stays; rows that repeat a doc_id stay or go together; ties go to the doc_id named by the
stage. Texts of any length are read whole. An empty table passes all stages; without labels of both classes nothing is
rejected. Further columns of documents pass the first four stages unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redactory.llm import quality_model
from redactory.llm._common import dropped, kept, shared_path
from redactory.llm.bpe import byte_bpe
from redactory.llm.exact_dedup import exact_dedup
from redactory.llm.mixing import mixture
from redactory.llm.queries import PATTERN, VOCABULARY
from redactory.llm.simhash import similar_documents


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs less the rows whose doc_id is among ids (id)."""
    return docs.join(ids.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the co-trained classifier does not reject."""
    model = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.score(docs, model).filter("kept").select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id."""
    return without(docs, exact_dedup(docs).filter(~F.col("kept")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (Jaccard index of 5-word shingles 0.8 or more) the row with the smallest doc_id."""
    return without(docs, similar_documents(docs, shingle=5, least=(4, 5)).filter("id <> component"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mixture uses it; every row at least once."""
    uses = kept(mixture(docs)).filter("id IS NOT NULL").groupBy("id").agg(F.count("*").cast("int").alias("_uses"))
    used = docs.join(uses.withColumnRenamed("id", "doc_id"), "doc_id").withColumn("_use", F.explode(F.sequence(F.lit(1), F.col("_uses"))))
    return used.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the ids (little-endian unsigned 32-bit) with their digest and that of the bytes they
    decode to, of every row; stops where those are not the text."""
    out = byte_bpe(docs, VOCABULARY, PATTERN, keep=["doc_id", "source", "text"])
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    told = F.when(same, F.sha2("decoded", 256)).otherwise(F.raise_error(F.lit("ids do not decode to the text")))
    return out.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), told.alias("decoded_sha256"), "ids")


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near), ("mixing", mix), ("byte-level BPE", encode)]

#: The classifier's fit and the permutations of the mix are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            dropped(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
