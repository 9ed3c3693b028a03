"""From raw documents to packed sequences: four stages, each over all that the one before kept.

A stage takes (spark, docs, folder of the tables) and returns a frame, which is written as
Parquet and read again as the next stage's documents. All but the last return the columns
of documents.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import packing, pii, toxicity, weighted_minhash
from ledgerloom.operators.slices import ensure_checkpoint_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labels, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class."""
    return weighted_minhash.one_per_class(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    masked = pii.find(docs).withColumn("text", pii.mask(F.col("text"), F.col("spans")))
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: The stages learn, sample by hash and tokenize, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
