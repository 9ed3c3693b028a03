"""Registered queries of the training-data operators: name -> (query, SQL or None)."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (
    flat_graph,
    mtree,
    oracles as sql,
    packing,
    phrases,
    pii,
    quotes,
    sentencepieces,
    spelling,
    syncmers,
    token_rollups,
    toxicity,
    url_filter,
    weighted_minhash,
)
from ledgerloom.llm.common import documents
from ledgerloom.operators.skew import lookup_join
from ledgerloom.operators.slices import cut, ensure_checkpoint_dir


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.digests(_table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after three batches: all documents come in, exact copies of a document with a
    lesser id go, and the white space of the rest is squeezed. One batch is sent twice, and
    the first two are compacted before the third."""
    seen = cut(token_rollups.counted(_table(spark, folder, "documents")))
    first = seen.groupBy("h").agg(F.min("doc_id").alias("first_id"))
    stays = F.col("doc_id").eqNullSafe(F.col("first_id"))
    told = lookup_join(seen, first, "h").withColumn("stays", stays)

    def changes(rows: DataFrame, op: str, tokens: str, old: str | None = None) -> DataFrame:
        each = rows.select("source", "lang", F.explode("counts").alias("c"))
        return each.select(
            F.lit(op).alias("op"),
            "source",
            "lang",
            "c.tokenizer_version",
            F.col(tokens).alias("tokens"),
            (F.col(old) if old else F.lit(None).cast("bigint")).alias("old_tokens"),
        )

    rollup = token_rollups.TokenRollup(spark, f"{ensure_checkpoint_dir(spark)}/rollup-{uuid4().hex}")
    copies = changes(told.where(~F.col("stays")), "delete", "c.n")
    rollup.commit("load", changes(seen, "insert", "c.n"))
    rollup.commit("copies", copies)
    rollup.commit("copies", copies)
    rollup.compact()
    rollup.commit("copies", copies)
    rollup.commit("squeeze", changes(told.where("stays"), "revise", "c.slim", "c.n"))
    return rollup.totals()


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return weighted_minhash.near_duplicates(_table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rules, and a list of the canonical URLs that several pages have."""
    pages = _table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.repeated_urls(pages))


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.fingerprints(_table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(documents(_table(spark, folder, "documents")))
    counts = [pii.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(F.col("spans"), pii.is_base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, folder, "labels")))


def op10_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations, sent as mail with quotes of the two turns before, and read back."""
    return quotes.conversations(quotes.as_mail(_table(spark, folder, "conversations")))


def op11_vector_classes(spark: SparkSession, folder: str) -> DataFrame:
    return flat_graph.near_duplicates(_table(spark, folder, "embeddings"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


QUERIES = {
    "op1_sentencepiece": (op1_sentencepiece, None),
    "op2_token_counts": (op2_token_counts, None),
    "op3_near_duplicates": (op3_near_duplicates, None),
    "op4_url_filter": (op4_url_filter, sql.URL_FILTER),
    "op5_top_k": (op5_top_k, sql.TOP_K),
    "op6_fingerprints": (op6_fingerprints, None),
    "op7_pii": (op7_pii, sql.PII),
    "op8_packing": (op8_packing, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_conversations": (op10_conversations, sql.CONVERSATIONS),
    "op11_vector_classes": (op11_vector_classes, sql.EMBEDDINGS),
    "op12_spelling": (op12_spelling, sql.SPELLING),
    "op13_phrases": (op13_phrases, sql.PHRASES),
}
