"""Audit of the precomputed search index against the master and the entity table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.exprs import count_if, differs_blank, is_short
from ledgerloom.functions.names import norm_trim
from ledgerloom.operators.profile import coverage, duplicate_extra_rows, rows_per_entity_buckets
from ledgerloom.operators.relate import ID, missing_parents, orphans, split_by_master, with_master
from ledgerloom.operators.skew import beside, one_per_key
from ledgerloom.roles import MASTER_TYPE


def search_coverage(master: DataFrame, search: DataFrame) -> DataFrame:
    """One row: master entities with search rows, and how many rows they have."""
    covered = coverage(master, search)
    buckets = rows_per_entity_buckets(master, search)
    return beside(covered, buckets.drop("entities"))


def _texts(search: DataFrame) -> DataFrame:
    present = search.where(F.col("search_text").isNotNull())
    return present.withColumn("search_value", norm_trim(F.col("search_text")))


def search_duplicates(search: DataFrame) -> DataFrame:
    """Search texts that one entity carries several times.

    Texts are grouped by a digest next to the id, so whole texts are compared but short
    keys are shuffled.
    """
    keyed = _texts(search).select(
        ID, F.sha2("search_value", 256).alias("digest"), F.length("search_value").cast("long").alias("chars")
    )
    counted = keyed.groupBy(ID, "digest", "chars").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > 1)


def search_text_quality(search: DataFrame) -> DataFrame:
    """One row: duplicate groups, rows beyond the first, blank and one-to-two-letter texts."""
    keyed = _texts(search).select(ID, F.sha2("search_value", 256).alias("digest"))
    duplicates = duplicate_extra_rows(keyed, [ID, "digest"])
    trimmed = F.trim(F.col("search_text"))
    texts = search.agg(
        F.count("*").alias("search_rows"),
        count_if(F.col("search_text").isNull() | (trimmed == "")).alias("blank_texts"),
        count_if(is_short(F.col("search_text"))).alias("short_texts"),
    )
    return beside(texts, duplicates)


def _linked(search: DataFrame, entities: DataFrame) -> DataFrame:
    """Search rows with the type and label of their entity; the entity table is not checked,
    so of several records of an id the least is taken."""
    columns = ["entity_type", "label"]
    known = one_per_key(entities.select(ID, *columns), [ID])
    return with_master(search, known, columns, "known_")


def search_consistency(search: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: linked rows by type, orphans, and type and label mismatches."""
    linked = _linked(search, entities)
    kind = F.col("known_entity_type")
    counts = linked.agg(
        F.count("*").alias("linked_rows"),
        count_if(kind == MASTER_TYPE).alias("master_type_rows"),
        count_if(kind != MASTER_TYPE).alias("other_type_rows"),
        count_if(F.col("entity_type") != kind).alias("type_mismatches"),
        count_if(differs_blank(F.col("label"), F.col("known_label"))).alias("label_mismatches"),
    )
    outside = split_by_master(search, entities).select(F.col("rows_outside").alias("orphan_rows"))
    return beside(counts, outside)


def search_evidence(master: DataFrame, search: DataFrame) -> DataFrame:
    """One row: bridge and alias counts that the index carries, per joined row of the master."""
    bridged = F.coalesce("bridge_count", F.lit(0)) > 0
    aliased = F.coalesce("alias_count", F.lit(0)) > 0
    pairs = (
        search.groupBy(ID)
        .agg(
            F.count("*").alias("n"),
            count_if(bridged).alias("b"),
            count_if(aliased).alias("a"),
            count_if(~bridged & ~aliased).alias("z"),
        )
    )
    joined = master.select(ID).join(pairs, ID, "left")
    return joined.agg(
        F.sum(F.coalesce("n", F.lit(1))).alias("joined_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("with_bridges"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("with_aliases"),
        F.sum(F.coalesce("z", F.lit(1))).alias("without_bridge_or_alias"),
    )


def search_cardinality(search: DataFrame) -> DataFrame:
    """One row: search texts and different search texts."""
    return search.agg(
        F.count("search_text").alias("total_texts"),
        F.count_distinct(F.sha2("search_text", 256)).alias("distinct_texts"),
    )


# --- the first n examples of each problem, in a stable order -----------------------------------


def sample_without_search(master: DataFrame, search: DataFrame, n: int = 25) -> DataFrame:
    return missing_parents(master, search).select(ID, "label").orderBy(ID).limit(n)


def sample_orphans(search: DataFrame, entities: DataFrame, n: int = 25) -> DataFrame:
    rows = orphans(search, entities).select(ID, "entity_type", "label", "search_text")
    return rows.orderBy(ID, "search_text").limit(n)


def sample_type_mismatches(search: DataFrame, entities: DataFrame, n: int = 25) -> DataFrame:
    rows = _linked(search, entities).where(F.col("entity_type") != F.col("known_entity_type"))
    picked = rows.select(ID, "known_entity_type", "entity_type", "known_label")
    return picked.orderBy(ID, "entity_type").limit(n)


def sample_label_mismatches(search: DataFrame, entities: DataFrame, n: int = 25) -> DataFrame:
    rows = _linked(search, entities).where(differs_blank(F.col("label"), F.col("known_label")))
    return rows.select(ID, "known_label", "label").orderBy(ID, "label").limit(n)


def sample_duplicates(search: DataFrame, n: int = 25) -> DataFrame:
    return search_duplicates(search).orderBy(F.desc("n"), ID, "digest").limit(n)
