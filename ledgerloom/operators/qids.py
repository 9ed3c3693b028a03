"""Linked QIDs: shared ones, entities with several, and their agreement with external ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import as_text, ends, is_present, join_set
from ledgerloom.functions.names import norm_casefold
from ledgerloom.operators.collide import colliding, collision_members, key_stats, relation_of
from ledgerloom.operators.relate import ID, not_subset, restrict_to_master, value_range, with_master
from ledgerloom.operators.skew import key_counts, lookup_join
from ledgerloom.roles import MASTER_TYPE


def master_links(
    links: DataFrame, master: DataFrame, entity_type: str | None = MASTER_TYPE
) -> DataFrame:
    """Links with a QID whose entity is in the master; ``entity_type=None`` takes all types."""
    rows = links.where(is_present(F.col("qid")))
    if entity_type is not None:
        rows = rows.where(F.col("entity_type") == entity_type)
    return restrict_to_master(rows, master)


def qid_collisions(links: DataFrame) -> DataFrame:
    """QIDs linked to several entities."""
    stats = key_stats(links.where(is_present(F.col("qid"))), ["qid"])
    return colliding(stats).select("qid", "n_rows", "n_entities")


def qid_collision_rows(links: DataFrame) -> DataFrame:
    """All link rows of shared QIDs, with the size of their group."""
    return collision_members(links.where(is_present(F.col("qid"))), ["qid"])


def qid_collision_detail(
    links: DataFrame, master: DataFrame, label_key: Callable[[Column], Column] = norm_casefold
) -> DataFrame:
    """One row per entity of a shared QID: its record, and how the group's labels relate.

    The other members of a group are its other rows, so no pairs are emitted.
    """
    one = links.where(is_present(F.col("qid"))).groupBy("qid", ID).agg(
        F.min(F.struct("confidence", "dob_check")).alias("_link")
    )
    keyed = master.withColumn("_key", F.nullif(label_key(F.col("label")), F.lit("")))
    named = with_master(one, keyed, ["label", "status", "gender", "_key"], distinct=True)
    stats = named.groupBy("qid").agg(
        F.count("*").alias("group_size"),
        *ends(key=F.col("_key")),
    )
    groups = stats.where(F.col("group_size") > 1).select(
        "qid",
        "group_size",
        relation_of("key", "same_label", "same_label", "different_label").alias("label_relation"),
    )
    members = lookup_join(
        named.drop("_key"), groups, "qid", "inner", key_counts(one, ["qid"]), distinct=True
    )
    return members.select(
        "qid",
        ID,
        "group_size",
        "_link.confidence",
        "_link.dob_check",
        "label",
        "status",
        "gender",
        "label_relation",
    )


def multi_qid_entities(links: DataFrame) -> DataFrame:
    """Entities linked to several QIDs."""
    return value_range(links.where(is_present(F.col("qid"))), "qid").where(F.col("qid_count") > 1)


def qid_disagreements(links: DataFrame, xids: DataFrame) -> DataFrame:
    """Entities whose external ids name a QID that their links do not have."""
    return not_subset(
        xids.where(is_present(F.col("qid"))), links.where(is_present(F.col("qid"))), "qid"
    ).select(
        ID,
        F.col("left_values").alias("xid_qids"),
        F.col("right_values").alias("link_qids"),
        F.col("missing_values").alias("unlinked_qids"),
    )


def qid_profile(links: DataFrame, xids: DataFrame, master: DataFrame) -> DataFrame:
    """Each linked entity: QIDs and checks of its links, QIDs of its external ids."""
    linked = links.where(is_present(F.col("qid"))).groupBy(ID).agg(
        F.count("*").alias("link_rows"),
        F.count_distinct(F.col("qid")).alias("qid_count"),
        join_set(F.col("dob_check")).alias("check_values"),
    )
    other = (
        xids.where(is_present(F.col("qid")))
        .groupBy(ID)
        .agg(F.count_distinct(as_text(F.col("qid"))).alias("xid_qid_count"))
    )
    return (
        master.select(ID, "label", "status", "gender")
        .join(linked, ID)
        .join(other, ID, "left")
        .fillna(0, ["xid_qid_count"])
    )


def linked_items_per_entity(xids: DataFrame, links: DataFrame, master: DataFrame) -> DataFrame:
    """Histogram of external-id rows for entities of the master that have a QID."""
    linked = links.where(is_present(F.col("qid"))).select(ID).distinct()
    counted = xids.groupBy(ID).agg(F.count("*").alias("items"))
    kept = counted.join(linked, ID, "left_semi").join(master.select(ID), ID, "left_semi")
    return kept.groupBy("items").agg(F.count("*").alias("entities"))


def linked_provider_coverage(xids: DataFrame, links: DataFrame) -> DataFrame:
    """Entities with a QID per provider of their external ids."""
    linked = links.where(is_present(F.col("qid"))).select(ID).distinct()
    pairs = xids.select(ID, "provider").distinct().join(linked, ID, "left_semi")
    return pairs.groupBy("provider").agg(F.count("*").alias("entities"))
