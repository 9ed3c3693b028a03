"""External ids held by several entities, typed and rolled up; nothing is merged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import (
    as_text,
    clean,
    clean_gender,
    clean_or_null,
    count_if,
    ends,
    is_present,
    join_set,
    ladder,
    merged_ends,
)
from ledgerloom.operators.collide import (
    colliding,
    colliding_entities,
    collision_totals,
    key_stats,
    pair_members,
    relation_of,
    shared_keys,
)
from ledgerloom.operators.listing import value_counts, value_counts_text
from ledgerloom.operators.relate import ID, with_master
from ledgerloom.operators.skew import beside, lookup_join

EXACT = ["provider", "property", "external_id"]
PROVIDER = ["provider", "external_id"]


def master_xids(
    xids: DataFrame, master: DataFrame, label_key: Callable[[Column], Column] | None = None
) -> DataFrame:
    """External ids of master entities, keys cleaned, with label, status and gender.

    With ``label_key``, also ``name``, the label's key, worked out once per master record.
    The operators below read this frame several times; ``cut`` it when it is large.
    """
    rows = xids.select(
        ID,
        *[clean(F.col(c)).alias(c) for c in EXACT],
        "rank",
        "confidence",
        clean_or_null(F.col("dob_check")).alias("dob_check"),
        clean_or_null(F.col("qid")).alias("qid"),
    ).where(F.col("external_id") != "")
    columns = ["label", "status", "gender"]
    if label_key is not None:
        master = master.withColumn("name", label_key(F.col("label")))
        columns.append("name")
    return with_master(rows, master, columns)


# --- exact-key collisions -----------------------------------------------------------------


def xid_collisions(rows: DataFrame) -> DataFrame:
    """Keys (provider, property, id) of several entities: labels, QIDs, distributions.

    Distributions are of attributes with few values; confidences, which may all differ, are
    rows of ``collision_confidences``. Only rows of colliding keys are taken apart.
    """
    held = rows.join(shared_keys(rows, EXACT), EXACT, "left_semi")
    labelled = held.withColumn("label", F.coalesce("label", F.lit("")))
    stats = labelled.groupBy(*EXACT).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.col(ID)).alias("n_entities"),
        F.count_distinct(F.col("qid")).alias("qid_count"),
        *ends(label=F.col("label")),
    )
    groups = colliding(stats).select(
        *EXACT,
        "n_rows",
        "n_entities",
        "qid_count",
        relation_of("label", "same_label", "same_label", "different_label").alias("label_relation"),
        F.when(F.col("qid_count") > 1, "qid_conflict")
        .otherwise("qid_consistent")
        .alias("qid_consistency"),
    )
    texts = value_counts_text(held, EXACT, ["dob_check", "status", "gender"], null_label="NULL")
    return groups.join(texts, EXACT)


def collision_members(rows: DataFrame) -> DataFrame:
    """Members of the keys (provider, property, id) that several entities hold, one per row."""
    return pair_members(rows, EXACT)


def collision_confidences(rows: DataFrame) -> DataFrame:
    """How often each confidence occurs under a key that several entities hold."""
    return value_counts(rows.join(shared_keys(rows, EXACT), EXACT, "left_semi"), EXACT, "confidence")


def xid_collision_totals(rows: DataFrame) -> DataFrame:
    """One row: distinct keys, groups, memberships and entities for both kinds of key."""
    exact = collision_totals(rows, EXACT, "exact_")
    provider = collision_totals(rows, PROVIDER, "provider_")
    return beside(exact, provider)


def xid_provider_collisions(rows: DataFrame) -> DataFrame:
    """Keys (provider, id) of several entities, and whether properties split them."""
    stats = rows.groupBy(*PROVIDER).agg(
        F.count_distinct(F.col(ID)).alias("n_entities"),
        F.count_distinct(F.col("property")).alias("properties"),
    )
    return colliding(stats).withColumn(
        "split_class",
        F.when(F.col("properties") > 1, "property_split").otherwise("same_property"),
    )


def xid_collision_by_provider(rows: DataFrame) -> DataFrame:
    """Per provider: rows, entities, ids, exact collision groups, memberships, entities hit."""
    overall = rows.groupBy("provider").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.col(ID)).alias("entities"),
        F.count_distinct(F.col("external_id")).alias("external_ids"),
    )
    pairs = rows.select(*EXACT, ID).distinct()
    members = pair_members(pairs, EXACT)
    hit = members.groupBy("provider").agg(
        F.count("*").alias("collision_rows"),
        F.count_distinct(F.col(ID)).alias("collision_entities"),
    )
    groups = colliding(key_stats(pairs, EXACT)).groupBy("provider").agg(
        F.count("*").alias("exact_collision_groups")
    )
    joined = overall.join(groups, "provider", "left").join(hit, "provider", "left")
    return joined.fillna(0)


# --- typed conflicts on (provider, id) ------------------------------------------------------


def _holders(rows: DataFrame) -> DataFrame:
    """One row per (provider, property, id, entity) with the ends of its attributes."""
    return rows.groupBy(*EXACT, ID).agg(
        *ends(
            qid=F.col("qid"),
            dob=F.col("dob_check"),
            name=F.col("name"),
            gender=F.col("gender"),
        ),
    )


def _group_ends(holders: DataFrame) -> DataFrame:
    return holders.groupBy(*PROVIDER).agg(
        F.count_distinct(F.col(ID)).alias("n_entities"),
        *merged_ends("name", "gender", "qid", "dob"),
    )


def xid_conflicts(rows: DataFrame) -> DataFrame:
    """Conflicts on (provider, id): their type, and how labels, genders, QIDs, checks relate.

    ``rows`` carry the name by which labels are compared, ``norm_words`` in the register.
    """
    named = rows.withColumn("name", F.nullif("name", F.lit(""))).withColumn(
        "gender", clean_or_null(F.col("gender"))
    )
    holders = _holders(named)
    by_property = holders.groupBy(*EXACT).agg(F.count("*").alias("n"))
    exact = by_property.groupBy(*PROVIDER).agg(
        F.count("*").alias("exact_keys"),
        count_if(F.col("property") != "").alias("properties"),
        count_if(F.col("n") > 1).alias("exact_collision_keys"),
    )
    groups = colliding(_group_ends(holders)).join(exact, PROVIDER)
    return groups.select(
        *PROVIDER,
        "n_entities",
        "properties",
        "exact_keys",
        "exact_collision_keys",
        ladder(
            [
                (F.col("exact_collision_keys") > 0, "exact_id_collision"),
                (F.col("properties") > 1, "cross_property_collision"),
            ],
            "provider_id_collision",
        ).alias("conflict_type"),
        relation_of(
            "name",
            "different_normalized_labels",
            "same_normalized_label",
            "different_normalized_labels",
        ).alias("label_relation"),
        relation_of(
            "gender", "same_or_missing_gender", "same_or_missing_gender", "different_gender"
        ).alias("gender_relation"),
        relation_of("qid", "no_qid", "shared_qid", "different_qids").alias("qid_relation"),
        relation_of("dob", "no_dob_status", "same_dob_status", "mixed_dob_status").alias(
            "dob_relation"
        ),
    )


def entity_conflicts(rows: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Each entity in a conflict: groups by type, the types and providers, and group sizes.

    ``other_memberships`` adds up the other holders over the entity's groups; the holders
    themselves are the rows of ``conflict_members``, which lists no pairs.
    """
    members = conflict_members(rows, conflicts)
    return members.groupBy(ID).agg(
        F.count("*").alias("provider_collision_groups"),
        F.sum("exact_collision_keys").alias("exact_collision_groups"),
        count_if(F.col("properties") > 1).alias("cross_property_groups"),
        join_set(F.col("conflict_type")).alias("conflict_types"),
        join_set(F.col("provider")).alias("providers"),
        F.count_distinct(F.col("external_id")).alias("external_ids"),
        F.sum(F.col("n_entities") - 1).alias("other_memberships"),
        F.max("n_entities").alias("largest_group"),
    )


def conflict_members(rows: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One row per (provider, id, entity) of the conflict groups, with the group's columns."""
    pairs = rows.select(*PROVIDER, ID).distinct()
    return lookup_join(pairs, conflicts, PROVIDER, "inner", distinct=True, measured=rows)


def exact_collision_entities(rows: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One row: entities that hold a colliding exact key themselves, and the wider count of
    all entities in groups that contain one."""
    pairs = rows.select(*EXACT, ID).distinct()
    wide = conflict_members(rows, conflicts.where(F.col("exact_collision_keys") > 0))
    return beside(
        colliding_entities(pairs, EXACT).withColumnRenamed("entities", "exact_members"),
        wide.agg(F.count_distinct(F.col(ID)).alias("group_members")),
    )


# --- identity of the holders --------------------------------------------------------------


def xid_identity_groups(rows: DataFrame) -> DataFrame:
    """Shared (provider, id) by how names, genders, QIDs and checks of the holders relate.

    ``rows`` carry the name by which labels are compared, ``norm_compact`` in the register.
    """
    named = rows.where(F.col("provider") != "").select(
        *EXACT,
        ID,
        "qid",
        F.lower("dob_check").alias("dob_check"),
        "name",
        clean_gender(F.col("gender")).alias("gender"),
    )
    holders = _holders(named)
    properties = holders.where(F.col("property") != "").groupBy(*PROVIDER).agg(
        F.count_distinct(F.col("property")).alias("properties")
    )
    groups = colliding(_group_ends(holders)).join(properties, PROVIDER, "left")
    return groups.select(
        *PROVIDER,
        "n_entities",
        F.coalesce("properties", F.lit(0)).alias("properties"),
        relation_of(
            "name",
            "different_normalized_label",
            "same_normalized_label",
            "different_normalized_label",
        ).alias("name_relation"),
        relation_of(
            "gender", "same_or_missing_gender", "same_or_missing_gender", "different_gender"
        ).alias("gender_relation"),
        relation_of("qid", "no_qid", "shared_qid", "different_qids").alias("qid_relation"),
        relation_of("dob", "same_dob_status", "same_dob_status", "mixed_dob_status").alias(
            "dob_relation"
        ),
    )


def entity_xid_identity(rows: DataFrame, groups: DataFrame, master: DataFrame) -> DataFrame:
    """Each entity: no shared external id, shared without conflict, or an identity conflict."""
    def any_of(column: str, value: str) -> Column:
        return F.bool_or(F.col(column) == value)

    members = conflict_members(rows, groups)
    per = members.groupBy(ID).agg(
        F.count("*").alias("conflict_group_count"),
        join_set(F.col("provider"), ",").alias("conflict_providers"),
        F.count_distinct(F.col("external_id")).alias("conflict_external_ids"),
        any_of("name_relation", "different_normalized_label").alias("name_conflict"),
        any_of("gender_relation", "different_gender").alias("gender_conflict"),
        any_of("qid_relation", "different_qids").alias("qid_conflict"),
        any_of("dob_relation", "mixed_dob_status").alias("dob_conflict"),
    )
    flags = ["name_conflict", "gender_conflict", "qid_conflict", "dob_conflict"]
    joined = (
        master.select(ID, "label", "status", "gender")
        .join(per, ID, "left")
        .fillna(0, ["conflict_group_count", "conflict_external_ids"])
        .fillna("", ["conflict_providers"])
        .fillna(False, flags)
    )
    return joined.withColumn(
        "identity_status",
        ladder(
            [
                (F.col("conflict_group_count") == 0, "no_external_id_conflict"),
                (
                    F.col("name_conflict")
                    | F.col("gender_conflict")
                    | F.col("qid_conflict")
                    | F.col("dob_conflict"),
                    "identity_conflict",
                ),
            ],
            "shared_external_id",
        ),
    )


# --- quality per entity -------------------------------------------------------------------


def xid_quality(xids: DataFrame, master: DataFrame) -> DataFrame:
    """Each entity: external-id rows, keys, providers, QIDs, and distributions as text."""
    rows = xids.select(
        ID,
        *[F.coalesce(as_text(F.col(c)), F.lit("")).alias(f"_{c}") for c in EXACT],
        "provider",
        F.when(
            F.col("provider").isNotNull(),
            F.concat_ws("|", "provider", F.coalesce("property", F.lit("<NULL>"))),
        ).alias("provider_property"),
        F.coalesce("dob_check", F.lit("<NULL>")).alias("dob_check"),
        F.when(is_present(F.col("qid")), F.trim(as_text(F.col("qid")))).alias("qid"),
    )
    totals = rows.groupBy(ID).agg(
        F.count_distinct(*[f"_{c}" for c in EXACT]).alias("xid_keys"),
        F.count_distinct(F.col("qid")).alias("qid_count"),
    )
    attributes = ["provider", "provider_property", "dob_check"]
    texts = value_counts_text(
        rows, [ID], attributes, null_label=None, n_rows="xid_rows", sizes={"provider": "providers"}
    )
    numbers = ["xid_rows", "xid_keys", "providers", "qid_count"]
    joined = master.join(totals, ID, "left").join(texts, ID, "left")
    counts = [f"{a}_counts" for a in attributes]
    return joined.select(
        *master.columns,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        *[F.coalesce(c, F.lit("")).alias(c) for c in counts],
    )
