"""Evidence behind each entity: one row per entity, classed by the first rung that holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import (
    as_text,
    count_if,
    has_check,
    is_present,
    ladder,
    null_bucket,
    pct,
    present_names,
    yes_no,
)
from ledgerloom.functions.names import norm_space
from ledgerloom.operators.collide import pair_members
from ledgerloom.operators.profile import distinct_entities
from ledgerloom.operators.relate import (
    ID,
    evidence_counts,
    ids_of,
    relationships_touching,
    restrict_to_master,
    value_range,
    with_master,
)
from ledgerloom.roles import MASTER_TYPE, REDIRECTED


def of_type(entities: DataFrame, entity_type: str | None = MASTER_TYPE) -> DataFrame:
    if entity_type is None:
        return entities
    return entities.where(F.lower(F.trim(F.col("entity_type"))) == entity_type)


# --- country --------------------------------------------------------------------------------


def country_sources(
    master: DataFrame,
    entities: DataFrame,
    aliases: DataFrame,
    overlay_aliases: DataFrame,
    xids: DataFrame,
) -> DataFrame:
    """Where an entity's country is recorded: the master, the entity table, both, neither."""
    flagged = evidence_counts(
        master,
        {
            "entity_country": of_type(entities).where(is_present(F.col("country"))),
            "alias": aliases,
            "overlay_alias": overlay_aliases,
            "external_ids": xids,
        },
    ).withColumn("has_master_country", is_present(F.col("country")))
    own, other = F.col("has_master_country"), F.col("has_entity_country")
    return flagged.select(
        *master.columns,
        "has_master_country",
        "has_entity_country",
        "has_alias",
        "has_overlay_alias",
        "has_external_ids",
        (own.cast("int") + other.cast("int")).alias("country_source_count"),
        ladder(
            [(own & other, "master_and_entity"), (own, "master_only"), (other, "entity_only")],
            "no_country",
        ).alias("country_source_status"),
    )


def country_evidence(
    master: DataFrame,
    entities: DataFrame,
    links: DataFrame,
    xids: DataFrame,
    aliases: DataFrame,
    overlay_aliases: DataFrame,
) -> DataFrame:
    """Eight classes of country evidence; pathways are noted, never taken for evidence."""
    flagged = evidence_counts(
        master,
        {
            "entity_country": of_type(entities).where(is_present(F.col("country"))),
            "qid": links.where(is_present(F.col("qid"))),
            "external_ids": xids,
            "aliases": aliases,
            "overlay_aliases": overlay_aliases,
        },
    ).withColumn("has_master_country", is_present(F.col("country")))
    own, other = F.col("has_master_country"), F.col("has_entity_country")
    flags = ["entity_country", "qid", "external_ids", "aliases", "overlay_aliases"]
    return flagged.select(
        *master.columns,
        "has_master_country",
        *[f"has_{name}" for name in flags],
        ladder(
            [
                (own & other, "country_master_and_entity"),
                (own, "country_master_only"),
                (other, "country_entity_only"),
                (F.col("has_qid"), "qid_pathway"),
                (F.col("has_external_ids"), "external_id_pathway"),
                (F.col("has_overlay_aliases"), "alias_pathway"),
                (F.col("has_aliases"), "alias_only"),
            ],
            "no_country_pathway",
        ).alias("country_evidence"),
    )


# --- identity -------------------------------------------------------------------------------


def identity_evidence(
    master: DataFrame,
    links: DataFrame,
    xids: DataFrame,
    aliases: DataFrame,
    overlay_aliases: DataFrame,
) -> DataFrame:
    """Ten profiles of identity evidence, with counts per table and collision flags."""
    qids = links.where(is_present(F.col("qid")))
    providers = xids.where(is_present(F.col("provider"))).select(ID, F.trim("provider"))
    keyed = xids.where(is_present(F.col("external_id"))).select(
        ID,
        *[
            F.coalesce(F.trim(as_text(F.col(c))), F.lit("")).alias(c)
            for c in ("provider", "property", "external_id")
        ],
    )
    known = restrict_to_master(keyed, master)
    in_collision = pair_members(known, ["provider", "property", "external_id"])
    counted = evidence_counts(
        master,
        {
            "qid": qids.select(ID, "qid").distinct(),
            "xid": xids,
            "provider": providers.distinct(),
            "alias": aliases,
            "overlay_alias": overlay_aliases,
            "xid_collision": in_collision,
        },
    )
    qid, xid, alias = F.col("has_qid"), F.col("has_xid"), F.col("has_alias")
    gender, country = is_present(F.col("gender")), is_present(F.col("country"))
    overlay = F.col("has_overlay_alias")
    return counted.select(
        *master.columns,
        F.col("n_qid").alias("qid_count"),
        (F.col("n_qid") > 1).alias("qid_conflict"),
        F.col("n_xid").alias("external_id_count"),
        F.col("n_provider").alias("provider_count"),
        F.col("has_xid_collision").alias("external_id_collision"),
        F.col("n_alias").alias("alias_count"),
        F.col("n_overlay_alias").alias("overlay_alias_count"),
        gender.alias("has_gender"),
        country.alias("has_country"),
        ladder(
            [
                (~(qid | xid | alias | overlay | gender | country), "none"),
                (qid & xid & alias, "qid_xid_alias"),
                (qid & xid, "qid_xid"),
                (qid & alias, "qid_alias"),
                (xid & alias, "xid_alias"),
                (qid, "qid_only"),
                (xid, "xid_only"),
                (alias, "alias_only"),
                (gender, "gender_only"),
            ],
            "other",
        ).alias("evidence_profile"),
        (qid | xid | alias | overlay).alias("any_indirect"),
    )


def redirect_roles(master: DataFrame, redirects: DataFrame) -> DataFrame:
    """Each entity: is it a redirect's source, its target, or both at once?"""
    flagged = evidence_counts(
        master,
        {
            "redirect_source": redirects.select(F.col("from_id").alias(ID)),
            "redirect_target": redirects.select(F.col("to_id").alias(ID)),
        },
    )
    both = F.col("has_redirect_source") & F.col("has_redirect_target")
    return flagged.select(
        *master.columns,
        "has_redirect_source",
        "has_redirect_target",
        both.alias("both_redirect_roles"),
    )


def identity_consistency(
    master: DataFrame,
    entities: DataFrame,
    links: DataFrame,
    xids: DataFrame,
    aliases: DataFrame,
    overlay_aliases: DataFrame,
    redirects: DataFrame,
    excluded_checks: Sequence[str] = ("", "unverified"),
) -> DataFrame:
    """Eight pathways, three contradictions and six profiles per entity.

    ``excluded_checks`` are the check values that do not count as evidence. With the
    default, ``dob-unverified`` does count.
    """
    gendered = value_range(entities.where(F.col("gender").isNotNull()), "gender")
    counted = evidence_counts(
        master,
        {
            "qid": links,
            "external_id": xids,
            "alias": aliases,
            "overlay_alias": overlay_aliases,
            "dob_evidence": links.where(has_check(F.col("dob_check"), excluded_checks)),
            "redirect_source": redirects.select(F.col("from_id").alias(ID)),
            "redirect_target": redirects.select(F.col("to_id").alias(ID)),
        },
    ).join(gendered.select(ID, "gender_low"), ID, "left")

    source, target = F.col("has_redirect_source"), F.col("has_redirect_target")
    is_redirected = F.coalesce(F.col("status") == REDIRECTED, F.lit(False))
    has_entity_gender = F.col("gender_low").isNotNull()
    gender_conflict = (
        F.col("gender").isNotNull()
        & has_entity_gender
        & (F.lower("gender") != F.lower("gender_low"))
    )
    gender_conflict = F.coalesce(gender_conflict, F.lit(False))
    status_conflict = is_redirected != source
    both_roles = source & target
    pathways = [
        ("gender", F.col("gender").isNotNull()),
        ("qid", F.col("has_qid")),
        ("external_id", F.col("has_external_id")),
        ("alias", F.col("has_alias")),
        ("overlay_alias", F.col("has_overlay_alias")),
        ("dob", F.col("has_dob_evidence")),
        ("redirect_source", source),
        ("redirect_target", target),
    ]
    contradictions = [
        ("gender_conflict", gender_conflict),
        ("redirect_status_conflict", status_conflict),
        ("redirect_source_and_target", both_roles),
    ]
    n = F.size(F.filter(F.array(*[flag for _, flag in pathways]), lambda flag: flag))
    return counted.select(
        ID,
        "label",
        norm_space(F.col("label")).alias("normalized_label"),
        "status",
        "gender",
        yes_no(has_entity_gender).alias("has_entity_gender"),
        *[
            yes_no(F.col(c)).alias(c)
            for c in (
                "has_qid",
                "has_external_id",
                "has_alias",
                "has_overlay_alias",
                "has_dob_evidence",
                "has_redirect_source",
                "has_redirect_target",
            )
        ],
        n.alias("pathway_count"),
        present_names(pathways).alias("pathways"),
        *[yes_no(flag).alias(name) for name, flag in contradictions],
        F.when(gender_conflict | status_conflict | both_roles, "inconsistent")
        .otherwise("consistent")
        .alias("consistency"),
        present_names(contradictions).alias("contradictions"),
        ladder(
            [
                (n == 0, "no_identity_evidence"),
                (F.col("gender").isNull(), "identity_evidence_missing_gender"),
                (n >= 5, "strong_multi_pathway_identity"),
                (n >= 3, "multi_pathway_identity"),
                (n == 2, "two_pathway_identity"),
            ],
            "single_pathway_identity",
        ).alias("profile"),
    )


# --- provenance, clubs, completeness ----------------------------------------------------------


def field_sources(
    master: DataFrame, fields: Sequence[str] = ("gender", "country"), source: str = "players"
) -> DataFrame:
    """Each record with the table that supplies each field, or ``missing``."""
    def supplier(field: str) -> Column:
        return F.when(F.col(field).isNotNull(), source).otherwise("missing")

    return master.select("*", *[supplier(f).alias(f"{f}_source") for f in fields])


def field_source_summary(
    master: DataFrame, entities: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """Per field: filled in the master, filled in the entity table, equal and different."""
    filled = [F.struct(F.lit(f).alias("field"), is_present(F.col(f)).alias("filled")) for f in fields]
    own = master.select(F.inline(F.array(*filled))).groupBy("field").agg(
        count_if(F.col("filled")).alias("present"),
        count_if(~F.col("filled")).alias("missing"),
        pct(count_if(F.col("filled")), F.count("*")).alias("coverage_pct"),
    )
    pairs = master.select(ID, *[F.col(f).alias(f"{f}_m") for f in fields]).join(
        entities.select(ID, *[F.col(f).alias(f"{f}_e") for f in fields]), ID
    )
    entries = [
        F.struct(
            F.lit(f).alias("field"),
            is_present(F.col(f"{f}_e")).alias("filled"),
            F.col(f"{f}_e").eqNullSafe(F.col(f"{f}_m")).alias("same"),
        )
        for f in fields
    ]
    other = pairs.select(F.inline(F.array(*entries))).groupBy("field").agg(
        count_if(F.col("filled")).alias("entity_present"),
        count_if(F.col("same")).alias("matching"),
        count_if(~F.col("same")).alias("different"),
    )
    return own.join(other, "field", "left")


def club_evidence(clubs: DataFrame, master: DataFrame) -> DataFrame:
    """Club evidence of master entities, with the span of seasons where both ends are known."""
    rows = with_master(clubs, master, ["label", "status", "gender"])
    first, last = F.col("first_observed_season"), F.col("last_observed_season")
    return rows.withColumn("has_season_span", first.isNotNull() & last.isNotNull())


def relationship_kinds(relationships: DataFrame, master: DataFrame) -> DataFrame:
    """Kinds of the relationships that touch the master."""
    touching = relationships_touching(relationships, master)
    return touching.groupBy(null_bucket(F.col("kind")).alias("kind")).agg(
        F.count("*").alias("n"),
        count_if(F.col("from_known")).alias("from_master"),
        count_if(F.col("to_known")).alias("to_master"),
    )


def entity_completeness(
    master: DataFrame, entities: DataFrame, entity_type: str = MASTER_TYPE
) -> DataFrame:
    """One row: entities missing on either side, surplus entity rows, quality rows."""
    typed = entities.where(F.col("entity_type") == entity_type)
    sides = (
        master.groupBy(ID).agg(F.lit(1).alias("m"))
        .join(typed.groupBy(ID).agg(F.count("*").alias("e")), ID, "full_outer")
    )
    m, e = F.col("m").isNotNull(), F.col("e").isNotNull()
    return sides.agg(
        count_if(m & ~e).alias("missing_from_entities"),
        count_if(~m & e).alias("missing_from_master"),
        F.coalesce(F.sum(F.col("e") - 1), F.lit(0)).alias("duplicate_entity_rows"),
        count_if(m & e).alias("quality_rows"),
    )


def identity_quality(master: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distributions of several columns in one pass: ``field, value, n``."""
    entries = [
        F.struct(F.lit(c).alias("field"), null_bucket(F.col(c)).alias("value")) for c in columns
    ]
    return master.select(F.inline(F.array(*entries))).groupBy("field", "value").agg(
        F.count("*").alias("n")
    )


def evidence_totals(tables: Mapping[str, DataFrame], master: DataFrame) -> DataFrame:
    """One row per evidence table: rows, and distinct entities of the master."""
    parts = None
    for name, df in tables.items():
        known = ids_of(df).join(ids_of(master), ID, "left_semi")
        one = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            distinct_entities(known).scalar().alias("entities"),
        )
        parts = one if parts is None else parts.unionByName(one)
    return parts
