"""Birth-date checks. The register holds statuses of a check, not dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import (
    clean,
    clean_or_null,
    count_if,
    is_present,
    join_set,
    ladder,
)
from ledgerloom.operators.relate import ID
from ledgerloom.roles import AGREES, UNVERIFIED

# The names under which link evidence is reported.
LINK_SOURCE = "overlay_links"
LINK_PROVIDER = "wikidata"


def _any(predicate: Column) -> Column:
    return F.coalesce(F.bool_or(predicate), F.lit(False))


def dob_evidence(master: DataFrame, links: DataFrame, xids: DataFrame) -> DataFrame:
    """Agreeing checks beat unverified ones, those beat other values, then a bare QID."""
    checked = (
        links.select(ID, F.lit(LINK_SOURCE).alias("source"), "dob_check", "qid")
        .unionByName(
            xids.select(
                ID,
                F.coalesce("provider", F.lit("unknown")).alias("source"),
                "dob_check",
                F.lit(None).cast(links.schema["qid"].dataType).alias("qid"),
            )
        )
        .withColumn("value", clean_or_null(F.col("dob_check")))
    )
    status = F.lower("value")
    per = checked.groupBy(ID).agg(
        _any(is_present(F.col("qid"))).alias("has_qid"),
        _any(status == AGREES).alias("dob_agrees"),
        _any(status == UNVERIFIED).alias("dob_unverified"),
        F.count("value").alias("dob_evidence_records"),
        join_set(F.when(F.col("value").isNotNull(), F.col("source"))).alias("dob_sources"),
        join_set(F.col("value")).alias("dob_status_values"),
    )
    joined = (
        master.select(ID, "label", "status", "gender")
        .join(per, ID, "left")
        .fillna(False, ["has_qid", "dob_agrees", "dob_unverified"])
        .fillna(0, ["dob_evidence_records"])
        .fillna("", ["dob_sources", "dob_status_values"])
    )
    return joined.withColumn(
        "dob_evidence_status",
        ladder(
            [
                (F.col("dob_agrees"), "dob_agrees"),
                (F.col("dob_unverified"), "dob_unverified"),
                (F.col("dob_evidence_records") > 0, "other_dob_status"),
                (F.col("has_qid"), "qid_without_dob_status"),
            ],
            "no_dob_evidence",
        ),
    )


def dob_sources(master: DataFrame, links: DataFrame, xids: DataFrame) -> DataFrame:
    """Tallies per source, with the overall class, the pathway and the provider support."""
    tagged = links.select(
        ID, F.lit("qid").alias("side"), F.lit("").alias("provider"), "dob_check"
    ).unionByName(
        xids.select(
            ID, F.lit("xid").alias("side"), clean(F.col("provider")).alias("provider"), "dob_check"
        )
    )
    status = clean(F.col("dob_check"))
    tallies = []
    for side in ("qid", "xid"):
        mine = F.col("side") == side
        tallies += [
            count_if(mine).alias(f"{side}_rows"),
            count_if(mine & (status == AGREES)).alias(f"{side}_dob_agrees"),
            count_if(mine & (status == UNVERIFIED)).alias(f"{side}_dob_unverified"),
            count_if(mine & ~status.isin(AGREES, UNVERIFIED)).alias(f"{side}_other_dob_status"),
        ]
    per = tagged.groupBy(ID).agg(
        *tallies,
        F.count_distinct(F.nullif(F.col("provider"), F.lit(""))).alias("provider_count"),
    )
    numbers = [c for c in per.columns if c != ID]
    joined = master.select(ID, "label", "status").join(per, ID, "left").fillna(0, numbers)

    def seen(column: str) -> Column:
        return F.col(column) > 0

    by_qid = seen("qid_dob_agrees") | seen("qid_dob_unverified")
    by_xid = seen("xid_dob_agrees") | seen("xid_dob_unverified")
    agrees = seen("qid_dob_agrees") | seen("xid_dob_agrees")
    unverified = seen("qid_dob_unverified") | seen("xid_dob_unverified")
    return joined.select(
        "*",
        ladder(
            [
                (~(by_qid | by_xid), "no_dob_evidence"),
                (agrees & unverified, "mixed_dob_status"),
                (agrees, "dob_agrees"),
                (unverified, "dob_unverified_only"),
            ],
            "other",
        ).alias("dob_classification"),
        ladder(
            [(by_qid & by_xid, "qid_and_xid"), (by_qid, "qid_only"), (by_xid, "xid_only")], "none"
        ).alias("dob_evidence_pathway"),
        ladder(
            [
                (~(by_qid | by_xid), "no_dob_evidence"),
                (F.col("provider_count") == 0, "no_provider"),
                (F.col("provider_count") == 1, "single_provider"),
            ],
            "multiple_providers",
        ).alias("provider_support_class"),
    )


def dob_by_provider(xids: DataFrame, master: DataFrame) -> DataFrame:
    """Per provider: entities of the master, and those with each status of the check."""
    status = clean(F.col("dob_check"))
    pairs = (
        xids.withColumn("provider", clean(F.col("provider")))
        .where(F.col("provider") != "")
        .groupBy("provider", ID)
        .agg(
            _any(status == AGREES).alias("a"),
            _any(status == UNVERIFIED).alias("u"),
            _any(~status.isin(AGREES, UNVERIFIED)).alias("o"),
        )
    )
    known = pairs.join(master.select(ID), ID, "left_semi")
    return known.groupBy("provider").agg(
        F.count("*").alias("entities"),
        count_if(F.col("a")).alias("dob_agrees"),
        count_if(F.col("u")).alias("dob_unverified"),
        count_if(F.col("o")).alias("other"),
    )


def dob_conflicts(master: DataFrame, links: DataFrame, xids: DataFrame) -> DataFrame:
    """Agreeing and unverified checks on one entity conflict; the providers of each side."""
    rows = links.select(
        ID, F.lit("q").alias("side"), F.lit(LINK_PROVIDER).alias("provider"), "dob_check"
    ).unionByName(
        xids.select(
            ID,
            F.lit("x").alias("side"),
            clean_or_null(F.col("provider")).alias("provider"),
            "dob_check",
        )
    )
    rows = rows.withColumn("status_key", F.lower(clean(F.col("dob_check"))))
    agrees = F.col("status_key") == AGREES
    unverified = F.col("status_key") == UNVERIFIED
    provider = F.col("provider")
    per = rows.groupBy(ID).agg(
        F.count("*").alias("evidence_rows"),
        count_if(F.col("side") == "q").alias("qid_evidence"),
        count_if(F.col("side") == "x").alias("external_id_evidence"),
        count_if(agrees).alias("agrees_count"),
        count_if(unverified).alias("unverified_count"),
        join_set(provider).alias("providers"),
        F.count_distinct(provider).alias("provider_count"),
        join_set(F.when(agrees, provider)).alias("agrees_providers"),
        join_set(F.when(unverified, provider)).alias("unverified_providers"),
    )
    texts = ["providers", "agrees_providers", "unverified_providers"]
    numbers = [c for c in per.columns if c not in (ID, *texts)]
    joined = (
        master.select(ID, "label", "status")
        .join(per, ID, "left")
        .fillna(0, numbers)
        .fillna("", texts)
    )
    a, u = F.col("agrees_count") > 0, F.col("unverified_count") > 0
    return joined.select(
        "*",
        ladder(
            [
                (F.col("evidence_rows") == 0, "no_dob_evidence"),
                (a & u, "mixed_dob_status"),
                (a, "dob_agrees"),
                (u, "dob_unverified_only"),
            ],
            "other",
        ).alias("classification"),
        (a & u).alias("is_conflict"),
    )
