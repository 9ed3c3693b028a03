"""Gender evidence: pathways, classes, and how missing values could be reached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import clean_gender, count_if, is_present, ladder
from ledgerloom.functions.names import norm_ascii
from ledgerloom.operators.relate import ID, evidence_counts, value_range
from ledgerloom.operators.skew import lookup_join


def gender_flags(
    master: DataFrame,
    links: DataFrame,
    xids: DataFrame,
    aliases: DataFrame,
    overlay_aliases: DataFrame,
) -> DataFrame:
    """Master rows with a cleaned gender and a flag per indirect pathway."""
    cleaned = master.withColumn("gender", clean_gender(F.col("gender")))
    return evidence_counts(
        cleaned,
        {
            "qid": links.where(is_present(F.col("qid"))),
            "xid": xids,
            "alias": aliases,
            "overlay_alias": overlay_aliases,
        },
    ).drop("n_qid", "n_xid", "n_alias", "n_overlay_alias")


def gender_profile(flags: DataFrame) -> DataFrame:
    """Ten pathway profiles."""
    gender = F.col("gender").isNotNull()
    qid, xid, alias = F.col("has_qid"), F.col("has_xid"), F.col("has_alias")
    return flags.withColumn(
        "gender_profile",
        ladder(
            [
                (gender & qid & xid, "gender_qid_xid"),
                (gender & qid, "gender_qid"),
                (gender & xid, "gender_xid"),
                (gender & alias, "gender_alias"),
                (gender, "gender_only"),
                (qid & xid, "qid_xid_no_gender"),
                (qid, "qid_no_gender"),
                (xid, "xid_no_gender"),
                (alias | F.col("has_overlay_alias"), "alias_no_gender"),
            ],
            "no_gender_evidence",
        ),
    )


def gender_identity(
    flags: DataFrame, entities: DataFrame, label_key=norm_ascii
) -> DataFrame:
    """Eleven classes: what a missing gender could rest on, and what speaks against a known one."""
    cleaned = entities.withColumn("entity_gender", clean_gender(F.col("gender")))
    of_entity = value_range(cleaned, "entity_gender").select(
        ID,
        F.when(F.col("entity_gender_count") == 1, F.col("entity_gender_low")).alias(
            "entity_gender"
        ),
    )
    keyed = flags.withColumn("normalized_label", label_key(F.col("label")))
    counted = keyed.groupBy("normalized_label").agg(F.count("*").alias("n"))
    shared = counted.where((F.col("n") > 1) & (F.col("normalized_label") != "")).select(
        "normalized_label", F.lit(True).alias("label_collision")
    )
    marked = lookup_join(
        keyed, shared, "normalized_label", "left", counted, distinct=True
    ).join(of_entity, ID, "left")
    marked = marked.fillna(False, ["label_collision"])
    conflict: Column = F.coalesce(F.col("gender") != F.col("entity_gender"), F.lit(False))
    missing = F.col("gender").isNull()
    qid, xid = F.col("has_qid"), F.col("has_xid")
    return marked.select(
        *[c for c in flags.columns],
        "normalized_label",
        "entity_gender",
        "label_collision",
        conflict.alias("entity_gender_conflict"),
        ladder(
            [
                (missing & qid & xid, "missing_gender_qid_xid"),
                (missing & qid, "missing_gender_qid"),
                (missing & xid, "missing_gender_xid"),
                (
                    missing & (F.col("has_alias") | F.col("has_overlay_alias")),
                    "missing_gender_alias",
                ),
                (missing, "missing_gender_no_path"),
                (conflict, "gender_entity_conflict"),
                (F.col("label_collision"), "gender_with_label_collision"),
                (qid & xid, "gender_qid_xid"),
                (qid, "gender_qid"),
                (xid, "gender_xid"),
            ],
            "gender_no_indirect_path",
        ).alias("classification"),
    )


def missing_gender_paths(flags: DataFrame) -> DataFrame:
    """One row: entities without gender, and how many each pathway could reach."""
    missing = F.col("gender").isNull()
    alias = F.col("has_alias") | F.col("has_overlay_alias")
    return flags.agg(
        count_if(missing).alias("missing_gender"),
        count_if(missing & F.col("has_qid")).alias("with_qid"),
        count_if(missing & F.col("has_xid")).alias("with_xid"),
        count_if(missing & alias).alias("with_alias"),
        count_if(missing & (F.col("has_qid") | F.col("has_xid") | alias)).alias("with_any_path"),
    )
