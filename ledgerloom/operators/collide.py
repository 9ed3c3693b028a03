"""Keys held by several entities. Collisions are reported; nothing is ever merged.

A group is described by counts and by the least and greatest value of each attribute,
which is all its relations need. Members stay flat rows, one per (key, entity), so a
group that owns a third of the table is still spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import count_if, ends, is_present, merged_ends, relation
from ledgerloom.operators.listing import member_records
from ledgerloom.operators.relate import ID, value_count, value_marks
from ledgerloom.operators.skew import beside, key_counts, lookup_join


def key_stats(
    rows: DataFrame, keys: Sequence[str], attributes: Sequence[str] = (), entity: str = ID
) -> DataFrame:
    """Per key: rows, distinct entities, and both ends of every attribute's marks."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.col(entity)).alias("n_entities"),
        *ends(**{a: F.col(a) for a in attributes}),
    )


def colliding(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("n_entities") > 1)


def relation_of(attribute: str, none: str, one: str, many: str) -> Column:
    return relation(F.col(f"{attribute}_low"), F.col(f"{attribute}_high"), none, one, many)


def collision_members(
    rows: DataFrame,
    keys: Sequence[str],
    stats: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Rows whose key collides, with the size of their group."""
    stats = key_stats(rows, keys) if stats is None else stats
    groups = colliding(stats).select(*keys, F.col("n_entities").alias("group_size"))
    counts = stats.select(*keys, F.col("n_rows").alias("n"))
    return lookup_join(rows, groups, keys, "inner", counts, distinct)


def pair_members(rows: DataFrame, keys: Sequence[str], entity: str = ID) -> DataFrame:
    """The same over distinct (key, entity) pairs, one row per member of a group."""
    pairs = rows.select(*keys, entity).distinct()
    groups = key_counts(pairs, keys, "group_size").where(F.col("group_size") > 1)
    return lookup_join(pairs, groups, keys, "inner", distinct=True, measured=rows)


def entities_in(members: DataFrame, entity: str = ID) -> DataFrame:
    return members.agg(F.count_distinct(F.col(entity)).alias("entities"))


def shared_keys(rows: DataFrame, keys: Sequence[str], entity: str = ID) -> DataFrame:
    """Keys of several entities, a NULL one counted too, by the ends of their ids alone."""
    ends_ = rows.groupBy(*keys).agg(
        F.min(entity).alias("_low"), F.max(entity).alias("_high"), F.bool_or(F.col(entity).isNull()).alias("_null")
    )
    several = (F.col("_low") != F.col("_high")) | (F.col("_null") & F.col("_low").isNotNull())
    return ends_.where(several).select(*keys)


def colliding_entities(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``entities`` in collisions, from distinct (key, entity) pairs, without a join.

    An entity is in one if it holds more keys than it holds alone, and who holds a key alone is
    the least holder of it. As in joins, NULL keys do not count.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    one = F.when(whole, 1).otherwise(0)  # no filter, so that both reads of the pairs are alike
    held = pairs.groupBy(ID).agg(F.sum(one).alias("n"))
    holders = pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.min(ID).alias(ID))
    alone = holders.where(F.col("n") == 1).select(ID, (-one).alias("n"))
    counted = held.unionByName(alone).groupBy(ID).agg(F.sum("n").alias("n"))
    return counted.agg(count_if(F.col(ID).isNotNull() & (F.col("n") > 0)).alias("entities"))


def collision_totals(rows: DataFrame, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """One row: distinct keys, colliding groups, memberships, and entities involved."""
    pairs = rows.select(*keys, ID).distinct()
    n = F.col("n")
    totals = key_counts(pairs, keys).agg(
        F.count("*").alias("distinct_keys"),
        count_if(n > 1).alias("groups"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("memberships"),
    )
    totals = beside(totals, colliding_entities(pairs, keys))
    return totals.toDF(*[f"{prefix}{c}" for c in totals.columns])


# --- names --------------------------------------------------------------------------------


def with_key(master: DataFrame, key: Callable[[Column], Column], name: str) -> DataFrame:
    return master.withColumn(name, key(F.col("label")))


def name_collision_groups(named: DataFrame, key: str = "normalized_name") -> DataFrame:
    """Names shared by several records, with the number of records."""
    counted = named.groupBy(key).agg(F.count("*").alias("record_count"))
    return counted.where(F.col("record_count") > 1)


def name_collisions(named: DataFrame, key: str = "normalized_name") -> DataFrame:
    """Every record of a colliding name, one row each, with the size of its group."""
    counted = named.groupBy(key).agg(F.count("*").alias("n"))
    groups = counted.where(F.col("n") > 1).withColumnRenamed("n", "record_count")
    return lookup_join(named, groups, key, "inner", counted, distinct=True)


def collision_summary(named: DataFrame, key: str = "normalized_name") -> DataFrame:
    """One row: records, distinct and unique names, groups, members, the largest group."""
    counted = named.groupBy(key).agg(F.count("*").alias("n"))
    n = F.col("n")
    return counted.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_records"),
        F.count("*").alias("distinct_names"),
        count_if(n == 1).alias("unique_names"),
        count_if(n > 1).alias("collision_groups"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("records_in_groups"),
        F.coalesce(F.max(F.when(n > 1, n)), F.lit(0)).alias("largest_group"),
    )


def flatten_collisions(
    named: DataFrame,
    key: str = "normalized_name",
    columns: Sequence[str] = ("label", "status", "gender"),
) -> DataFrame:
    """Colliding names with the ids, labels, statuses and genders of their members, one per row."""
    members = name_collisions(named, key)
    return member_records(members, [key, "record_count"], ID, columns)


# --- labels -------------------------------------------------------------------------------


def label_collisions(master: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """One row: groups and entities that share a label as written, and a normalized one."""
    labels = master.where(F.col("label") != "").select(ID, "label")
    exact = collision_totals(labels, ["label"], "exact_")
    keyed = with_key(labels, key, "key").where(F.col("key") != "").select(ID, "key")
    normal = collision_totals(keyed, ["key"], "normalized_")
    return beside(exact, normal)


def label_collision_profile(
    master: DataFrame, links: DataFrame, key: Callable[[Column], Column]
) -> DataFrame:
    """Colliding labels with the relation of their labels, genders and QIDs."""
    qids = value_marks(links.where(is_present(F.col("qid"))), "qid")
    keyed = (
        with_key(master, key, "normalized_label")
        .where(F.col("normalized_label") != "")
        .select(
            ID,
            "normalized_label",
            F.nullif(F.col("label"), F.lit("")).alias("label"),
            F.nullif(F.col("gender"), F.lit("")).alias("gender"),
        )
        .join(qids, ID, "left")
    )
    stats = keyed.groupBy("normalized_label").agg(
        F.count("*").alias("n_entities"),
        *ends(label=F.col("label"), gender=F.col("gender")),
        *merged_ends("qid"),
    )
    return colliding(stats).select(
        "normalized_label",
        "n_entities",
        relation_of("label", "different_label", "same_label", "different_label").alias(
            "label_relation"
        ),
        relation_of("gender", "no_gender", "same_gender", "different_gender").alias(
            "gender_relation"
        ),
        relation_of("qid", "no_qid", "shared_qid", "different_qid").alias("qid_relation"),
    )


def entity_label_profile(
    master: DataFrame, links: DataFrame, key: Callable[[Column], Column]
) -> DataFrame:
    """Each entity: no label, a label of its own, or one it shares; and its QID count."""
    keyed = with_key(master, key, "normalized_label")
    counted = keyed.groupBy("normalized_label").agg(F.count("*").alias("n"))
    shared = counted.where((F.col("n") > 1) & (F.col("normalized_label") != "")).withColumnRenamed(
        "n", "group_size"
    )
    grouped = lookup_join(keyed, shared, "normalized_label", "left", counted, distinct=True)
    qids = value_count(links.where(is_present(F.col("qid"))), "qid", "qid_count")
    joined = grouped.join(qids, ID, "left")
    return joined.select(
        *master.columns,
        "normalized_label",
        F.when(F.coalesce(F.col("label"), F.lit("")) == "", "no_label")
        .when(F.col("group_size").isNull(), "unique_label")
        .otherwise("label_collision")
        .alias("label_profile"),
        F.col("group_size").isNotNull().cast("int").alias("collision_group_count"),
        F.coalesce("qid_count", F.lit(0)).alias("qid_count"),
    )


def label_gender_collisions(master: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """Colliding labels by the relation of their genders (genders already cleaned)."""
    keyed = with_key(master, key, "normalized_label").where(F.col("normalized_label") != "")
    stats = key_stats(keyed, ["normalized_label"], ["gender"])
    return colliding(stats).select(
        "normalized_label",
        "n_entities",
        relation_of("gender", "no_gender", "same_gender", "different_gender").alias(
            "gender_relation"
        ),
    )


def class_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each class of each column occurs: ``field, value, n``."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return df.select(F.inline(entries)).groupBy("field", "value").agg(F.count("*").alias("n"))
