"""Counts, completeness, distributions and agreement. One aggregate pass each.

Every count goes through partial aggregation, and every distinct count is keyed by
(group, value) before it is keyed by group, so a hot group is counted by all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import (
    as_text,
    count_if,
    differs,
    is_present,
    null_bucket,
    pct,
    present_names,
    share,
)
from ledgerloom.operators.relate import ID, ids_of
from ledgerloom.operators.skew import key_counts
from ledgerloom.roles import MASTER_TYPE, SOURCE_CANDIDATES, resolve_column


def as_rows(one_row: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Turn a one-row aggregate into ``metric, value`` rows."""
    names = list(names or one_row.columns)
    entries = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("value")) for n in names
    ]
    return one_row.select(F.inline(F.array(*entries)))


def audit_summary(*parts: DataFrame) -> DataFrame:
    """One report out of several one-row aggregates: ``metric, value``."""
    return reduce(DataFrame.unionByName, [as_rows(p) for p in parts])


# --- counts and keys --------------------------------------------------------------------


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def distinct_entities(df: DataFrame, key: str = ID) -> DataFrame:
    return df.where(is_present(F.col(key))).agg(F.count_distinct(F.col(key)).alias("entities"))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and rows beyond the first of their key."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = key_counts(df, keys)
    totals = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        count_if(known).alias("distinct_keys"),
    )
    return totals.withColumn("surplus_rows", F.col("total_rows") - F.col("distinct_keys"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_counts(df, keys).where(F.col("n") > 1)


def duplicate_extra_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: groups with copies, and the rows beyond the first of each group."""
    return duplicate_groups(df, keys).agg(
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Copies of whole rows."""
    return duplicate_extra_rows(df, df.columns)


# --- completeness -----------------------------------------------------------------------


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: NULL values and values of spaces only, in one pass."""
    aggregates = []
    for c in columns:
        column = F.col(c)
        aggregates += [
            count_if(column.isNull()).alias(f"{c}_nulls"),
            count_if(F.trim(as_text(column)) == "").alias(f"{c}_blanks"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("field"),
            F.col(f"{c}_nulls").alias("nulls"),
            F.col(f"{c}_blanks").alias("blanks"),
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def field_profile(df: DataFrame, columns: Sequence[str], distinct: str = "exact") -> DataFrame:
    """One row per field: total, populated, NULL, blank, distinct values, percent filled.

    ``distinct="approx"`` takes a sketch per field, which spares the expansion of the
    rows by the number of fields; use it on very large tables.
    """
    counter = {
        "exact": lambda c: F.count_distinct(c),
        "approx": lambda c: F.approx_count_distinct(c),
    }[distinct]
    aggregates = [F.count("*").alias("_total")]
    for c in columns:
        column = F.col(c)
        filled = is_present(column)
        aggregates += [
            count_if(filled).alias(f"{c}_populated"),
            count_if(column.isNull()).alias(f"{c}_nulls"),
            counter(F.when(filled, as_text(column))).alias(f"{c}_distinct"),
        ]
    total = F.col("_total")
    entries = [
        F.struct(
            F.lit(c).alias("field"),
            total.alias("total"),
            F.col(f"{c}_populated").alias("populated"),
            F.col(f"{c}_nulls").alias("nulls"),
            (total - F.col(f"{c}_populated") - F.col(f"{c}_nulls")).alias("blanks"),
            F.col(f"{c}_distinct").alias("distinct_values"),
            pct(F.col(f"{c}_populated"), total).alias("populated_pct"),
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def record_completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each record with the names of its missing fields and a flag for having none."""
    missing = [(c, ~is_present(F.col(c))) for c in columns]
    lacking = present_names(missing)
    return df.withColumn("missing_fields", lacking).withColumn(
        "core_complete", F.col("missing_fields") == ""
    )


def missing_field_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = df.agg(*[count_if(~is_present(F.col(c))).alias(c) for c in columns])
    return as_rows(counted).select(
        F.col("metric").alias("field"), F.col("value").alias("missing")
    )


def completeness_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: records, complete records, incomplete ones, and the percent complete."""
    whole = reduce(lambda a, b: a & b, [is_present(F.col(c)) for c in columns])
    totals = df.agg(F.count("*").alias("records"), count_if(whole).alias("complete"))
    return totals.select(
        "records",
        "complete",
        (F.col("records") - F.col("complete")).alias("incomplete"),
        pct(F.col("complete"), F.col("records")).alias("complete_pct"),
    )


# --- distributions ----------------------------------------------------------------------


def value_distribution(
    df: DataFrame,
    columns: Sequence[str] | str,
    null_label: str = "NULL",
    entity: str | None = None,
) -> DataFrame:
    """Rows per value (or combination), with percent of all rows, and entities on request."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    keyed = [null_bucket(F.col(c), null_label).alias(c) for c in columns]
    aggregates = [F.count("*").alias("n")]
    if entity:
        keyed.append(F.col(entity).alias("_entity"))
        aggregates.append(F.count_distinct(F.col("_entity")).alias("entities"))
    counted = df.select(*keyed).groupBy(*columns).agg(*aggregates)
    total = counted.agg(F.sum("n")).scalar().alias("_total")
    return counted.select("*", total).select(
        *counted.columns, pct(F.col("n"), F.col("_total")).alias("pct")
    )


def most_common(df: DataFrame, column: str, k: int, null_label: str = "NULL") -> DataFrame:
    """The k most common values; ties go by value."""
    counted = value_distribution(df, column, null_label)
    return counted.orderBy(F.desc("n"), F.asc(column)).limit(k)


def source_distribution(df: DataFrame, candidates: Sequence[str] = SOURCE_CANDIDATES) -> DataFrame:
    """Distribution of the first source column that the table has."""
    column = resolve_column(df, candidates)
    if column is None:
        raise ValueError(f"none of {list(candidates)} is a column")
    return value_distribution(df.select(F.col(column).alias("source")), "source")


def linked_distribution(links: DataFrame, master: DataFrame, column: str) -> DataFrame:
    """Link rows per value of a master attribute; rows are counted per id before the join."""
    counted = key_counts(links, [ID], "_rows")
    return (
        master.select(ID, null_bucket(F.col(column)).alias(column))
        .join(counted, ID)
        .groupBy(column)
        .agg(F.sum("_rows").alias("n"), F.count("*").alias("entities"))
    )


def provider_profile(xids: DataFrame, by: Sequence[str] = ("provider",)) -> DataFrame:
    """Rows, entities and distinct external ids per provider (or provider and property)."""
    return xids.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.col(ID)).alias("entities"),
        F.count_distinct(F.col("external_id")).alias("external_ids"),
    )


def provider_property_profile(xids: DataFrame) -> DataFrame:
    return provider_profile(xids, ("provider", "property"))


def items_per_entity(df: DataFrame, key: str = ID) -> DataFrame:
    """Histogram: how many entities have how many rows."""
    counted = key_counts(df.where(F.col(key).isNotNull()), [key], "items")
    return counted.groupBy("items").agg(F.count("*").alias("entities"))


def items_summary(df: DataFrame, key: str = ID, marks: Sequence[int] = (10, 20)) -> DataFrame:
    """One row: entities, the largest number of rows, and entities at or above each mark."""
    counted = key_counts(df.where(F.col(key).isNotNull()), [key], "items")
    return counted.agg(
        F.count("*").alias("entities"),
        F.coalesce(F.max("items"), F.lit(0)).alias("max_items"),
        *[count_if(F.col("items") >= m).alias(f"entities_{m}_plus") for m in marks],
    )


def entities_per_key(df: DataFrame, key: str, entity: str = ID) -> DataFrame:
    """Histogram: how many keys are held by how many entities."""
    counted = df.groupBy(key).agg(F.count_distinct(F.col(entity)).alias("entities"))
    return counted.groupBy("entities").agg(F.count("*").alias("keys"))


def rows_per_entity_buckets(master: DataFrame, child: DataFrame, key: str = ID) -> DataFrame:
    """One row: master entities with 0, 1, 2 to 5 and more than 5 child rows."""
    counted = key_counts(child, [key], "_n")
    per = master.select(key).join(counted, key, "left").select(
        F.coalesce("_n", F.lit(0)).alias("n")
    )
    n = F.col("n")
    return per.agg(
        F.count("*").alias("entities"),
        count_if(n == 0).alias("zero_rows"),
        count_if(n == 1).alias("one_row"),
        count_if(n.between(2, 5)).alias("two_to_five"),
        count_if(n > 5).alias("over_five"),
        share(F.sum("n"), F.count("*")).alias("average_rows"),
        F.max("n").alias("max_rows"),
    )


def kinds_per_entity(aliases: DataFrame, kind: str = "kind") -> DataFrame:
    """Histogram: how many entities have how many different kinds."""
    kinds = aliases.select(ID, null_bucket(F.col(kind), "<NULL>").alias("_k")).distinct()
    counted = kinds.groupBy(ID).agg(F.count("*").alias("kinds"))
    return counted.groupBy("kinds").agg(F.count("*").alias("entities"))


def entities_with(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """One row: distinct entities that pass each test on at least one of their rows."""
    per = df.groupBy(ID).agg(
        *[F.coalesce(F.bool_or(test), F.lit(False)).alias(name) for name, test in tests.items()]
    )
    return per.agg(*[count_if(F.col(name)).alias(name) for name in tests])


def coverage(master: DataFrame, child: DataFrame) -> DataFrame:
    """One row: master entities with and without child rows, and the percent covered."""
    marked = ids_of(master).join(
        ids_of(child).withColumn("_c", F.lit(True)), ID, "left"
    )
    totals = marked.agg(F.count("*").alias("total"), F.count("_c").alias("covered"))
    return totals.select(
        "total",
        "covered",
        (F.col("total") - F.col("covered")).alias("uncovered"),
        pct(F.col("covered"), F.col("total")).alias("covered_pct"),
    )


# --- agreement of two tables --------------------------------------------------------------


def _paired(left: DataFrame, right: DataFrame, fields: Sequence[str]) -> DataFrame:
    a = left.select(ID, *[F.col(f).alias(f"{f}_left") for f in fields])
    b = right.select(ID, *[F.col(f).alias(f"{f}_right") for f in fields])
    return a.join(b, ID)


def _unlike(field: str) -> Column:
    return differs(F.col(f"{field}_left"), F.col(f"{field}_right"))


def agreement(left: DataFrame, right: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: common records and the number that differ in each field."""
    return _paired(left, right, fields).agg(
        F.count("*").alias("total"), *[count_if(_unlike(f)).alias(f"{f}_diff") for f in fields]
    )


def field_differences(left: DataFrame, right: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per entity and field that differ, with both values."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    _unlike(f),
                    F.struct(
                        F.lit(f).alias("field"),
                        as_text(F.col(f"{f}_left")).alias("left_value"),
                        as_text(F.col(f"{f}_right")).alias("right_value"),
                    ),
                )
                for f in fields
            ]
        )
    )
    return _paired(left, right, fields).select(ID, F.inline(entries))


def record_matches(left: DataFrame, right: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: common records equal in every field, and the others."""
    same = reduce(lambda a, b: a & b, [~_unlike(f) for f in fields])
    return _paired(left, right, fields).agg(
        count_if(same).alias("matching"), count_if(~same).alias("mismatching")
    )


def match_by_type(child: DataFrame, parent: DataFrame, kind: str = "entity_type") -> DataFrame:
    """Child rows of each type that do and do not match a parent; counted before the join."""
    counted = key_counts(child, [ID, kind], "_rows")
    known = ids_of(parent).withColumn("_known", F.lit(True))
    joined = counted.join(known, ID, "left")
    hit = F.col("_known").isNotNull()
    return (
        joined.groupBy(null_bucket(F.col(kind), "<NULL>").alias(kind))
        .agg(
            F.sum("_rows").alias("rows_total"),
            F.coalesce(F.sum(F.when(hit, F.col("_rows"))), F.lit(0)).alias("rows_matching"),
        )
        .withColumn("rows_unmatched", F.col("rows_total") - F.col("rows_matching"))
    )


def type_contamination(
    child: DataFrame, kind: str = "entity_type", expected: str = MASTER_TYPE
) -> DataFrame:
    """One row: rows whose type is NULL, blank, or another than expected."""
    value = F.col(kind)
    blank = F.trim(value) == ""
    return child.agg(
        F.count("*").alias("total_rows"),
        count_if(value.isNull()).alias("null_type"),
        count_if(blank).alias("blank_type"),
        count_if(value.isNotNull() & ~blank & (value != expected)).alias("other_type"),
    )
