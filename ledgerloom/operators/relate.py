"""Relations between tables by id: membership, orphans, coverage, evidence flags, id sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import count_if, ends, null_bucket
from ledgerloom.operators.skew import key_counts, lookup_flag, lookup_join, one_per_key

ID = "entity_id"


def ids_of(df: DataFrame, key: str = ID) -> DataFrame:
    return df.select(F.col(key).alias(ID)).where(F.col(ID).isNotNull()).distinct()


# --- row-level joins of a child table to its master ---------------------------------


def restrict_to_master(child: DataFrame, master: DataFrame, key: str = ID) -> DataFrame:
    """Child rows whose id is in the master."""
    ids = ids_of(master).withColumnRenamed(ID, key)
    return lookup_join(child, ids, key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str = ID) -> DataFrame:
    """Child rows whose id is not in the parent (a NULL id is an orphan)."""
    ids = ids_of(parent).withColumnRenamed(ID, key)
    return lookup_join(child, ids, key, "left_anti")


def missing_parents(master: DataFrame, child: DataFrame, key: str = ID) -> DataFrame:
    """Master rows without any child row."""
    return master.join(ids_of(child).withColumnRenamed(ID, key), key, "left_anti")


def with_master(
    child: DataFrame,
    master: DataFrame,
    columns: Sequence[str],
    prefix: str = "",
    how: str = "inner",
    key: str = ID,
    distinct: bool = False,
) -> DataFrame:
    """Child rows with columns of their master row (``distinct`` as in ``lookup_join``).

    Ids of the master must be unique, which ``plans.gates.validate_rows`` checks first.
    """
    picked = master.select(
        F.col(ID).alias(key), *[F.col(c).alias(f"{prefix}{c}") for c in columns]
    )
    return lookup_join(child, picked, key, how, distinct=distinct)


def split_by_master(child: DataFrame, master: DataFrame, key: str = ID) -> DataFrame:
    """One row: child rows and entities inside the master and outside it."""
    counted = key_counts(child, [key], "_rows").withColumnRenamed(key, ID)
    known = ids_of(master).withColumn("_known", F.lit(True))
    joined = counted.join(known, ID, "left")
    inside = F.col("_known").isNotNull()
    rows = F.coalesce(F.sum(F.when(inside, F.col("_rows"))), F.lit(0))
    out = F.coalesce(F.sum(F.when(~inside, F.col("_rows"))), F.lit(0))
    return joined.agg(
        rows.alias("rows_in_master"),
        out.alias("rows_outside"),
        count_if(inside).alias("entities_in_master"),
        count_if(~inside & F.col(ID).isNotNull()).alias("entities_outside"),
    )


def with_endpoints(
    edges: DataFrame, nodes: DataFrame, columns: Sequence[str], inner_source: bool = True
) -> DataFrame:
    """Distinct edges with the columns of both end nodes, as ``from_*`` and ``to_*``.

    ``nodes`` is unique by id. Hot ends are counted on the edges themselves, once per end.
    """
    def end(side: str) -> DataFrame:
        return nodes.select(
            F.col(ID).alias(f"{side}_id"), *[F.col(c).alias(f"{side}_{c}") for c in columns]
        )

    how = "inner" if inner_source else "left"
    sources, targets = key_counts(edges, ["from_id"]), key_counts(edges, ["to_id"])
    left = lookup_join(edges, end("from"), "from_id", how, sources, distinct=True)
    return lookup_join(left, end("to"), "to_id", "left", targets, distinct=True)


def relationships_touching(relationships: DataFrame, master: DataFrame) -> DataFrame:
    """Edges of which either end is in the master (two flags instead of an OR join)."""
    ids = ids_of(master)
    flagged = lookup_flag(relationships, ids, "from_id", "from_known")
    flagged = lookup_flag(flagged, ids, "to_id", "to_known", key_counts(relationships, ["to_id"]))
    return flagged.where(F.col("from_known") | F.col("to_known"))


def unpublished_links(
    links: DataFrame, master: DataFrame, entities: DataFrame, redirects: DataFrame
) -> DataFrame:
    """Link rows whose id is not published, with what the entity table and the redirects say."""
    details = [c for c in entities.columns if c not in (ID, "entity_type")]
    reasons = redirects.groupBy(F.col("from_id").alias(ID)).agg(
        F.min(F.coalesce("reason", F.lit("NULL"))).alias("redirect_reason")
    )
    known = one_per_key(entities.select(ID, *details, F.lit(True).alias("_known")), [ID])
    facts = (
        ids_of(links)
        .join(ids_of(master), ID, "left_anti")
        .join(known, ID, "left")
        .join(reasons, ID, "left")
    )
    described = lookup_join(links, facts, ID, "inner")
    return described.withColumn(
        "entity_presence", F.when(F.col("_known"), "entity_present").otherwise("entity_missing")
    ).withColumn(
        "redirect_reason", F.coalesce("redirect_reason", F.lit("no_redirect"))
    ).drop("_known")


def unpublished_summary(unpublished: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of unpublished links by the value of each column: ``field, value, n``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("field"), null_bucket(F.col(c)).alias("value")) for c in columns]
    )
    return unpublished.select(F.inline(pairs)).groupBy("field", "value").agg(
        F.count("*").alias("n")
    )


# --- coverage and evidence ------------------------------------------------------------


def _tagged(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Union of (id, table name, rows), counted per id before it is unioned."""
    parts = [
        key_counts(df.where(F.col(ID).isNotNull()), [ID], "_n").withColumn("_t", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def coverage_two(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ids in both tables, in the left only, in the right only."""
    sides = _tagged({"l": left, "r": right}).groupBy(ID).agg(
        F.bool_or(F.col("_t") == "l").alias("l"), F.bool_or(F.col("_t") == "r").alias("r")
    )
    return sides.agg(
        count_if(F.col("l") & F.col("r")).alias("both_sides"),
        count_if(F.col("l") & ~F.col("r")).alias("left_only"),
        count_if(~F.col("l") & F.col("r")).alias("right_only"),
    )


def evidence_counts(master: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Master rows with ``n_<table>`` and ``has_<table>`` for every evidence table.

    The tables are counted per id, unioned and folded in one shuffle, then joined once;
    there is no join per table.
    """
    folded = _tagged(tables).groupBy(ID).agg(
        *[F.sum(F.when(F.col("_t") == name, F.col("_n"))).alias(f"n_{name}") for name in tables]
    )
    joined = master.join(folded, ID, "left")
    for name in tables:
        joined = joined.withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0)))
    return joined.select(
        "*", *[(F.col(f"n_{name}") > 0).alias(f"has_{name}") for name in tables]
    )


def value_count(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Per id: the number of distinct values."""
    kept = rows.where(F.col(value).isNotNull())
    return kept.groupBy(ID).agg(F.count_distinct(F.col(value)).alias(name))


def value_marks(rows: DataFrame, value: str) -> DataFrame:
    """Per id: both ends of the marks of a column."""
    kept = rows.where(F.col(value).isNotNull())
    return kept.groupBy(ID).agg(*ends(**{value: F.col(value)}))


def value_range(rows: DataFrame, value: str, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Per key: least, greatest and number of distinct values; no set is collected."""
    return (
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(
            F.min(value).alias(f"{value}_low"),
            F.max(value).alias(f"{value}_high"),
            F.count_distinct(F.col(value)).alias(f"{value}_count"),
        )
    )


# --- id-set algebra ---------------------------------------------------------------------


def id_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    return ids_of(left).join(ids_of(right), ID, "left_anti")


def id_and(left: DataFrame, right: DataFrame) -> DataFrame:
    return ids_of(left).join(ids_of(right), ID, "left_semi")


def id_or(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [ids_of(t) for t in tables]).distinct()


def not_subset(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """Per id that occurs in both: how many of its left values the right side lacks (> 0).

    (id, value) pairs are folded with a side flag, so no set is held per id.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        pairs = df.where(F.col(ID).isNotNull() & F.col(value).isNotNull())
        return pairs.select(ID, value).distinct().withColumn("_t", F.lit(tag))

    pairs = side(left, "l").unionByName(side(right, "r")).groupBy(ID, value).agg(
        F.bool_or(F.col("_t") == "l").alias("l"), F.bool_or(F.col("_t") == "r").alias("r")
    )
    return (
        pairs.groupBy(ID)
        .agg(
            count_if(F.col("l")).alias("left_values"),
            count_if(F.col("r")).alias("right_values"),
            count_if(F.col("l") & ~F.col("r")).alias("missing_values"),
        )
        .where((F.col("left_values") > 0) & (F.col("right_values") > 0))
        .where(F.col("missing_values") > 0)
    )


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
