"""Gates: frames of ``check_name, passed, found`` and the verdict over them.

A gate is one aggregate per table, turned into rows; the gates on a build share one row of
counters, which a single scan of each table gives. Where several gates read that row it is
written first. ``require_passed`` reads back the failed checks, as many as there are checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import count_if, is_present
from ledgerloom.operators.profile import table_counts
from ledgerloom.operators.relate import ID, split_by_master
from ledgerloom.operators.skew import key_counts
from ledgerloom.operators.slices import cut
from ledgerloom.plans.master import TABLE_COLUMNS
from ledgerloom.roles import MASTER_TYPE


def checks(one_row: DataFrame, expected_zero: Sequence[str]) -> DataFrame:
    """Counters of a one-row frame as checks that pass at zero."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            (F.col(name) == 0).alias("passed"),
            F.col(name).cast("long").alias("found"),
        )
        for name in expected_zero
    ]
    return one_row.select(F.inline(F.array(*entries)))


def union_checks(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def verdict(results: DataFrame, good: str = "PASS", bad: str = "FAIL") -> DataFrame:
    """One row: checks, failed checks, and the status."""
    failed = count_if(~F.col("passed"))
    return results.agg(F.count("*").alias("checks"), failed.alias("failed")).withColumn(
        "status", F.when(F.col("failed") == 0, good).otherwise(bad)
    )


def require_passed(results: DataFrame) -> None:
    """Raise with the names of the failed checks."""
    failed = [row.check_name for row in results.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"failed checks: {sorted(failed)}")


# --- gates on one table ---------------------------------------------------------------------


def _duplicate_ids(df: DataFrame, key: str = ID) -> Column:
    counted = key_counts(df.where(F.col(key).isNotNull()), [key])
    return counted.agg(count_if(F.col("n") > 1)).scalar()


def validate_rows(df: DataFrame, required: Sequence[str] = (ID, "label")) -> DataFrame:
    """Every required field is filled, and ids are unique."""
    counted = df.agg(
        *[count_if(~is_present(F.col(c))).alias(f"{c}_missing") for c in required]
    ).withColumn("duplicate_ids", _duplicate_ids(df))
    return checks(counted, counted.columns)


def validate_preserved(
    before: DataFrame, after: DataFrame, columns: Sequence[str] = ("label",)
) -> DataFrame:
    """Nothing was lost, added or changed: counted per (id, values) on both sides."""
    fields = [ID, *columns]
    tagged = before.select(*fields, F.lit(1).alias("_d")).unionByName(
        after.select(*fields, F.lit(-1).alias("_d"))
    )
    balance = tagged.groupBy(*fields).agg(F.sum("_d").alias("_d"))
    counted = balance.agg(
        F.coalesce(F.sum(F.when(F.col("_d") > 0, F.col("_d"))), F.lit(0)).alias("records_lost"),
        F.coalesce(F.sum(F.when(F.col("_d") < 0, -F.col("_d"))), F.lit(0)).alias("records_added"),
    )
    return checks(counted, counted.columns)


def validate_entities(
    master: DataFrame, entities: DataFrame, entity_type: str = MASTER_TYPE
) -> DataFrame:
    """One row: master records, those the entity table knows under the type, and the rest."""
    typed = entities.where(F.col("entity_type") == entity_type).select(ID)
    hits = key_counts(typed, [ID], "_n")
    joined = master.select(ID).join(hits, ID, "left")
    total = F.sum(F.coalesce("_n", F.lit(1)))
    matching = F.coalesce(F.sum("_n"), F.lit(0))
    return joined.agg(
        total.alias("total"), matching.alias("matching"), (total - matching).alias("missing")
    )


# --- gates on the build -----------------------------------------------------------------------


def validate_references(built: Mapping[str, DataFrame]) -> DataFrame:
    """No child row without its master record."""
    parts = []
    for name, df in built.items():
        if name in ("master", "metadata"):
            continue
        outside = split_by_master(df, built["master"]).select(
            F.col("rows_outside").alias(f"{name}_orphans")
        )
        parts.append(checks(outside, outside.columns))
    return union_checks(*parts)


Expected = Mapping[str, int] | DataFrame


def validate_counts(tables: Mapping[str, DataFrame], expected: Expected) -> DataFrame:
    """Row counts against expected ones: ``table_name, expected, actual, passed``.

    ``expected`` is a mapping, or a table (table_name, expected). A table that it names and
    that is not there has no actual count and does not pass.
    """
    return _against(expected, table_counts(tables))


def _against(expected: Expected, counted: DataFrame) -> DataFrame:
    if not isinstance(expected, DataFrame):
        expected = counted.sparkSession.createDataFrame(list(expected.items()), "table_name string, expected bigint")
    return expected.join(counted, "table_name", "left").select(
        "table_name",
        F.col("expected").cast("long").alias("expected"),
        F.col("n").alias("actual"),
        F.coalesce(F.col("expected") == F.col("n"), F.lit(False)).alias("passed"),
    )


def validate_schema(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[str]] = TABLE_COLUMNS
) -> dict[str, bool]:
    """Exact column lists, in order; answered from the schemas without a job."""
    return {
        name: name in tables and list(tables[name].columns) == list(columns)
        for name, columns in expected.items()
    }


def _flags() -> dict[str, dict[str, Column]]:
    """Per table the conditions that no row may meet, by the name of their counter."""

    def missing(**names: str) -> dict[str, Column]:
        return {alias: ~is_present(F.col(c)) for alias, c in names.items()}

    return {
        "master": {
            **missing(null_player_ids=ID, null_labels="label", null_status="status"),
            "non_player_rows": ~F.col("entity_type").eqNullSafe(F.lit(MASTER_TYPE)),
        },
        "aliases": missing(alias_null_ids=ID, alias_null_values="alias"),
        "external_ids": missing(
            external_null_ids=ID,
            external_null_values="external_id",
            external_null_providers="provider",
            external_null_namespaces="namespace",
        ),
        "clubs": missing(club_null_ids=ID, club_null_evidence="observed_clubs"),
    }


def build_counters(built: Mapping[str, DataFrame]) -> DataFrame:
    """One row with all counters of a build, and ``rows_<table>``, from one scan of each table.

    Rows of all tables become counters under their id and are folded by id, in the map tasks
    first; an id that the master has more than once, or not at all, shows in its one row.
    """
    flags = _flags()
    tables = ["master", *[n for n in built if n not in ("master", "metadata")]]
    names = [f"rows_{t}" for t in tables] + [n for t in tables for n in flags.get(t, {})]
    parts = []
    for table in tables:
        own = {f"rows_{table}": F.lit(True), **flags.get(table, {})}
        # a condition that is null is not met
        told = [F.coalesce(own.get(n, F.lit(False)).cast("bigint"), F.lit(0).cast("bigint")).alias(n) for n in names]
        parts.append(built[table].select(ID, *told))
    by_id = reduce(DataFrame.unionByName, parts).groupBy(ID).agg(*[F.sum(n).alias(n) for n in names])
    outside = F.col(ID).isNull() | (F.col("rows_master") == 0)

    def repeated(table: str) -> Column:
        return count_if(F.col(ID).isNotNull() & (F.col(f"rows_{table}") > 1))

    return by_id.agg(
        *[F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in names],
        repeated("master").alias("duplicate_players"),
        *[repeated(t).alias("club_duplicate_ids") for t in tables if t == "clubs"],
        *[
            F.coalesce(F.sum(F.when(outside, F.col(f"rows_{t}"))), F.lit(0).cast("bigint")).alias(f"{t}_orphans")
            for t in tables[1:]
        ],
    )


def build_checks(built: Mapping[str, DataFrame], counters: DataFrame | None = None) -> DataFrame:
    """All counters of the build that must be zero, one check each."""
    counted = build_counters(built) if counters is None else counters
    return checks(counted, [c for c in counted.columns if not c.startswith("rows_")])


# The counters that decide the status of a build.
BUILD_CONDITIONS = (
    "duplicate_players",
    "null_player_ids",
    "non_player_rows",
    "null_labels",
    "null_status",
    "aliases_orphans",
    "external_ids_orphans",
    "clubs_orphans",
    "club_duplicate_ids",
    "alias_null_ids",
    "external_null_ids",
)


def _counts_match(built: Mapping[str, DataFrame], expected: Expected, counters: DataFrame) -> DataFrame:
    """All expected counts as one check; the counters have those of most tables."""
    rows = [c for c in counters.columns if c.startswith("rows_")]
    known = [F.struct(F.lit(c.removeprefix("rows_")).alias("table_name"), F.col(c).alias("n")) for c in rows]
    counted = counters.select(F.inline(F.array(*known)))
    others = {name: df for name, df in built.items() if f"rows_{name}" not in rows}
    if others:
        counted = counted.unionByName(table_counts(others))
    return _against(expected, counted).agg(
        F.lit("expected_counts").alias("check_name"),
        F.bool_and("passed").alias("passed"),
        count_if(~F.col("passed")).alias("found"),
    )


def build_status(
    built: Mapping[str, DataFrame],
    source: DataFrame,
    expected: Expected | None = None,
) -> DataFrame:
    """PASS when all conditions hold, else REVIEW_REQUIRED."""
    counters = cut(build_counters(built))
    difference = F.abs(F.col("rows_master") - source.agg(F.count("*")).scalar())
    counted = counters.withColumn("source_count_difference", difference)
    parts = [checks(counted, [*BUILD_CONDITIONS, "source_count_difference"])]
    if expected is not None:
        parts.append(_counts_match(built, expected, counters))
    return verdict(union_checks(*parts), "PASS", "REVIEW_REQUIRED")


# The final checks and the counters that each of them sums up.
FINAL_CHECKS = {
    "player_identity": ("duplicate_players", "null_player_ids", "non_player_rows"),
    "required_player_fields": ("null_player_ids", "null_labels", "null_status"),
    "aliases": ("aliases_orphans", "alias_null_ids", "alias_null_values"),
    "external_ids": (
        "external_ids_orphans",
        "external_null_ids",
        "external_null_values",
        "external_null_providers",
        "external_null_namespaces",
    ),
    "observed_clubs": (
        "clubs_orphans",
        "club_null_ids",
        "club_null_evidence",
        "club_duplicate_ids",
    ),
}


def structural_checks(
    built: Mapping[str, DataFrame], metadata: bool = True, counters: DataFrame | None = None
) -> DataFrame:
    """Presence of the tables, and the counters of single conditions."""
    names = [*TABLE_COLUMNS] if metadata else [t for t in TABLE_COLUMNS if t != "metadata"]
    spark = built["master"].sparkSession
    exists = spark.createDataFrame(
        [(f"{n}_table_exists", n in built, 0) for n in names],
        "check_name string, passed boolean, found bigint",
    )
    single = (
        "duplicate_players",
        "null_player_ids",
        "non_player_rows",
        "null_labels",
        "null_status",
        "aliases_orphans",
        "external_ids_orphans",
        "clubs_orphans",
        "club_null_ids",
        "external_null_values",
    )
    counted = build_counters(built) if counters is None else counters
    return exists.unionByName(checks(counted, single))


def final_audit(
    built: Mapping[str, DataFrame], expected: Expected | None = None, counters: DataFrame | None = None
) -> DataFrame:
    """The final checks: required tables, schemas, five groups of counters, expected counts."""
    counters = cut(build_counters(built)) if counters is None else counters
    sums = {name: sum((F.col(p) for p in parts), F.lit(0)) for name, parts in FINAL_CHECKS.items()}
    counted = checks(counters.select(*[total.alias(name) for name, total in sums.items()]), list(sums))
    schemas = validate_schema(built)
    spark = built["master"].sparkSession
    fixed = spark.createDataFrame(
        [
            ("required_tables", all(name in built for name in TABLE_COLUMNS), 0),
            ("schemas", all(schemas.values()), 0),
        ],
        counted.schema,
    )
    parts = [fixed, counted]
    if expected is not None:
        parts.append(_counts_match(built, expected, counters))
    return union_checks(*parts)


def final_verdict(
    built: Mapping[str, DataFrame], expected: Expected | None = None
) -> DataFrame:
    """PASS when all structural and all final checks hold, else FAIL."""
    counters = cut(build_counters(built))
    return verdict(union_checks(structural_checks(built, True, counters), final_audit(built, expected, counters)))
