"""Writing tables, records, reports and metadata. Nothing is overwritten unless asked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Facts about a build that are constants of the method.
BUILD_CONSTANTS = {
    "career_history_complete": "false",
    "club_evidence_basis": (
        "clubs this person appears for in the register's own match coverage; "
        "not a complete career history"
    ),
    "country_field_included": "false",
    "coach_records_in_player_master": "false",
    "source_read_only": "true",
}


def write_tables(
    tables: Mapping[str, DataFrame], root: str, mode: str = "errorifexists"
) -> None:
    """One Parquet directory per table. The default refuses to replace what is there."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{root}/{name}.parquet")


def write_records_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines that keep NULL fields; text stays UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists"
) -> None:
    """CSV with a header and a fixed column order."""
    writer = df.select(*columns).write.mode(mode).option("header", True)
    writer.option("quote", '"').option("escape", '"').csv(path)


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row report as a single JSON document."""
    report.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)


def nested_report(**sections: DataFrame) -> Column:
    """Struct of scalar subqueries: each section is a one-row frame."""
    parts = []
    for name, df in sections.items():
        row = df.select(F.struct(*df.columns).alias(name))
        parts.append(row.scalar().alias(name))
    return F.struct(*parts)


def metadata_table(counts: DataFrame, facts: Mapping[str, str] | None = None) -> DataFrame:
    """Key and value rows: the counts of a build (one row) and what is fixed about it."""
    fixed = {**BUILD_CONSTANTS, **(facts or {})}
    measured = [
        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
        for c in counts.columns
    ]
    constant = [
        F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in fixed.items()
    ]
    return counts.select(F.inline(F.array(*measured, *constant)))


def append_events(df: DataFrame, path: str) -> None:
    """Add to the event log; earlier events are never touched."""
    stamped = df.withColumn("logged_at", F.current_timestamp())
    stamped.write.mode("append").option("ignoreNullFields", "false").json(path)
