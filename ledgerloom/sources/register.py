"""Reading the register: tables, catalogue, record files, and the profile feed."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.roles import require_tables
from ledgerloom.sources import documents

# The batch functions travel to the executors whole, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The shape of one record of the profile feed.
FEED_SCHEMA = (
    "entity_id string, label string, profile_feed_version string, schema_version string, "
    "status string, gender string, country string, "
    "position struct<primary: string, secondary: string, status: string, "
    "evidence_count: bigint, provider_count: bigint>, "
    "club_evidence string, "
    "index struct<alias_count: bigint, external_id_count: bigint>"
)


def load_register(
    spark: SparkSession,
    root: str,
    tables: Iterable[str],
    views: bool = False,
) -> dict[str, DataFrame]:
    """One Parquet directory or file per table under ``root``; nothing is written there."""
    register = {name: spark.read.parquet(f"{root}/{name}.parquet") for name in tables}
    if views:
        for name, df in register.items():
            df.createOrReplaceTempView(name)
    return register


def load_catalog(spark: SparkSession, database: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    """The same from a catalogue, so that source and output can be two of its databases."""
    missing = [t for t in tables if not spark.catalog.tableExists(f"{database}.{t}")]
    if missing:
        raise ValueError(f"{database} lacks the tables {missing}")
    return {t: spark.table(f"{database}.{t}") for t in tables}


def describe_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, type and place of every column, from the schemas alone."""
    rows = [
        (name, field.name, field.dataType.simpleString(), place)
        for name, df in tables.items()
        for place, field in enumerate(df.schema.fields)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, ordinal int"
    )


def catalog_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column of every table with its type and the number of the table's rows."""
    require_tables(tables, tables)
    parts = []
    for name, df in tables.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                    F.lit(place).alias("ordinal"),
                    F.col("n_rows").alias("n_rows"),
                )
                for place, field in enumerate(df.schema.fields)
            ]
        )
        parts.append(df.agg(F.count("*").alias("n_rows")).select(F.inline(columns)))
    return reduce(DataFrame.unionByName, parts)


def sample_tables(tables: Mapping[str, DataFrame], n: int = 5) -> dict[str, DataFrame]:
    return {name: df.limit(n) for name, df in tables.items()}


def stable_samples(strata: Mapping[str, tuple[DataFrame, Sequence[str]]], n: int = 5) -> DataFrame:
    """stratum, place, row (JSON): the first ``n`` rows of each stratum (frame, order), all from
    one pass.

    Every task keeps the ``n`` least rows of each stratum, and only these are moved and merged.
    Frames may be tables, or the problems of one table; rows alike in their order go by all columns.
    """
    parts, most = [], max(len(order) for _, order in strata.values())
    for name, (df, order) in strata.items():
        row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        parts.append(
            df.select(
                F.lit(name).alias("stratum"),
                *[c.alias(f"_{k}") for k, c in enumerate(_order_keys(df, order, most))],
                row.alias("row"),
            )
        )
    first = Window.partitionBy("stratum").orderBy(*[f"_{k}" for k in range(2 * most)], "row")
    united = reduce(DataFrame.unionByName, parts)
    return united.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n).select("stratum", "place", "row")


def _order_keys(df: DataFrame, order: Sequence[str], most: int) -> list[Column]:
    """Two keys for each column of the order: numbers go by the first, all else by the second."""
    keys = []
    for name in [*order, *[None] * (most - len(order))]:
        numeric = name and isinstance(df.schema[name].dataType, T.NumericType)
        keys += [
            (F.col(name) if numeric else F.lit(None)).cast("decimal(38,6)"),
            (F.col(name) if name and not numeric else F.lit(None)).cast("string"),
        ]
    return keys


def read_records_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON file, or a folder of parts, that holds a list of records, read in splits; anything
    else fails."""
    return documents.read_json_array(spark, path, schema)


#: Where a line of a feed was read: enough to give it its position later on.
PLACE = ("source_file", "block", "line", "blank")


def feed_lines(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """The lines of a feed (value) with their file, the block of it that a task read, and a
    number that rises within the block."""
    reader = spark.readStream if stream else spark.read
    lines = reader.options(**options).text(path, lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.trim("value") == "").alias("blank"),
    )
    if not stream:
        return lines.withColumn("line", F.monotonically_increasing_id())
    # streams have no such number; a task reads its lines in order
    return lines.mapInArrow(_numbered, "value string, source_file string, block bigint, blank boolean, line bigint")


def _numbered(batches: Iterator) -> Iterator:
    import pyarrow as pa

    number = 0
    for batch in batches:
        lines = pa.array(range(number, number + batch.num_rows), pa.int64())
        number += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, lines], [*batch.schema.names, "line"])


def place_lines(lines: DataFrame, base: int = 0, position: str = "feed_index") -> DataFrame:
    """``lines`` with their positions, blank lines (which count) left out.

    Positions run through the files in the order of their names, from ``base`` on. They hang
    neither on how files are cut into blocks nor on how many files are read at once: with the
    number of lines read before as ``base``, later files get what they would get in one go.
    Nothing is moved but one row per block.
    """
    blocks = lines.groupBy("source_file", "block").agg(F.min("line").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("source_file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = lines.where("NOT blank").join(F.broadcast(blocks), ["source_file", "block"])
    index = F.lit(base) + F.col("_skip") + F.col("line") - F.col("_first")
    return placed.withColumn(position, index.cast("bigint")).drop("_first", "_skip", "block", "line", "blank")


def parse_lines(lines: DataFrame, schema: T.StructType | str = FEED_SCHEMA) -> DataFrame:
    """The records of feed lines; a line that is no JSON record fails while it is read."""
    record = F.from_json("value", schema, {"mode": "FAILFAST"})
    others = [c for c in lines.columns if c != "value"]
    return lines.withColumn("_record", F.when(F.trim("value") != "", record)).select("_record.*", *others)


def read_feed(
    spark: SparkSession, path: str, stream: bool = False, schema: T.StructType | str = FEED_SCHEMA, **options: str
) -> DataFrame:
    """The profile feed, one JSON record per line, with its file and its position ``feed_index``.

    A stream gives all lines, with PLACE in place of the position, which ``publish_batch`` works
    out by the number of lines published before.
    """
    lines = feed_lines(spark, path, stream, **options)
    return parse_lines(lines if stream else place_lines(lines), schema)


def with_provenance(report: DataFrame, source: DataFrame) -> DataFrame:
    """A report with the number and size of its input files, and the time it was made."""
    files = source.select("_metadata.file_path", "_metadata.file_size").distinct()
    facts = files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")
    )
    return report.select(
        "*",
        facts.select("files").scalar().alias("input_files"),
        facts.select("bytes").scalar().alias("input_bytes"),
        F.current_timestamp().alias("generated_at"),
    )
