"""Ordered work cut into even slices: numbering and looking one row back.

An unpartitioned window sorts everything in one task, and a window over a hot key sorts
a third of it there. Here a range partitioning cuts the order into even slices, each
slice works alone, and a summary of one row per slice carries the state across.

The slice number must be the same however often a task runs, so the sliced rows are
written to the shared checkpoint folder before anything is computed from them.
"""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Sequence
from contextlib import suppress
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.operators.skew import key_counts, measure_hot, partitions

SLICE = "_slice"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session, as in tests, may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


_written: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the checkpoint folder and go on from there.

    For frames that several later steps read, and to end a growing plan. Being Parquet in
    shared storage, the table outlives its executors, and later steps read only their columns.
    ``release`` deletes the tables; it runs by itself when the driver's Python ends.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/ledgerloom-{uuid4().hex}"
    _written.append((spark, folder))
    df.write.parquet(folder)
    table = spark.read.schema(df.schema).parquet(folder)
    table._cut_folder = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once nothing that is still to run reads them."""
    for table in tables:
        entry = (table.sparkSession, table._cut_folder)
        if entry in _written:
            _written.remove(entry)
            _delete(*entry)


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession | None = None) -> int:
    """Delete the tables that ``cut`` wrote, of one session or of all that still run.

    Frames built on them cannot be read afterwards. Returns the number of tables.
    """
    gone = 0
    for session, folder in list(_written):
        if spark is not None and session is not spark:
            continue
        _written.remove((session, folder))
        if session.sparkContext._jsc is not None:  # a stopped session can delete nothing
            gone += bool(_delete(session, folder))
    return gone


@atexit.register
def _release_at_exit() -> None:
    with suppress(Exception):  # the JVM may be gone before Python is
        release()


def range_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Cut the order into even slices, numbered in order, and fix them by writing them."""
    ranged = df.repartitionByRange(partitions(df), *order)
    return cut(ranged.withColumn(SLICE, F.spark_partition_id()))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "group_id") -> DataFrame:
    """Number rows 1, 2, 3, ... in ``order``; the columns must order the rows fully."""
    sliced = range_slices(df, order)
    sizes = sliced.groupBy(SLICE).agg(F.count("*").alias("_rows"))  # one row per slice
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLICE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_skip"))
    inside = Window.partitionBy(SLICE).orderBy(*order)
    return (
        sliced.withColumn(name, F.row_number().over(inside))
        .join(F.broadcast(offsets), SLICE)
        .withColumn(name, (F.col(name) + F.col("_skip")).cast("long"))
        .drop(SLICE, "_skip")
    )


def with_previous(
    df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], prefix: str = "previous_"
) -> DataFrame:
    """Each row with ``values`` of the row before it under the same key (NULL for the first).

    Without a hot key this is a window. With one, the order is cut into slices: the last
    row of every (slice, key) is all that crosses a slice border, and a key spans a slice
    only as often as there are slices, so the summary per key is short.
    """
    if not measure_hot(key_counts(df, [key]), [key]):
        whole = Window.partitionBy(key).orderBy(*order)
        previous = [F.lag(name).over(whole).alias(f"{prefix}{name}") for name in values]
        return df.select("*", *previous)
    sliced = range_slices(df, [key, *order])
    inside = Window.partitionBy(SLICE, key).orderBy(*order)
    carried = F.struct(*values)
    local = sliced.withColumn("_before", F.lag(carried).over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    last = sliced.groupBy(SLICE, key).agg(F.max_by(carried, F.struct(*order)).alias("_last"))
    across = Window.partitionBy(key).orderBy(SLICE)
    border = last.select(SLICE, key, F.lag("_last").over(across).alias("_border"))
    joined = local.join(border, [SLICE, key], "left")
    before = F.when(F.col("_first"), F.col("_border")).otherwise(F.col("_before"))
    return joined.select(
        *df.columns, *[before[name].alias(f"{prefix}{name}") for name in values]
    )
