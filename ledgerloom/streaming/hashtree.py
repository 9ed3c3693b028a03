"""A hash tree over a feed, by which two states of it are compared without reading them whole.

The feed is cut into ranges (leaves). A range's digest is the sum of the digests of its
records, in parts that do not overflow, so it does not hang on their order, counts copies,
and comes out of partial aggregates. Sums of ranges add up: a parent is the sum of its
children, the root stands for the whole feed, and the tree of a growing feed is kept by adding
the ranges of each batch.

Two trees are compared from the root down: of each level only the children of nodes that
differ are looked at. In the end records of the ranges that differ are read, and no others:
records lie in one folder per range, and the folders of other ranges are pruned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.relate import ID
from ledgerloom.operators.skew import partitions

#: Children of a node.
FANOUT = 16
#: Ranges of a snapshot, one folder each.
RANGES = 4096

PARTS = 6
SUMS = [f"s{i}" for i in range(PARTS)]


def record_digest(columns: Sequence[Column]) -> Column:
    """sha256 of all fields of a record; NULL and blank stay apart."""
    fields = [F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns]
    return F.sha2(F.concat_ws("\u001f", *fields), 256)


def digest_sums(digest: Column) -> list[Column]:
    """Sums of the 64 digits of digests, twelve at a time, under the names of SUMS.

    Summed as halves of 24 bits, which fit whole numbers of 64 bits for 2^39 records.
    """
    found = []
    for name, start in zip(SUMS, range(1, 64, 12)):
        part = F.conv(F.substring(digest, start, 12), 16, 10).cast("bigint")
        high = F.sum(F.shiftright(part, 24)).cast("decimal(20,0)")
        low = F.sum(part.bitwiseAND(F.lit((1 << 24) - 1))).cast("decimal(20,0)")
        found.append((high * F.lit(1 << 24).cast("decimal(10,0)") + low).cast("decimal(38,0)").alias(name))
    return found


def leaves(records: DataFrame, leaf: Column, digest: Column) -> DataFrame:
    """leaf, n, s0 ... s5: one row per range that has records."""
    return records.groupBy(leaf.cast("bigint").alias("leaf")).agg(F.count("*").alias("n"), *digest_sums(digest))


def added(parts: DataFrame) -> DataFrame:
    """Leaves of several batches as one row per range."""
    return parts.groupBy("leaf").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in SUMS])


def root_sha256(ranges: DataFrame) -> DataFrame:
    """One row: records, and the hash of their digests; that of no records is a hash too."""
    sums = [F.coalesce(F.sum(s), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string") for s in SUMS]
    n = F.coalesce(F.sum("n"), F.lit(0))
    return ranges.agg(n.alias("records"), F.sha2(F.concat_ws(":", n.cast("string"), *sums), 256).alias("sha256"))


def level(ranges: DataFrame, height: int) -> DataFrame:
    """node, n, s0 ... s5: the nodes ``height`` levels above the ranges."""
    node = F.floor(F.col("leaf") / F.lit(FANOUT**height)).cast("bigint").alias("node")
    return ranges.groupBy(node).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in SUMS])


def differing(before: DataFrame, after: DataFrame, ranges: int) -> DataFrame:
    """leaf: the ranges, of ``ranges`` numbered from 0, in which two trees differ.

    From the root down; a level is joined only below nodes that differ in the level above.
    """
    height = 0
    while FANOUT**height < ranges:
        height += 1
    same = F.col("b.n").eqNullSafe(F.col("a.n"))
    for s in SUMS:
        same &= F.col(f"b.{s}").eqNullSafe(F.col(f"a.{s}"))
    open_ = None
    for up in range(height, -1, -1):
        sides = []
        for tree in (before, after):
            nodes = level(tree, up)
            if open_ is not None:
                parent = F.floor(F.col("node") / F.lit(FANOUT)).cast("bigint")
                nodes = nodes.withColumn("parent", parent).join(open_, "parent", "left_semi").drop("parent")
            sides.append(nodes)
        met = sides[0].alias("b").join(sides[1].alias("a"), F.col("b.node") == F.col("a.node"), "full")
        open_ = met.where(~same).select(F.coalesce("b.node", "a.node").alias("parent"))
    return open_.select(F.col("parent").alias("leaf"))


# --- snapshots -----------------------------------------------------------------------------------


def id_range(ranges: int = RANGES) -> Column:
    """The range of a record by a hash of its id; records without one share the first range."""
    first = F.substring(F.sha2(F.col(ID).cast("string"), 256), 1, 8)
    number = F.conv(first, 16, 10).cast("bigint")
    return F.coalesce(F.floor(number * F.lit(ranges) / F.lit(1 << 32)), F.lit(0)).cast("bigint")


def write_snapshot(
    feed: DataFrame, folder: str, columns: Sequence[Column], ranges: int = RANGES, mode: str = "errorifexists"
) -> None:
    """Ids and fingerprints of a feed in one folder per range, and beside them its tree."""
    records = feed.select(ID, record_digest(columns).alias("fingerprint"), id_range(ranges).alias("leaf"))
    # a range goes to few files; AQE splits ranges of very many records
    dealt = records.repartition(partitions(feed), "leaf")
    dealt.write.mode(mode).partitionBy("leaf").parquet(f"{folder}/records")
    kept = feed.sparkSession.read.parquet(f"{folder}/records")
    leaves(kept, F.col("leaf"), F.col("fingerprint")).write.mode(mode).parquet(f"{folder}/tree")


def snapshot_changes(spark: SparkSession, before: str, after: str, ranges: int = RANGES) -> DataFrame:
    """entity_id, change (added, removed, changed), ranges_read of two snapshots, of as many
    ranges each, as ``publish.changed_records`` gives them from the whole feeds."""
    from ledgerloom.streaming.publish import changed_records

    trees = [spark.read.parquet(f"{folder}/tree") for folder in (before, after)]
    moved = differing(*trees, ranges)
    sides = [
        # of the partition column: folders of ranges that do not differ are not opened
        spark.read.parquet(f"{folder}/records").join(F.broadcast(moved), "leaf", "left_semi")
        for folder in (before, after)
    ]
    counted = moved.agg(F.count("*").alias("ranges_read"))
    changes = changed_records(*[side.select(ID, "fingerprint") for side in sides])
    return changes.withColumn("ranges_read", counted.scalar())
