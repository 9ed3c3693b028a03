"""Joins that hold when one key owns a third of all rows.

A key is *hot* when it has more rows than an average shuffle partition. With P shuffle
partitions and N rows there are fewer than P such keys, because each owns more than N / P
rows. That bound does not grow with the data: it is what makes the list of hot keys safe
to fetch, and the hot part of a unique lookup safe to broadcast.

Hot keys are measured before a join is planned, by a count over 8-byte key hashes. Most
joins have none and stay plain joins, for which Catalyst and AQE pick the strategy.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Observation, functions as F

#: A key is hot from this many average partitions on.
HOT_SHARE = 1.0
#: Groups of key hashes that are counted before keys are.
BUCKETS = 1 << 16


def partitions(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def key_counts(rows: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key. Partial aggregation counts a hot key inside the map tasks."""
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def measure_hot(counts: DataFrame, keys: Sequence[str], n: str = "n") -> dict[int, int]:
    """Hash of each hot key -> the number of partitions that its rows would fill.

    One job, which fetches at most P rows: the P greatest counts and, as a metric of the
    same pass, the total. Hotness only decides which way a row takes, so a stale count or
    two keys with one hash cost time but never change a result.
    """
    parts = partitions(counts)
    seen = Observation()
    top = (
        counts.select(F.xxhash64(*keys).alias("h"), F.col(n).alias("n"))
        .observe(seen, F.sum("n").alias("total"))
        .orderBy(F.desc("n"))
        .limit(parts)
        .collect()
    )
    if not top:
        return {}
    total = seen.get["total"]
    return {row.h: ceil(row.n * parts / total) for row in top if row.n * parts > HOT_SHARE * total}


def hot_of_rows(rows: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """What ``measure_hot`` finds in the rows per key, without a count of every key.

    Rows are counted per bucket of key hashes first, which moves at most ``BUCKETS`` rows per
    task. A hot key makes its bucket hot, so keys are counted in hot buckets only.
    """
    parts = partitions(rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    seen = Observation()
    top = (
        rows.groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
        .observe(seen, F.sum("n").alias("total"))
        .orderBy(F.desc("n"))
        .limit(parts)
        .collect()
    )
    least = HOT_SHARE * seen.get["total"] if top else 0
    full = [row.bucket for row in top if row.n * parts > least]
    if not full:
        return {}
    counted = key_counts(rows.where(bucket.isin(full)), keys, "n")
    found = counted.select(F.xxhash64(*keys).alias("h"), "n").orderBy(F.desc("n")).limit(parts).collect()
    total = seen.get["total"]
    return {row.h: ceil(row.n * parts / total) for row in found if row.n * parts > least}


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the least by the other columns, so that lookups are unique."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    counts: DataFrame | None = None,
    distinct: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to a ``lookup`` that is unique on ``on``, without hot partitions.

    ``counts`` are rows per key (``on`` and ``n``) when the caller knows them; counts from
    before a filter or a lookup do as well, as they can only be too high. ``measured`` are the
    rows from which ``rows`` were worked out, for when these cost more to count: a key that is
    no hot one of theirs has at most an average partition of them. NULL keys match
    nothing, but they are counted and kept apart like any other key.

    ``distinct=False`` suits raw tables, where a third of the rows may be copies of one:
    rows of hot keys never move, they meet the broadcast of the hot keys' lookup rows.
    The table is read once for each of the two halves.

    ``distinct=True`` suits derived rows without copies: rows of a hot key are dealt over
    as many slices as the key would fill partitions, by their hash, and the lookup rows are
    repeated once per slice. ``rows`` is worked out once, which matters for long plans. This
    way takes a lookup with several rows per key as well.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join does not do {how}")
    for key in on:
        kinds = rows.schema[key].dataType, lookup.schema[key].dataType
        if kinds[0] != kinds[1]:  # hashes of the two sides must agree
            raise TypeError(f"{key} is {kinds[0]} in the rows and {kinds[1]} in the lookup")
    if counts is None:
        hot = hot_of_rows((rows if measured is None else measured).select(*on), on)
    else:
        hot = measure_hot(counts, on)
    if not hot:
        return rows.join(lookup, on, how)
    spark = rows.sparkSession
    listed = spark.createDataFrame(list(hot.items()), "_hot_key bigint, _hot_slices int")
    join = _dealt_join if distinct else _halved_join
    return join(rows, lookup, on, how, F.broadcast(listed))


def _mark(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_hot_slices``, NULL for keys that are not hot."""
    keyed = df.withColumn("_hot_key", F.xxhash64(*on))
    return keyed.join(hot, "_hot_key", "left").drop("_hot_key")


def _halved_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], how: str, hot: DataFrame
) -> DataFrame:
    """Hot keys stay in place, the others are shuffled."""
    is_hot = F.col("_hot_slices").isNotNull()
    marked = _mark(rows, on, hot)
    few = F.broadcast(_mark(lookup, on, hot).where(is_hot).drop("_hot_slices"))
    near = marked.where(is_hot).drop("_hot_slices").join(few, on, how)
    far = marked.where(~is_hot).drop("_hot_slices").join(lookup, on, how)
    return near.unionByName(far)


def _dealt_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], how: str, hot: DataFrame
) -> DataFrame:
    """Hot keys are dealt over slices, the others have one."""
    slices = F.coalesce(F.col("_hot_slices"), F.lit(1))
    dealt = (
        _mark(rows, on, hot)
        .withColumn("_hot_slice", F.pmod(F.xxhash64(*rows.columns), slices).cast("int"))
        .drop("_hot_slices")
    )
    repeated = (
        _mark(lookup, on, hot)
        .withColumn("_hot_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_hot_slices")
    )
    return dealt.join(repeated, [*on, "_hot_slice"], how).drop("_hot_slice")


def lookup_flag(
    rows: DataFrame,
    ids: DataFrame,
    key: str,
    flag: str,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add a boolean: does ``key`` occur in the one-column frame ``ids``?"""
    known = ids.select(F.col(ids.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    marked = lookup_join(rows, known.withColumn(flag, F.lit(True)), key, "left", counts)
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def beside(left: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Put one-row frames beside ``left``; each is a single scalar subquery."""
    names = [f"_beside{i}" for i in range(len(one_row))]
    packed = [
        df.select(F.struct(*df.columns).alias(name)).scalar().alias(name)
        for name, df in zip(names, one_row)
    ]
    return left.select("*", *packed).select(*left.columns, *[f"{name}.*" for name in names])
