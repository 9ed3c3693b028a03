"""Values and records per key as flat rows, and counts of small domains as text.

A row per key that holds all ids of the key breaks when one key owns a third of the ids.
Members are therefore one row each; whoever needs a text per key collects a key's rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import as_text


def member_values(pairs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct non-null values of each key, as text: ``keys, value``."""
    known = pairs.where(F.col(value).isNotNull())
    return known.select(*keys, as_text(F.col(value)).alias("value")).distinct()


def member_records(
    rows: DataFrame,
    keys: Sequence[str],
    entity: str,
    columns: Sequence[str],
    null_label: str = "NULL",
) -> DataFrame:
    """Distinct records of each key, as text, with the number of their copies."""
    texts = [F.coalesce(as_text(F.col(c)), F.lit(null_label)).alias(c) for c in columns]
    records = rows.select(*keys, as_text(F.col(entity)).alias(entity), *texts)
    return records.groupBy(*keys, entity, *columns).agg(F.count("*").alias("copies"))


def value_counts(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each value, NULL too, occurs per key: ``keys, value, n``, one row each."""
    return rows.groupBy(*keys, F.col(value).alias("value")).agg(F.count("*").alias("n"))


def value_counts_text(
    rows: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    null_label: str | None = "<NULL>",
    sep: str = "; ",
    n_rows: str | None = None,
    sizes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per key, each attribute's distribution as ``v=n; v=n``, by value.

    Rows are counted per combination of values before anything is collected, so a list is as
    long as the combinations that occur under a key, never as the group. ``null_label=None``
    leaves NULLs out. ``n_rows`` and ``sizes`` name columns for the rows of a key and for the
    number of an attribute's values, which need no pass of their own.
    """
    texts = [as_text(F.col(a)) for a in attributes]
    if null_label is not None:
        texts = [F.coalesce(t, F.lit(null_label)) for t in texts]
    names = [f"_v{i}" for i in range(len(attributes))]
    counted = rows.groupBy(*keys, *[t.alias(v) for t, v in zip(texts, names)]).agg(F.count("*").alias("_n"))
    held = counted.groupBy(*keys).agg(F.collect_list(F.struct(*names, "_n")).alias("_held"), F.sum("_n").alias("_rows"))

    def values(name: str) -> Column:
        return F.array_sort(F.array_distinct(F.array_compact(F.col(f"_held.{name}"))))

    def text(name: str) -> Column:
        def entry(v: Column) -> Column:
            same = F.filter("_held", lambda h: h[name] == v)
            return F.concat(v, F.lit("="), as_text(F.aggregate(same, F.lit(0).cast("bigint"), lambda n, h: n + h["_n"])))

        return F.array_join(F.transform(values(name), entry), sep)

    place = dict(zip(attributes, names))
    return held.select(
        *keys,
        *[text(place[a]).alias(f"{a}_counts") for a in attributes],
        *([F.col("_rows").alias(n_rows)] if n_rows else []),
        *[F.size(values(place[a])).cast("bigint").alias(name) for a, name in (sizes or {}).items()],
    )
