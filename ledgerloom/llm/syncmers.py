"""Document fingerprints from closed syncmers, built of SQL functions.

A k-mer of K words is chosen if the least of the hashes of its inner runs of S words lies
at one of its ends. Whether it is chosen depends on its own words alone, so a passage has
the same anchors wherever it stands. A fingerprint is the SKETCH least anchor hashes, which
estimate how much two documents share.

A text of fewer than K words is taken by its characters. If no k-mer is chosen, the hashes
of the words or characters are the anchors; an empty text has none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import documents
from ledgerloom.operators.skew import partitions

#: Words of a k-mer and of its inner runs. The comparison below is for K - S = 3.
K, S = 5, 2
SKETCH = 64
SPACE = r"[ \t\n\r\f]+"
LEAST_ID = -(1 << 63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _from(values: Column, start: int) -> Column:
    return F.slice(values, start, F.size(values))


def _units(text: Column) -> Column:
    """Hashes of the words between white space, or of the characters if there are few words."""

    def of(words: Column) -> Column:
        return F.when(F.size(words) >= K, words).otherwise(hashes(F.split(text, "")))

    def hashes(parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: F.length(p) > 0), lambda p: F.xxhash64(p))

    return _let(hashes(F.split(text, SPACE)), of)


def _chosen(units: Column) -> Column:
    """For each position a hash of the k-mer there if it is a closed syncmer, else null."""
    runs = F.slice(
        F.zip_with(units, _from(units, 2), lambda a, b: F.xxhash64(a, b)),
        1,
        F.greatest(F.size(units) - 1, F.lit(0)),
    )

    def edges(first: Column, last: Column) -> Column:
        low = F.when(last.isNotNull(), F.least(first, last))
        return F.struct(low.alias("low"), F.xxhash64(first, last).alias("id"))

    def choose(runs: Column) -> Column:
        inner = F.zip_with(_from(runs, 2), _from(runs, 3), lambda a, b: F.least(a, b))
        # the ends and the least of the middle take in all words of the k-mer
        return F.zip_with(
            F.zip_with(runs, _from(runs, 1 + K - S), edges),
            inner,
            lambda edge, low: F.when(edge["low"] <= low, F.xxhash64(edge["id"], low)),
        )

    return _let(runs, choose)


def anchors(text: Column) -> Column:
    """Array of (position, hash): closed syncmers of a text, positions counted in words
    (characters in a text of few words)."""
    placed = F.transform(
        _let(_units(F.coalesce(text, F.lit(""))), _chosen),
        lambda h, i: F.struct(i.cast("bigint").alias("position"), h.alias("hash")),
    )
    return F.filter(placed, lambda a: a["hash"].isNotNull())


def sketch(text: Column) -> Column:
    """The SKETCH least anchors of a text as 31-bit numbers, rising."""

    def of(units: Column) -> Column:
        return _let(
            F.array_compact(_chosen(units)), lambda c: F.when(F.size(c) > 0, c).otherwise(units)
        )

    hashes = _let(_units(F.coalesce(text, F.lit(""))), of)
    short = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 33).cast("int"))
    return F.slice(F.sort_array(F.array_distinct(short)), 1, SKETCH)


def likeness(a: Column, b: Column) -> Column:
    """Share of the least anchors of both that either has; 1 for two without anchors."""

    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union)).cast("double")

    return _let(F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH), share)


def written(numbers: Column) -> Column:
    """A sketch as text: eight hex digits for each number."""
    return F.array_join(F.transform(numbers, lambda n: F.lower(F.lpad(F.hex(n), 8, "0"))), "")


def with_next(df: DataFrame, carried: list[str]) -> DataFrame:
    """Add next_<column> of the document next in descending doc_id; the last has the first's.

    The order is cut into slices at quantiles of the ids, and every slice is handed the
    first documents of the slice after it, so no task orders more than a slice. Null ids
    come last; of one id, texts in order. doc_id is meant as a key: rows that repeat one
    id all lie in one slice.
    """
    spark = df.sparkSession
    df = df.withColumn("_key", F.coalesce("doc_id", F.lit(LEAST_ID)))
    slices = 4 * partitions(df)
    levels = [i / slices for i in range(1, slices)]
    found = df.agg(F.percentile_approx("_key", levels, 100 * slices).alias("b")).first().b
    bounds = sorted(set(found or []))
    width = 1 << len(bounds).bit_length()
    table = F.lit(bounds + [(1 << 63) - 1] * (width - len(bounds))).cast("array<bigint>")
    steps = [width >> i for i in range(1, width.bit_length())]
    key = F.col("_key")
    # binary search for the number of bounds below the key
    place = F.aggregate(
        F.lit(steps).cast("array<int>") if steps else F.array().cast("array<int>"),
        F.lit(0),
        lambda at, step: F.when(
            F.element_at(table, at + step) < key, at + step
        ).otherwise(at),
    )
    df = df.withColumn("_slice", place)
    heads = sorted(df.groupBy("_slice").agg(F.max("_key").alias("k")).collect(), reverse=True)
    # one row per slice: its first id goes to the slice before it, the very first to the last
    before = [(row.k, heads[i - 1]._slice) for i, row in enumerate(heads)]
    targets = spark.createDataFrame(before, "_key bigint, _target int")
    guests = (
        df.join(F.broadcast(targets), "_key")
        .withColumn("_slice", F.col("_target"))
        .drop("_target")
        .withColumn("_guest", F.lit(1))
    )
    order = Window.partitionBy("_slice").orderBy("_guest", F.desc("_key"), "text")
    nexts = [F.lead(c).over(order).alias(f"next_{c}") for c in carried]
    both = df.withColumn("_guest", F.lit(0)).unionByName(guests)
    return both.select("*", *nexts).where("_guest = 0").drop("_guest", "_slice", "_key")


def fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints of all documents (doc_id, text) and of an edit of each.

    The edit replaces the last third of the code points by as many first ones, or all, of
    the next document in descending doc_id. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. Null texts are empty; an
    empty text has an empty fingerprint. A lone document is its own next. Repeated rows are
    kept; an empty table gives no rows.
    """
    own = documents(df).withColumn("sketch", sketch(F.col("text")))
    placed = with_next(own, ["text", "sketch"])
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), size - third), F.col("next_text").substr(F.lit(1), third)
    )
    told = placed.select(
        "doc_id", "sketch", "next_sketch", size.cast("bigint").alias("n_chars"), edited.alias("edited")
    ).withColumn("edited_sketch", sketch(F.col("edited")))
    return told.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
