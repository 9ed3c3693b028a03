"""What two tables do not have in common, found from small sketches of both.

Each side is summed into an invertible Bloom lookup table: a record adds itself to one cell in
each of HASHES parts of the table, as a count, the sums of the words of its digest, and the sum
of a check of them. A scan gives a partial table per task and no record is moved. The second
side is taken off the first, so that whatever both sides have vanishes. A cell that holds
copies of a single record gives it away: its sums divide by its count and the check holds.
Taking such records out of their other cells frees further ones, until nothing is left.

The size of the table bounds what reaches the driver. If more records differ than it can tell
apart, the peeling stalls; a table of STEP times the size is tried, and beyond MOST cells the
records are counted on both sides, which is exact whatever their number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HASHES = 4
#: Cells of the first table, of the last one, and the factor between two.
CELLS, MOST, STEP = 1 << 12, 1 << 18, 8
#: A record's digest in words of 30 bits, so that sums and products stay exact.
WORDS, BITS = 4, 30
MASK = (1 << BITS) - 1


def _words(digest: Column) -> list[Column]:
    """The words of a record: 30 bits each of 8 digits of its sha256."""
    return [
        F.conv(F.substring(digest, 1 + 8 * w, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(MASK)) for w in range(WORDS)
    ]


def _digest(df: DataFrame) -> Column:
    """All columns of a record; NULL and blank stay apart."""
    fields = [F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("")) for c in df.columns]
    return F.sha2(F.concat_ws("\u001f", *fields), 256)


def _place(words, part: int, size: int):
    """The cell of a record in one part; the same on columns and on arrays of numbers."""
    mixed = words[part % WORDS] * (2 * part + 3) + words[(part + 1) % WORDS]
    return mixed % size


def _check(words):
    """A number that is no linear function of the words: sums of several records fail it."""
    return (words[0] * words[1]) % (MASK - 34) + (words[2] * words[3]) % (MASK - 40)


def sketch(df: DataFrame, cells: int) -> DataFrame:
    """cell, n, w0 ..., c of a table; one row per cell that has records."""
    size = cells // HASHES
    keyed = df.select(F.array(*_words(_digest(df))).alias("w"))
    words = [F.col("w")[i] for i in range(WORDS)]
    places = F.array(*[_place(words, part, size) + part * size for part in range(HASHES)])
    each = keyed.select("w", F.explode(places).alias("cell"))
    wide = "decimal(38,0)"
    return each.groupBy("cell").agg(
        F.count("*").alias("n"),
        *[F.sum(w.cast(wide)).alias(f"w{i}") for i, w in enumerate(words)],
        F.sum(_check(words).cast(wide)).alias("c"),
    )


def _difference(before: DataFrame, after: DataFrame, cells: int) -> dict[int, list[int]]:
    """The cells in which the sketches differ: at most ``cells`` of them."""
    names = ["n", *[f"w{i}" for i in range(WORDS)], "c"]
    sides = []
    for df, sign in ((before, 1), (after, -1)):
        told = sketch(df, cells)
        sides.append(told.select("cell", *[(F.col(n) * sign).cast("decimal(38,0)").alias(n) for n in names]))
    summed = sides[0].unionByName(sides[1]).groupBy("cell").agg(*[F.sum(n).alias(n) for n in names])
    some = reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names])
    return {r.cell: [int(r[n]) for n in names] for r in summed.where(some).collect()}


def peel(table: dict[int, list[int]], cells: int) -> dict[tuple[int, ...], int] | None:
    """Words of each record that differs -> copies before less copies after; None if it stalls."""
    size = cells // HASHES
    found: dict[tuple[int, ...], int] = {}
    todo = list(table)
    while todo:
        at = todo.pop()
        n, *sums = table.get(at, [0])
        if not n or any(s % n for s in sums):
            continue
        *words, check = (s // n for s in sums)
        if any(not 0 <= w <= MASK for w in words) or _check(words) != check:
            continue
        places = [_place(words, part, size) + part * size for part in range(HASHES)]
        if at not in places:
            continue
        record = tuple(words)
        found[record] = found.get(record, 0) + n
        if len(found) > cells:  # more than the table can tell apart
            return None
        for place in places:
            cell = table.setdefault(place, [0] * (WORDS + 2))
            for i, value in enumerate((1, *words, check)):
                cell[i] -= n * value
            if any(cell):
                todo.append(place)
            else:
                del table[place]
    return None if table else {record: n for record, n in found.items() if n}


def counted(before: DataFrame, after: DataFrame) -> DataFrame:
    """The columns of the tables, change, copies: by counting every record on both sides."""
    columns = before.columns
    tagged = before.withColumn("_d", F.lit(1)).unionByName(after.withColumn("_d", F.lit(-1)))
    balance = tagged.groupBy(*columns).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    return balance.select(
        *columns, F.when(F.col("_d") > 0, "lost").otherwise("added").alias("change"), F.abs("_d").alias("copies")
    )


def lost_and_added(before: DataFrame, after: DataFrame, cells: int = CELLS) -> DataFrame:
    """The columns of the tables, change (lost, added), copies: as EXCEPT ALL both ways.

    Columns that are NULL on both sides are equal. Both tables are scanned for their sketches
    and once more for the records that the sketches name; nothing else is shuffled.
    """
    if set(before.columns) != set(after.columns):
        raise ValueError("the tables have other columns")
    after = after.select(before.columns)
    while cells <= MOST:
        found = peel(_difference(before, after, cells), cells)
        if found is not None:
            return _named(before, after, found)
        cells *= STEP
    return counted(before, after)


def _named(before: DataFrame, after: DataFrame, found: dict[tuple[int, ...], int]) -> DataFrame:
    """The records of the digests that were found: at most as many as a table has cells."""
    spark = before.sparkSession
    listed = spark.createDataFrame(
        [(list(words), n) for words, n in found.items()], "_words array<bigint>, _d bigint"
    )
    parts = []
    for df, sign, change in ((before, 1, "lost"), (after, -1, "added")):
        wanted = listed.where(F.col("_d") * sign > 0)
        held = df.withColumn("_words", F.array(*_words(_digest(df)))).join(F.broadcast(wanted), "_words")
        # of the copies that a side has of a record, those that the other lacks
        one = held.groupBy(*df.columns, "_d").agg(F.lit(1)).select(*df.columns, F.abs("_d").alias("copies"))
        parts.append(one.select(*df.columns, F.lit(change).alias("change"), "copies"))
    return parts[0].unionByName(parts[1])
