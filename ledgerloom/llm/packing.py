"""Hierarchical multi-length packing of tokenized documents into training sequences.

Documents are routed to tiers of context sizes: a document fills whole windows first, its
tail is cut along the tiers (each a power of two, each half or less of the one above), and
what is left below the smallest tier is the short tier. Every tier is packed into windows
of the full length, and gaps are filled from the shorter tiers. As tier sizes divide each
other, tier pieces leave no gap among themselves whatever the lengths of the documents,
and the short pieces fill what is left.

The cuts depend on a document alone, so one pass tokenizes and sums up every piece. The
packing itself is worked out over the counts per length, which are at most one number per
tier and one per short length, however large the corpus is. Pieces then find their place
by their rank among pieces of one length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import byte_pairs, documents, parts
from ledgerloom.operators.skew import partitions
from ledgerloom.operators.slices import cut

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut_points(tokens: int, window: int, tiers: Sequence[int]) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``tokens`` ids."""
    pieces = [(at, window) for at in range(0, tokens - tokens % window, window)]
    at = len(pieces) * window
    for tier in tiers:
        while tokens - at >= tier:
            pieces.append((at, tier))
            at += tier
    return pieces + [(at, tokens - at)] * (at < tokens)


def document_pieces(
    df: DataFrame,
    window: int = 2048,
    tiers: Sequence[int] = (1024, 512, 256),
    end_id: int = 1,
    ranks_path: str | None = None,
) -> DataFrame:
    """One row per piece of every document, with the CRC-32 of its ids."""

    def pieces(batches: Iterator) -> Iterator:
        from zlib import crc32

        import pyarrow as pa

        pairs, end = byte_pairs(ranks_path), end_id.to_bytes(4, "little")
        for batch in parts(batches):
            rows = []
            for doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text")]):
                ids = memoryview(pairs.ids(text) + end)
                tokens = len(ids) // 4
                for start, length in cut_points(tokens, window, tiers):
                    crc = crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, tokens))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return documents(df).mapInArrow(pieces, PIECES)


def packing_plan(counts: dict[int, int], window: int) -> list[tuple[int, list[int]]]:
    """(copies, lengths) of window patterns that hold every piece counted.

    The longest length left opens a window; each gap takes the longest that fits. One
    pattern is used as often as its rarest length allows, after which fewer pieces of that
    length are left than the pattern holds. So there are a few patterns per length.
    """
    left = {length: n for length, n in counts.items() if n}
    order, plan = sorted(left), []
    while order:
        used: dict[int, int] = {}
        gap, end = window, len(order)
        while end:
            end = bisect_right(order, gap, 0, end)
            if not end:
                break
            length = order[end - 1]
            fits = min(gap // length, left[length])
            used[length] = fits
            gap -= fits * length
            end -= 1
        copies = min(left[length] // n for length, n in used.items())
        plan.append((copies, [length for length, n in used.items() for _ in range(n)]))
        for length, n in used.items():
            left[length] -= copies * n
            if not left[length]:
                del left[length]
                order.remove(length)
    return plan


def pack(
    df: DataFrame,
    window: int = 2048,
    tiers: Sequence[int] = (1024, 512, 256),
    step_size: int = 256,
    end_id: int = 1,
    ranks_path: str | None = None,
) -> DataFrame:
    """Pack all documents (doc_id, text) into sequences of at most ``window`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and tier (context size that the piece belongs to), sequence_tokens, step_id. Sequences
    are numbered by falling attention cost, the sum of squared piece lengths, and dealt to
    steps of ``step_size`` back and forth, so that steps cost about the same.

    Null and empty texts have one id, ``end_id``; a null doc_id stays null; repeated rows
    are packed each; an empty table gives no rows.
    """
    found = cut(document_pieces(df, window, tiers, end_id, ranks_path))
    spark, slices = found.sparkSession, partitions(found)
    # one row per length and slice: at most (window / 8 + tiers) x shuffle partitions
    dealt = found.withColumn(
        "_slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices))
    )
    sizes = dealt.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_slice").rowsBetween(-slices, -1)
    skips = sizes.select(
        "length", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip")
    )
    inside = Window.partitionBy("length", "_slice").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(skips, ["length", "_slice"])
        .withColumn("_rank", F.col("_rank") + F.col("_skip"))
    )

    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = sorted(packing_plan(counts, window), key=lambda p: -sum(x * x for x in p[1]))
    sequences = sum(copies for copies, _ in plan)
    steps = max(1, -(-sequences // step_size))
    places: dict[int, list] = {}
    used: dict[int, int] = {}
    first = 0
    for copies, lengths in plan:
        at = 0
        for length in dict.fromkeys(lengths):
            each = lengths.count(length)
            entry = (used.get(length, 0), each, first, at, sum(lengths))
            places.setdefault(length, []).append(entry)
            used[length] = used.get(length, 0) + each * copies
            at += each * length
        first += copies
    entry = "array<struct<base:bigint,each:bigint,first:bigint,at:bigint,total:bigint>>"
    table = spark.createDataFrame(list(places.items()), f"length bigint, _places {entry}")
    place = F.array_max(F.filter("_places", lambda p: p.base <= F.col("_rank")))
    lap, spot = F.floor(F.col("sequence_id") / steps), F.col("sequence_id") % steps
    tier = F.lit(min(tiers, default=window))
    for size in sorted({*tiers, window}):
        tier = F.when(F.col("length") >= size, F.lit(size)).otherwise(tier)
    return (
        ranked.join(F.broadcast(table), "length")
        .withColumn("_p", place)
        .withColumn("_q", F.col("_rank") - F.col("_p.base"))
        .withColumn("sequence_id", F.col("_p.first") + F.expr("_q div _p.each"))
        .withColumn("offset", F.col("_p.at") + F.expr("_q % _p.each") * F.col("length"))
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            "sequence_id",
            "offset",
            tier.cast("int").alias("tier"),
            F.col("_p.total").alias("sequence_tokens"),
            F.when(lap % 2 == 0, spot).otherwise(steps - 1 - spot).alias("step_id"),
        )
    )
