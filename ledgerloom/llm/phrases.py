"""Phrase collocations: exact counts of word n-grams in counting quotient filters.

1. Texts are read in blocks. A block becomes, per language, its distinct words with counts
   and a stream of numbers of these words, with 0 between pieces.
2. Words with enough occurrences get numbers that hold for all blocks; no phrase with a
   rarer word can have enough. Each block is told the numbers of its own words only.
3. Each block packs its n-grams of numbered words into 3 * b bits, where b bits hold a word's
   number. A Feistel network permutes the packed n-grams invertibly, which deals them evenly,
   and splits them into a quotient and the full remainder. A filter keeps them sorted by
   quotient, with steps in place of quotients, remainders, and counters. As the permutation
   can be undone and the remainder is whole, a filter counts without loss.
4. Filters of a task are merged, cut by range of quotients into shards, and those of a shard
   are merged by one task, which undoes the permutation for n-grams with enough occurrences.

A common phrase is one entry of a filter however often it occurs, and the permutation deals
all entries evenly, so no shard is hot. Whatever the size of the data there are SHARDS
shards per shuffle partition.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.operators.skew import partitions
from ledgerloom.operators.slices import cut, discard, number_rows

# The batch functions travel to the executors whole, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_COUNT = 10
MOST_WORDS = 3
TOP = 2000
#: A candidate goes if a longer one that holds it has at least this share, in percent.
ABSORBED = 50
SCALE = 1_000_000

#: Bytes of text in a block.
BLOCK = 1 << 22
#: Rows of an Arrow batch that are held as Python objects at once.
PART_ROWS = 256
#: Entries of a task's filter before it is put out.
ENTRIES = 1 << 21
#: Shards per shuffle partition.
SHARDS = 2

BREAK = b"\xff"  # in no UTF-8 text


# --- blocks --------------------------------------------------------------------------------------


def _planes(numbers) -> bytes:
    """Unsigned 64-bit numbers as the planes of their low bytes that are not all 0, after the
    number of planes; planes compress well."""
    import numpy as np

    width = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    planes = numbers.astype("<u8").view("u1").reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def _unplaned(packed: bytes, count: int):
    import numpy as np

    width = packed[0]
    found = np.zeros((count, 8), "u1")
    found[:, :width] = np.frombuffer(packed, "u1", offset=1).reshape(width, count).T
    return found.view("<u8").ravel()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _encode_block(texts: list[str]) -> tuple[list[str], list[int], bytes, int]:
    """Distinct words, their counts, packed stream (0 a break), its length."""
    import numpy as np

    table = bytearray(range(256))
    for mark in b".,;:!?\x0a\x0b\x0c\x0d":
        table[mark] = BREAK[0]
    whole = b"\n".join(t.encode() for t in texts).lower().translate(bytes(table))
    numbers = _Numbers({BREAK: 0})
    # what is left of white space is space and tab
    tokens = whole.replace(BREAK, b" \xff ").split()
    stream = np.fromiter(map(numbers.__getitem__, tokens), "u8", len(tokens))
    counts = np.bincount(stream.astype("i8"), minlength=len(numbers))
    words = [w.decode() for w in numbers if w != BREAK]
    return words, counts[1:].tolist(), _planes(stream), len(stream)


def _blocks(batches: Iterator) -> Iterator:
    """block, lang, words, counts, stream, length of (lang, text)."""
    import pyarrow as pa
    from pyspark import TaskContext

    held, size, made = {}, 0, 0
    first = TaskContext.get().partitionId() << 32

    def told():
        rows = [(lang, *_encode_block(texts)) for lang, texts in held.items()]
        langs, words, counts, streams, lengths = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([first + made] * len(rows), pa.int64()),
                pa.array(langs, pa.string()),
                pa.array(words, pa.list_(pa.string())),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array(streams, pa.binary()),
                pa.array(lengths, pa.int64()),
            ],
            ["block", "lang", "words", "counts", "stream", "length"],
        )

    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            part = batch.slice(at, PART_ROWS)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BLOCK:
                    yield told()
                    held, size, made = {}, 0, made + 1
    if held:
        yield told()


# --- filters -------------------------------------------------------------------------------------


def _mix(x):
    """The finalizer of splitmix64."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def half_bits(bits: int) -> int:
    """Bits of a quotient, and of a remainder, for words of ``bits`` bits."""
    return -(-MOST_WORDS * bits // 2)


def pack(one, two, three, bits: int) -> tuple:
    """Three numbers below 2^bits, bits at most 32, as two halves of 1.5 * bits bits."""
    import numpy as np

    half = half_bits(bits)
    low, high = np.uint64(half - bits), np.uint64(2 * bits - half)
    mask = np.uint64((1 << half) - 1)
    return (one << high) | (two >> low), ((two << np.uint64(bits)) | three) & mask


def unpack(left, right, bits: int) -> tuple:
    import numpy as np

    half = half_bits(bits)
    low, high = np.uint64(half - bits), np.uint64(2 * bits - half)
    two = ((left & np.uint64((1 << (2 * bits - half)) - 1)) << low) | (right >> np.uint64(bits))
    return left >> high, two, right & np.uint64((1 << bits) - 1)


def permute(left, right, half: int) -> tuple:
    """Four rounds of a Feistel network: (quotient, remainder) of packed n-grams."""
    import numpy as np

    mask = np.uint64((1 << half) - 1)
    for k in (1, 2):
        left = left ^ (_mix(right + np.uint64(k)) & mask)
        right = right ^ (_mix(left + np.uint64(k + 8)) & mask)
    return left, right


def restore(left, right, half: int) -> tuple:
    """The packed n-grams that ``permute`` was given."""
    import numpy as np

    mask = np.uint64((1 << half) - 1)
    for k in (2, 1):
        right = right ^ (_mix(left + np.uint64(k + 8)) & mask)
        left = left ^ (_mix(right + np.uint64(k)) & mask)
    return left, right


def merged(left, right, counts, half: int) -> tuple:
    """Entries in the order of (quotient, remainder), equal ones summed; counts None: ones."""
    import numpy as np

    if 2 * half <= 64 and counts is None:
        keys = np.sort((left << np.uint64(half)) | right)
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        places = np.flatnonzero(new)
        keys = keys[places]
        sums = np.diff(places, append=len(new)).astype("u8")
        return keys >> np.uint64(half), keys & np.uint64((1 << half) - 1), sums
    if 2 * half <= 64:
        # each part is sorted already, which a stable sort makes use of
        order = np.argsort((left << np.uint64(half)) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right = left[order], right[order]
    counts = np.ones(len(left), "u8") if counts is None else counts[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    places = np.flatnonzero(new)
    sums = np.add.reduceat(counts, places) if len(places) else counts
    return left[places], right[places], sums


class Filter:
    """Counters of packed n-grams, merged when as many are waiting as it holds."""

    def __init__(self, half: int) -> None:
        import numpy as np

        self.half, self.waiting, self.pending = half, [], 0
        self.held = tuple(np.zeros(0, "u8") for _ in range(3))

    def add(self, left, right, counts) -> None:
        self.waiting.append((left, right, counts))
        self.pending += len(left)
        if self.pending > max(len(self.held[0]), ENTRIES // 4):
            self.fold()

    def fold(self) -> tuple:
        import numpy as np

        if self.waiting:
            columns = [np.concatenate(c) for c in zip(self.held, *self.waiting)]
            self.waiting, self.pending = [], 0
            self.held = merged(*columns, self.half)
        return self.held

    def __len__(self) -> int:
        return len(self.held[0]) + self.pending


def _numbered(words: list[int], numbers: list[int], stream: bytes, length: int, bits: int) -> tuple:
    """Packed bigrams and trigrams of numbered words; 0 stands for no third word."""
    import numpy as np

    local = _unplaned(stream, length).astype("i8")
    known = np.zeros(int(local.max(initial=0)) + 1, "u8")
    known[np.array(words, "i8")] = np.array(numbers, "u8")
    ids = known[local]
    two = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    three = two[:-1][np.diff(two) == 1]
    one = np.concatenate([two, three])
    third = np.zeros(len(one), "u8")
    third[len(two) :] = ids[three + 2]
    return pack(ids[one], ids[one + 1], third, bits)


def _filters(batches: Iterator, bits: int, shard_bits: int) -> Iterator:
    """shard, entries, steps, remainders, counts of (words, numbers, stream, length)."""
    import numpy as np
    import pyarrow as pa

    half = half_bits(bits)
    found = Filter(half)

    def told():
        left, right, counts = found.fold()
        shard = (left >> np.uint64(half - shard_bits)).astype("i8")
        borders = np.searchsorted(shard, np.arange((1 << shard_bits) + 1))
        held = np.flatnonzero(np.diff(borders))
        spans = [slice(borders[s], borders[s + 1]) for s in held]
        steps = [_planes(np.diff(left[x], prepend=np.uint64(0))) for x in spans]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(held, pa.int64()),
                pa.array([x.stop - x.start for x in spans], pa.int64()),
                pa.array(steps, pa.binary()),
                pa.array([_planes(right[x]) for x in spans], pa.binary()),
                pa.array([_planes(counts[x]) for x in spans], pa.binary()),
            ],
            ["shard", "entries", "steps", "remainders", "counts"],
        )

    for batch in batches:
        for row in range(batch.num_rows):
            block = (batch.column(c)[row].as_py() for c in ("words", "numbers", "stream", "length"))
            packed = permute(*_numbered(*block, bits), half)
            found.add(*merged(*packed, None, half))
            if len(found) >= ENTRIES and len(found.fold()[0]) >= ENTRIES // 2:
                yield told()
                found = Filter(half)
    yield told()


def _merge(batches: Iterator, bits: int) -> Iterator:
    """w1, w2, w3, a of n-grams with enough occurrences; rows come in the order of shards."""
    import numpy as np
    import pyarrow as pa

    half = half_bits(bits)
    shard, found = None, Filter(half)

    def told():
        left, right, counts = found.fold()
        often = counts >= LEAST_COUNT
        words = unpack(*restore(left[often], right[often], half), bits)
        arrays = [pa.array(x.astype("i8")) for x in (*words, counts[often])]
        return pa.RecordBatch.from_arrays(arrays, ["w1", "w2", "w3", "a"])

    for batch in batches:
        for row in range(batch.num_rows):
            here = batch.column("shard")[row].as_py()
            if here != shard and len(found):
                yield told()
                found = Filter(half)
            shard = here
            count = batch.column("entries")[row].as_py()
            steps, right, counts = (
                _unplaned(batch.column(c)[row].as_py(), count) for c in ("steps", "remainders", "counts")
            )
            found.add(np.cumsum(steps, dtype="u8"), right, counts)
    yield told()


# --- phrases -------------------------------------------------------------------------------------


def counted(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """lang, n; id, lang, word, f of frequent words; w1, w2, w3 (0: none), a of frequent phrases."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    blocks = cut(
        df.select(lang, text).mapInArrow(
            _blocks,
            "block bigint, lang string, words array<string>, counts array<bigint>, stream binary, length bigint",
        )
    )
    # arrays of a block side by side: place, word, count
    told = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    told = told.select("block", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("f"))
    sizes = told.groupBy("lang").agg(F.sum("f").alias("n"))
    words = told.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= LEAST_COUNT)
    words = cut(number_rows(words, ["lang", "word"], "id"))
    bits = max(1, words.count().bit_length())
    if bits > 32:
        raise ValueError("more than 2^32 frequent words do not fit packed n-grams")
    shard_bits = min(half_bits(bits), (SHARDS * partitions(df) - 1).bit_length())

    own = told.select("block", "lang", "place", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    known = own.groupBy("block", "lang").agg(
        F.collect_list(F.struct((F.col("place") + 1).alias("place"), "id")).alias("known")
    )
    numbered = blocks.select("block", "lang", "stream", "length").join(known, ["block", "lang"])
    filters = numbered.select(
        F.col("known.place").alias("words"), F.col("known.id").alias("numbers"), "stream", "length"
    ).mapInArrow(
        partial(_filters, bits=bits, shard_bits=shard_bits),
        "shard bigint, entries bigint, steps binary, remainders binary, counts binary",
    )
    phrases = (
        filters.repartition(partitions(df), "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(partial(_merge, bits=bits), "w1 bigint, w2 bigint, w3 bigint, a bigint")
    )
    found = cut(sizes), words, cut(phrases)
    discard(blocks)
    return found


def _score(a: str, left: str, right: str):
    """floor(SCALE * a * a / (left * right)), exact in 38 digits."""
    a, left, right = (f"CAST({x} AS DECIMAL(18, 0))" for x in (a, left, right))
    return F.expr(f"({a} * {a} * {SCALE}) DIV ({left} * {right})")


def collocations(df: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: per language the TOP phrases by lowest-scoring cut.

    Texts of (lang, text) are cut into pieces at punctuation and line ends and these into words
    at spaces and tabs. Null texts are empty, a null lang is ``und``; empty texts, texts without
    words and empty tables give no rows. Repeated rows count each. Very long texts are a block
    of their own. Ties of score and count go by the phrase. Further columns are left aside.
    """
    sizes, words, phrases = counted(df)
    count = {n: words.select(F.col("id").alias(f"w{n}"), F.col("f").alias(f"f{n}")) for n in (1, 2, 3)}
    name = {n: words.select(F.col("id").alias(f"w{n}"), F.col("word").alias(f"word{n}")) for n in (2, 3)}
    name[1] = words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("word1"))
    pairs = phrases.where("w3 = 0").select("w1", "w2", "a")
    triples = phrases.where("w3 > 0")

    inside = triples.select("w1", "w2", "a").unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    longest = inside.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    pairs_left = pairs.join(longest, ["w1", "w2"], "left").where(
        F.expr(f"longer IS NULL OR 100 * longer < {ABSORBED} * a")
    )
    two = pairs_left.join(count[1], "w1").join(count[2], "w2")
    two = two.select(
        "w1", "w2", F.lit(0).cast("bigint").alias("w3"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        _score("a", "f1", "f2").alias("score"),
    )

    begin = pairs.withColumnRenamed("a", "f12")
    end = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = triples.join(begin, ["w1", "w2"]).join(end, ["w2", "w3"]).join(count[1], "w1").join(count[3], "w3")
    # of two equal scores the shorter first part
    cuts = F.least(
        F.struct(_score("a", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")),
        F.struct(_score("a", "f12", "f3").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")),
    )
    three = three.withColumn("cut", cuts).select("w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")

    scored = cut(two.unionByName(three))
    # AQE splits the partitions of words that begin or end very many phrases
    named = scored.join(name[1], "w1").join(name[2], "w2").join(name[3], "w3", "left")
    named = named.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= TOP)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
