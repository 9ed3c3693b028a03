"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles, in bands.

A text is the bag of its runs of five words. A run weighs its count times its inverse
document frequency. Improved consistent weighted sampling draws, for each of BANDS x ROWS
hash functions, one run of a text; two texts draw alike with the probability of their
weighted Jaccard similarity. Texts that agree in all rows of a band share a bucket.

No bucket gives out all its pairs. Each bucket has a pivot, the member that shares buckets
with most others: among edited copies that is what they were copied from. Every member is
compared to it with its whole text; links make classes. Where a bucket then still holds
several classes, members of its largest class become pivots in turn, one a round, which the
members of other classes are compared to; that costs a row per member, and goes on while it
links. Members that are still apart then meet in blocks, all but those of the largest class
with each other and with that class: their whole texts are compared by the runs that they
share, and a spanning forest of the links comes out of a block, not its pairs. Pairs of one
class need no comparison, and no pair of a bucket is left out but for draws far apart.

Document frequencies of all runs are counted. Texts are dealt to chunks by a hash; every
chunk asks for each of its distinct runs once, packed into one row per range of run hashes.
The rows of a range meet, are summed, and each chunk is answered with the sums. So a run
that all documents share is one number per chunk, no run makes rows of its own, and nothing
but sizes reaches the driver. A run of one document weighs as one of two.

The copies of a text would make its runs common and thereby their own edits weigh most, so
that the larger a group is, the fewer of its copies were alike. A group of more than FEW
therefore counts as about one document: where more than a third of a text's runs are in some
number of documents, the text counts as one part of that number. For a copy that is about the
size of its group; a text with a passage that many others have still counts as one, so such a
passage keeps its low weight. Runs of more than FEW documents are asked for once more, with
the sums of these shares.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import documents, linked_classes
from ledgerloom.llm.url_filter import blocked_bloom, may_contain
from ledgerloom.operators.skew import lookup_join, partitions
from ledgerloom.operators.slices import cut, discard

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 18, 4
#: Bytes of text, and for every document as many as DOC_BYTES, of a chunk.
CHUNK_BYTES, DOC_BYTES = 1 << 22, 1000
#: Chunks per shuffle partition at least. A chunk asks each range of run hashes in one row, and
#: there are as many ranges as partitions.
CHUNKS = 2
#: Documents up to which runs keep their document frequency, and copies count one by one.
FEW = 16
#: Runs of more than FEW documents are so much fewer, and get as many times fewer ranges.
COMMON = 8
#: What a text of its own counts in sums of shares.
WHOLE = 1 << 16
#: Bytes of text that are worked on at once.
BLOCK = 1 << 18
#: Bits of a run's hash; the other bits of a word number the texts of a block.
RUN_BITS = 52
#: Share of equal draws below which a pair is not worth reading; at a similarity of 0.8 the
#: share of 72 draws lies below it once in a hundred million times.
LEAST_DRAWS = 0.5
#: A round of further pivots must link one of so many members for another to follow.
FRUITFUL = 8
#: Members of a bucket in a block, of which two meet at once.
MET = 256
BLOOM_BLOCKS = 1 << 16

PRIME = 0x100000001B3
ASKED = "chunk bigint, place bigint, runs binary, counts binary"


def _mix(x):
    """The finalizer of splitmix64: every bit of the input reaches every bit of the output."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int):
    """PRIME and its inverse to the powers 0 .. size - 1, modulo 2^64."""
    import numpy as np

    found = []
    for base in (PRIME, pow(PRIME, -1, 1 << 64)):
        powers = np.full(size, base, "u8")
        powers[0] = 1
        found.append(np.cumprod(powers, dtype="u8"))
    return found


@lru_cache(maxsize=1)
def _bytes_table():
    """Bytes in lower case, and which of them are white space."""
    import numpy as np

    lower = np.arange(256, dtype="u1")
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return lower, space


def _shingle_block(texts: Sequence[str]):
    import numpy as np

    lower, space = _bytes_table()
    sizes = [len(t.encode()) for t in texts]
    raw = np.frombuffer((" ".join(texts) + " ").encode(), "u1")
    blank = space[raw]
    edge = np.flatnonzero(np.diff(blank.astype("i1"), prepend=1, append=1))
    starts, ends = edge[0::2], edge[1::2]
    size = 1 << max(20, len(raw).bit_length())
    powers, inverse = _powers(size)
    sums = np.zeros(len(raw) + 1, "u8")
    np.cumsum((lower[raw].astype("u8") + np.uint64(1)) * powers[: len(raw)], out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * inverse[starts])
    begins = np.cumsum([0] + [n + 1 for n in sizes])
    doc = np.searchsorted(begins, starts, "right") - 1
    # a text of fewer than WORDS words is one run
    count = len(words)
    runs = np.zeros(count, "u8")
    whole = np.ones(count, bool)
    for k in range(WORDS):
        same = np.zeros(count, bool)
        same[: max(count - k, 0)] = doc[k:] == doc[: max(count - k, 0)]
        part = np.zeros(count, "u8")
        part[same] = words[k:][same[: max(count - k, 0)]] if k else words[same]
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + part
        whole &= same
    per_doc = np.bincount(doc, minlength=len(texts))
    first = np.ones(count, bool)
    first[1:] = doc[1:] != doc[:-1]
    kept = whole | (first & (per_doc[doc] < WORDS))
    return doc[kept], _mix(runs[kept])


def _blocks(*columns) -> Iterator[tuple[int, int]]:
    """(first row, end) of parts of Arrow columns of text with about BLOCK bytes, or one row."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = sum(pc.binary_length(c).to_numpy(zero_copy_only=False) for c in columns)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(ends.searchsorted(before + BLOCK, "right")))
        end = min(end, at + (1 << (64 - RUN_BITS)))
        yield at, end
        at = end


def _distinct(texts: Sequence[str]) -> tuple:
    """(text of each run, run, count): distinct runs, sorted by text, then by hash."""
    import numpy as np

    doc, runs = _shingle_block(texts)
    keys = (doc.astype("u8") << np.uint64(RUN_BITS)) | (runs >> np.uint64(64 - RUN_BITS))
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    places = np.flatnonzero(new)
    keys = keys[places]
    doc, runs = keys >> np.uint64(RUN_BITS), keys & np.uint64((1 << RUN_BITS) - 1)
    return doc.astype("i8"), runs, np.diff(places, append=len(new))


def shingles(column) -> Iterator[tuple]:
    """For parts of an Arrow column of texts: number of texts, and their distinct runs."""
    for at, end in _blocks(column):
        yield end - at, *_distinct(column.slice(at, end - at).to_pylist())


class Weights:
    """Inverse document frequencies: by counts that come with the runs (u4 each, 0 for one
    document), else of ``runs`` their own, of all others the greatest."""

    def __init__(self, documents: int, runs, counts) -> None:
        import numpy as np

        order = np.argsort(runs)
        self.documents, self.runs = documents, runs[order]
        self.idf = self._idf(counts[order])
        self.most = float(self._idf(np.zeros(1))[0])

    def _idf(self, counts):
        import numpy as np

        return 1 + np.log((self.documents + 1) / (np.maximum(counts, 2.0) + 1))

    def of(self, runs, counts, found=None):
        import numpy as np

        if found is not None:
            return counts * self._idf(np.frombuffer(found, "<u4"))
        idf = np.full(len(runs), self.most)
        if len(self.runs):
            at = np.minimum(self.runs.searchsorted(runs), len(self.runs) - 1)
            known = self.runs[at] == runs
            idf[known] = self.idf[at[known]]
        return counts * idf


def _found(column, at: int, end: int) -> bytes | None:
    """Counts of the runs of some texts, one after the other; None where there are none."""
    parts = column.slice(at, end - at).to_pylist()
    return None if None in parts else b"".join(parts)


def _pack(runs) -> bytes:
    """Rising 64-bit numbers as the planes of the bytes of their differences, which compress."""
    import numpy as np

    return np.diff(runs, prepend=runs.dtype.type(0)).astype("<u8").view("u1").reshape(-1, 8).T.tobytes()


def _unpack(packed: bytes):
    import numpy as np

    planes = np.frombuffer(packed, "u1").reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u8").ravel(), dtype="u8")


def _summed(rows: list[tuple[bytes, bytes]], unit: int = 1) -> tuple:
    """Of rows of (packed runs, counts): distinct runs, their sums in units, and where each
    row's are."""
    import numpy as np

    runs = [_unpack(packed) for packed, _ in rows]
    counts = np.concatenate([np.frombuffer(c, "<u4") for _, c in rows])
    distinct, places = np.unique(np.concatenate(runs), return_inverse=True)
    sums = np.rint(np.bincount(places, counts) / unit).astype("<u4")
    return distinct, sums, np.split(places, np.cumsum([len(r) for r in runs])[:-1])


def _chunked(df: DataFrame) -> tuple[DataFrame, int, int]:
    """(chunk, doc_id, node, text), number of documents, number of ranges of run hashes."""
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + DOC_BYTES * F.count("*")
    total, work = df.agg(F.count("*"), size).first()
    chunks = max(CHUNKS * partitions(df), work // CHUNK_BYTES)
    node = text_key(F.col("text"))
    chunk = F.pmod(F.xxhash64("doc_id", "node"), F.lit(chunks)).alias("chunk")
    keyed = df.select("doc_id", node.alias("node"), "text").select(chunk, "doc_id", "node", "text")
    return keyed, total, partitions(df)


def _asked(keyed: DataFrame, ranges: int) -> DataFrame:
    """chunk, place (of a range), runs (packed), counts: distinct runs of every chunk, with
    the number of its documents that hold each."""

    def ask(key, table):
        import numpy as np

        seen = [runs for b in table.to_batches() for _, _, runs, _ in shingles(b.column("text"))]
        runs, counts = np.unique(np.concatenate([np.zeros(0, "u8"), *seen]), return_counts=True)
        return _ranged(key[0].as_py(), runs, counts, ranges)

    return keyed.groupBy("chunk").applyInArrow(ask, ASKED)


def _ranged(chunk: int, runs, counts, ranges: int):
    """Rising runs of a chunk and their counts, as a row for each range of run hashes."""
    import numpy as np
    import pyarrow as pa

    width = -(-(1 << RUN_BITS) // ranges)
    counts = counts.astype("<u4")
    borders = runs.searchsorted(np.arange(ranges + 1, dtype="u8") * np.uint64(width))
    held = np.flatnonzero(np.diff(borders))
    spans = [slice(borders[place], borders[place + 1]) for place in held]
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(held), pa.int64()),
            "place": pa.array(held, pa.int64()),
            "runs": pa.array([_pack(runs[span]) for span in spans], pa.binary()),
            "counts": pa.array([counts[span].tobytes() for span in spans], pa.binary()),
        }
    )


def _answered(asked: DataFrame, unit: int = 1) -> DataFrame:
    """chunk, place, found: in how many documents of all each run that was asked for is, 0
    standing for one."""

    def answer(table):
        import numpy as np
        import pyarrow as pa

        rows = list(zip(*[table.column(c).to_pylist() for c in ("runs", "counts")]))
        _, sums, places = _summed(rows, unit)
        sums[sums == 1] = 0
        found = pa.array([sums[at].astype("<u4").tobytes() for at in places], pa.binary())
        return table.select(["chunk", "place"]).append_column("found", found)

    return asked.groupBy("place").applyInArrow(answer, "chunk bigint, place bigint, found binary")


def _told(table, answers) -> tuple:
    """Of a chunk: distinct runs of each block of its texts, all its runs, what was found of each."""
    import numpy as np

    blocks, texts = [], table.column("text")
    for at, end in _blocks(texts):
        blocks.append((end - at, *_distinct(texts.slice(at, end - at).to_pylist())))
    known = np.unique(np.concatenate([np.zeros(0, "u8"), *[runs for _, _, runs, _ in blocks]]))
    told = _in_order(answers)
    if len(known) != len(told):
        raise ValueError("the texts of a chunk changed while their runs were counted")
    return blocks, known, told


def _in_order(answers):
    """What was found, in the order of the chunk's runs."""
    import numpy as np

    return np.frombuffer(b"".join(answers.sort_by("place").column("found").to_pylist()), "<u4")


def _copies(doc, held, count: int):
    """Of each of ``count`` texts the greatest number of documents that more than a third of its
    runs are in, by what is held for each run; 1 if that is FEW or less."""
    import numpy as np

    found = np.ones(count, "i8")
    sizes = np.bincount(doc, minlength=count)
    large = 3 * np.bincount(doc, held > FEW, count) > sizes
    some = large[doc]
    keys = (doc[some].astype("u8") << np.uint64(32)) | held[some]
    keys.sort()
    sizes = sizes[large]
    found[large] = keys[np.cumsum(sizes) - 1 - sizes // 3] & np.uint64(0xFFFFFFFF)
    return found


def _asked_again(keyed: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """As ``_asked``, of runs of more than FEW documents; of WHOLE, each document counts its part
    among its copies."""

    def ask(key, table, answers):
        import numpy as np

        blocks, known, told = _told(table, answers)
        sums = np.zeros(len(known))
        for count, doc, runs, _ in blocks:
            at = known.searchsorted(runs)
            held = told[at]
            shares = np.rint(WHOLE / _copies(doc, held, count))
            np.add.at(sums, at[held > FEW], shares[doc[held > FEW]])
        often = told > FEW
        return _ranged(key[0].as_py(), known[often], sums[often], ranges)

    return keyed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(ask, ASKED)


@lru_cache(maxsize=1)
def _gamma():
    """65,536 quantiles of the Gamma(2, 1) distribution, and their logarithms."""
    import numpy as np

    share = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(1 << 16), np.full(1 << 16, 64.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < share
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return low, np.log(low)


def draws(doc, runs, weights, count: int, functions: range = range(BANDS * ROWS)):
    """Matrix (text, hash function) of what each of ``count`` texts draws; 0 without runs."""
    import numpy as np

    table, logs = _gamma()
    found = np.zeros((count, len(functions)), "u8")
    if not len(runs):
        return found
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    own, sizes = doc[starts], np.diff(starts, append=len(doc))
    log_weight = np.log(weights)
    # all numbers of a function go through these, which saves half of the time
    bits, part = np.empty(len(runs), "u8"), np.empty(len(runs), "u8")
    r, log_a, beta, t = (np.empty(len(runs)) for _ in range(4))
    low, first, second = np.uint64(0xFFFF), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
    for column, k in enumerate(functions):
        # as _mix
        np.bitwise_xor(runs, np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)), out=bits)
        for shift, factor in ((30, first), (27, second), (31, None)):
            np.right_shift(bits, np.uint64(shift), out=part)
            np.bitwise_xor(bits, part, out=bits)
            if factor is not None:
                np.multiply(bits, factor, out=bits)
        np.bitwise_and(bits, low, out=part)
        np.take(table, part.view("i8"), out=r, mode="clip")
        np.right_shift(bits, np.uint64(16), out=part)
        np.bitwise_and(part, low, out=part)
        np.take(logs, part.view("i8"), out=log_a, mode="clip")
        np.right_shift(bits, np.uint64(32), out=part)
        np.multiply(part, 2.0**-32, out=beta)
        # t = floor(log w / r + beta), log a = log c - r * (t - beta + 1)
        np.divide(log_weight, r, out=t)
        np.floor(np.add(t, beta, out=t), out=t)
        np.subtract(t, beta, out=beta)
        np.add(beta, 1, out=beta)
        np.subtract(log_a, np.multiply(beta, r, out=beta), out=log_a)
        least = np.minimum.reduceat(log_a, starts)
        hit = np.flatnonzero(log_a == np.repeat(least, sizes))
        own_first = hit[np.flatnonzero(np.diff(doc[hit], prepend=-1))]
        drawn = t[own_first].astype("i8").view("u8") * np.uint64(PRIME)
        found[own, column] = _mix(runs[own_first] + drawn)
    return found


def text_key(text: Column) -> Column:
    """16 bytes of a digest of a text, by which equal texts are one."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def signatures(df: DataFrame, grouped: bool = False) -> tuple[DataFrame, Weights]:
    """doc_id, node (the text's key), bands (hash of each), draws (four bytes of each), found
    (documents that hold each distinct run, 0 for one; if ``grouped``, those of a large group
    of copies as about one); and the weights, for runs that come with these."""
    import numpy as np

    keyed, total, ranges = _chunked(df)
    weights = Weights(total, np.zeros(0, "u8"), np.zeros(0))

    def run(table, answers):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        again = answers.column("again")
        blocks, known, told = _told(table, answers.filter(pc.invert(again)))
        if grouped:
            told = told.copy()
            told[told > FEW] = _in_order(answers.filter(again))
        drawn, found = [np.zeros((0, BANDS * ROWS), "u8")], []
        for count, doc, runs, counts in blocks:
            held = told[known.searchsorted(runs)]
            drawn.append(draws(doc, runs, weights.of(runs, counts, held), count))
            ends = np.cumsum(np.bincount(doc, minlength=count))
            found += [part.tobytes() for part in np.split(held, ends[:-1])]
        drawn = np.concatenate(drawn)
        bands = np.empty((len(drawn), BANDS), "u8")
        for b in range(BANDS):
            rows = drawn[:, b * ROWS : (b + 1) * ROWS]
            key = np.full(len(drawn), b + 1, "u8")
            for row in range(ROWS):
                key = _mix(key * np.uint64(PRIME) + rows[:, row])
            bands[:, b] = key
        short = np.ascontiguousarray((drawn >> np.uint64(32)).astype("<u4"))
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(drawn) + 1, dtype="i4") * BANDS),
            pa.array(bands.view("i8").ravel()),
        )
        # a text without runs has no bands
        empty = ~drawn.any(1)
        if empty.any():
            lists = pa.array(
                [None if e else x for e, x in zip(empty, lists.to_pylist())], pa.list_(pa.int64())
            )
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "node": table.column("node"),
                "bands": lists,
                "draws": pa.array([row.tobytes() for row in short], pa.binary()),
                "found": pa.array(found, pa.binary()),
            }
        )

    answers = _answered(_asked(keyed, ranges))
    if grouped:
        # read twice, counted once
        answers = answers.repartition("chunk")
    told = answers.withColumn("again", F.lit(False))
    if grouped:
        shared = _answered(_asked_again(keyed, answers, -(-ranges // COMMON)), WHOLE)
        told = told.unionByName(shared.withColumn("again", F.lit(True)))
    signed = keyed.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        run, "doc_id bigint, node binary, bands array<bigint>, draws binary, found binary"
    )
    return signed, weights


def similarities(
    texts_a: Sequence[str], texts_b: Sequence[str], weights: Weights, found_a=None, found_b=None
):
    """Weighted Jaccard similarity of each pair of texts; 1 for two without runs."""
    import numpy as np

    sides = []
    for texts, found in ((texts_a, found_a), (texts_b, found_b)):
        doc, runs, counts = _distinct(texts)
        sides.append((doc, runs, weights.of(runs, counts, found)))
    keys = [(doc.astype("u8") << np.uint64(RUN_BITS)) | runs for doc, runs, _ in sides]
    (doc, _, weight), (doc_b, _, weight_b) = sides
    count = len(texts_a)
    at = np.minimum(keys[0].searchsorted(keys[1]), max(len(keys[0]) - 1, 0))
    both = np.flatnonzero(keys[0][at] == keys[1]) if len(keys[0]) else at[:0]
    least = np.minimum(weight[at[both]], weight_b[both])
    common = np.bincount(doc_b[both], least, count)
    total = np.bincount(doc, weight, count) + np.bincount(doc_b, weight_b, count) - common
    return np.where(total > 0, common / np.where(total > 0, total, 1), 1.0)


def _texts(ids: DataFrame, nodes: DataFrame, df: DataFrame) -> DataFrame:
    """id, text, found of the wanted nodes."""
    found = F.col("found") if "found" in nodes.columns else F.lit(None).cast("binary")
    wanted = cut(nodes.select("id", "node", found.alias("found")).join(ids.select("id").distinct(), "id", "left_semi"))
    bloom = cut(blocked_bloom(wanted.select(F.hex("node").alias("key")), BLOOM_BLOCKS))
    near = df.select("text", text_key(F.col("text")).alias("node")).withColumn("key", F.hex("node"))
    # the filter keeps texts that nobody asks for from being moved, the first aggregation copies
    near = may_contain(near, bloom, BLOOM_BLOCKS).groupBy("node").agg(F.first("text").alias("text"))
    texts = cut(near.join(wanted, "node").select("id", "text", "found"))
    discard(wanted, bloom)
    return texts


def _linked(pairs: DataFrame, nodes: DataFrame, df: DataFrame, weights: Weights) -> DataFrame:
    """The pairs (a, b) of ids whose whole texts are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = _texts(ids, nodes, df)
    links = _compared(pairs, texts, weights)
    discard(texts)
    return links


def _compared(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """The pairs (a, b) whose texts (id, text, found) are similar enough."""

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sides = [batch.column(c) for c in ("text_a", "text_b")]
            for at, end in _blocks(*sides):
                texts = [side.slice(at, end - at).to_pylist() for side in sides]
                found = [_found(batch.column(c), at, end) for c in ("found_a", "found_b")]
                alike = pa.array(similarities(*texts, weights, *found) >= SIMILARITY)
                yield batch.select(["a", "b"]).slice(at, end - at).filter(alike)

    a, b = (
        texts.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("text", "found")])
        for c in ("a", "b")
    )
    read = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b", "found_a", "found_b")
    return cut(read.mapInArrow(compare, "a bigint, b bigint"))


def _classes(df: DataFrame) -> DataFrame:
    """doc_id, node (the text's key), class (a text's key) of every row of documents."""
    signed, weights = signatures(df, grouped=True)
    signed = cut(signed)
    nodes = signed.where("bands IS NOT NULL").groupBy("node")
    nodes = nodes.agg(*[F.first(c).alias(c) for c in ("bands", "draws", "found")])
    # short names for what is moved most; writing the table fixes them
    nodes = cut(nodes.withColumn("id", F.monotonically_increasing_id()))
    members = nodes.select("id", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    sized = cut(members.join(sizes, "bucket"))
    shared = sized.groupBy("id").agg(F.sum("n").alias("shared"))
    order = F.struct("shared", F.xxhash64("id").alias("order"), "id")
    pivots = sized.join(shared, "id").groupBy("bucket").agg(F.max(order).alias("best"))
    placed = cut(sized.join(pivots.select("bucket", F.col("best.id").alias("pivot")), "bucket"))
    discard(sized)

    pairs = placed.where("id <> pivot").select(
        F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")
    )
    drawn = nodes.select(F.col("id").alias("a"), F.col("draws").alias("draws_a"))
    drawn_b = drawn.select(F.col("a").alias("b"), F.col("draws_a").alias("draws_b"))
    pairs = pairs.distinct().join(drawn, "a").join(drawn_b, "b")
    links = _linked(cut(pairs.where(_draws_alike()).select("a", "b")), nodes, df, weights)
    classes = linked_classes(links)

    rest = _rest_links(placed.where("n > 2"), classes, nodes, df, weights)
    if rest is not None:
        classes = linked_classes(links.unionByName(rest))

    discard(placed)
    # the class of a text goes by the key of its least member; texts without links are their own
    keys = nodes.select("id", "node")
    heads = keys.select(F.col("id").alias("class"), F.col("node").alias("head"))
    known = keys.withColumnRenamed("id", "member").join(
        classes.select(F.col("node").alias("member"), "class"), "member"
    )
    named_by = known.join(heads, "class").select("node", "head")
    own = lookup_join(signed.select("doc_id", "node"), named_by, "node", "left")
    return cut(own.select("doc_id", "node", F.coalesce("head", "node").alias("class")))


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size of every row of (doc_id, text).

    Documents whose texts are equal, or linked by chains of similarities of SIMILARITY or
    more within buckets, have one class; class_id is its least doc_id, null if it has
    none. Null texts are empty; texts without words are alike only if equal. Repeated rows
    count each. A text of fewer than five words is one run. An empty table gives no rows.
    """
    own = _classes(documents(df)).select("doc_id", "class")
    named = own.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    )
    return lookup_join(own, named, "class", distinct=True).select("doc_id", "class_id", "class_size")


def one_per_class(df: DataFrame) -> DataFrame:
    """Of the rows of ``df`` one per near-duplicate class, that of its least doc_id.

    Rows that repeat a doc_id with other texts are documents of their own: of each class the
    row with the least doc_id stays, of these the one with the least key of its text, of rows
    alike in both the one with the least hash of all columns. A class without any doc_id keeps
    a row too.
    """
    own = _classes(documents(df))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "node")).alias("first")
    heads = own.groupBy("class").agg(first).select("first.doc_id", "first.node")
    heads = heads.select(F.col("doc_id").alias("_head"), F.col("node").alias("_node"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = df.withColumn("_node", text_key(text)).withColumn("_head", F.col("doc_id").cast("bigint"))
    same = F.col("k._node").eqNullSafe(F.col("h._node")) & F.col("k._head").eqNullSafe(F.col("h._head"))
    kept = keyed.alias("k").join(heads.alias("h"), same, "left_semi")
    order = Window.partitionBy("_node", "_head").orderBy(F.xxhash64(*df.columns))
    kept = kept.withColumn("_place", F.row_number().over(order)).where("_place = 1")
    return kept.select(df.columns)


def _draws_alike() -> Column:
    """Whether enough of draws_a and draws_b, four bytes each, are equal."""
    equal = [
        F.substring("draws_a", at, 4) == F.substring("draws_b", at, 4)
        for at in range(1, 4 * BANDS * ROWS, 4)
    ]
    return sum((e.cast("int") for e in equal), F.lit(0)) >= LEAST_DRAWS * BANDS * ROWS


def _rest_links(
    placed: DataFrame, classes: DataFrame, nodes: DataFrame, df: DataFrame, weights: Weights
) -> DataFrame | None:
    """Links (a, b) between members of one bucket and different classes, enough to join the
    classes that any links join."""
    classes = classes.withColumnRenamed("node", "id")
    kept = placed.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    kept = cut(kept.where("id <> pivot").select("bucket", "id", "class"))
    members = cut(_mixed(kept))
    discard(kept)
    if members.isEmpty():
        return None
    texts = _texts(members, nodes, df)
    found = []
    while True:
        sizes = members.groupBy("bucket", "class").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("largest"))
        marked = members.join(largest.select("bucket", F.col("largest.class").alias("largest")), "bucket")
        marked = cut(marked)
        pivots = marked.where("class = largest").groupBy("bucket").agg(
            F.min(F.struct(F.xxhash64("id", F.lit(len(found))).alias("order"), "id")).alias("pivot")
        )
        pivots = pivots.select("bucket", F.col("pivot.id").alias("pivot"))
        strays = marked.where("class <> largest").join(pivots, "bucket")
        pairs = cut(strays.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct())
        new = _compared(pairs, texts, weights)
        found.append(new)
        compared, linked = pairs.count(), new.count()
        # a pivot has met all that is not of its class
        left = marked.drop("largest").join(pivots.withColumnRenamed("pivot", "id"), ["bucket", "id"], "left_anti")
        before, members = members, cut(_mixed(_renamed(left, marked, new)))
        discard(before, marked, pairs)
        if linked * FRUITFUL < compared or members.isEmpty():
            break
    found.append(_met(members, texts, weights))
    discard(members, texts)
    rest = found[0]
    for part in found[1:]:
        rest = rest.unionByName(part)
    return rest


def _mixed(members: DataFrame) -> DataFrame:
    """The members (bucket, id, class) of buckets with more than one class."""
    spans = members.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return members.join(spans.where("low <> high").select("bucket"), "bucket", "left_semi")


def _renamed(left: DataFrame, members: DataFrame, links: DataFrame) -> DataFrame:
    """The members that are left, with the classes that the links among all of them leave."""
    known = members.select("id", "class").distinct()
    a, b = (known.select(F.col("id").alias(c), F.col("class").alias(f"class_{c}")) for c in ("a", "b"))
    edges = links.join(a, "a").join(b, "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    joined = linked_classes(edges).toDF("class", "joined")
    renamed = left.join(joined, "class", "left")
    return renamed.select("bucket", "id", F.coalesce("joined", "class").alias("class"))


def _met(members: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """Links (a, b) among the members (bucket, id, class) of different classes, as a forest of
    each two blocks. Blocks of the largest class of a bucket meet those of others only."""
    sizes = members.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("l"), F.sum("n").alias("all"))
    largest = largest.select(
        "bucket",
        F.col("l.class").alias("largest"),
        F.ceil((F.col("all") - F.col("l.n")) / MET).cast("int").alias("strays"),
        F.ceil(F.col("l.n") / MET).cast("int").alias("same"),
    )
    own = F.col("class") == F.col("largest")
    block = F.pmod(F.xxhash64("id"), F.when(own, F.col("same")).otherwise(F.col("strays"))).cast("int")
    # strays take the numbers from 0 on, the largest class those after them
    dealt = members.join(largest, "bucket").withColumn("block", F.when(own, block + F.col("strays")).otherwise(block))
    alone = F.sequence(F.lit(0), F.col("strays") - 1)
    both = F.sequence(F.lit(0), F.col("strays") + F.col("same") - 1)
    dealt = dealt.withColumn("other", F.explode(F.when(own, alone).otherwise(both)))
    meeting = dealt.select(
        "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "id", "class"
    )

    def meet(table):
        import numpy as np
        import pyarrow as pa

        ids = np.array(table.column("id").to_pylist(), "i8")
        groups = np.unique(table.column("class").to_pylist(), return_inverse=True)[1]
        doc, runs, weight, at = [], [], [], 0
        for first, end in _blocks(table.column("text").combine_chunks()):
            part = table.slice(first, end - first)
            d, r, c = _distinct(part.column("text").to_pylist())
            doc.append(d + at)
            runs.append(r)
            weight.append(weights.of(r, c, _found(part.column("found").combine_chunks(), 0, end - first)))
            at += end - first
        doc, runs, weight = (np.concatenate(x) for x in (doc, runs, weight))
        total = np.bincount(doc, weight, len(ids))
        order = np.argsort(runs, kind="stable")
        doc, runs, weight = doc[order], runs[order], weight[order]
        starts = np.flatnonzero(np.diff(runs, prepend=runs[:1] + np.uint64(1)))
        common = np.zeros((len(ids), len(ids)))
        for start, stop in zip(starts, np.append(starts[1:], len(runs))):
            if stop - start > 1:
                d, w = doc[start:stop], weight[start:stop]
                common[np.ix_(d, d)] += np.minimum(w[:, None], w)
        union = total[:, None] + total - common
        alike = common >= SIMILARITY * union
        alike &= groups[:, None] != groups
        one, two = np.nonzero(np.triu(alike, 1))
        kept, parent = [], list(range(groups.max() + 1))

        def root(g):
            while parent[g] != g:
                parent[g] = g = parent[parent[g]]
            return g

        for a, b in zip(one.tolist(), two.tolist()):
            x, y = root(groups[a]), root(groups[b])
            if x != y:
                parent[x] = y
                kept.append((a, b))
        a, b = (ids[[p[k] for p in kept]] if kept else ids[:0] for k in (0, 1))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    read = meeting.join(texts, "id").select("bucket", "one", "two", "id", "class", "text", "found")
    return cut(read.groupBy("bucket", "one", "two").applyInArrow(meet, "a bigint, b bigint"))
