"""Spelling variants: words one edit apart, found through words over a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word. If two words differ
by one edit, their reduced words are equal or differ by one edit too. The one-edit
neighbourhood of every distinct reduced word is generated as 64-bit hashes and joined to the
reduced vocabulary; words that share or neighbour a reduced word are then compared letter
by letter. Hashes only propose: equal hashes of unlike words cost a comparison, no result.

An insertion into one word is a deletion from the other, and a replacement goes both ways.
So each pair of reduced words is generated once, by its longer member, or of two of one
length by the one with the greater hash.

A word's form is its near word of the largest count, if that is at least twice its own;
following forms doubles the count at each step, so chains are short and pointer doubling
ends after a few rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import pick
from ledgerloom.operators.slices import cut, discard

# The batch functions travel to the executors whole, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words that count have so many code points and occurrences.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One occurrence in so many, by a hash of document and word, loses a letter.
SLIP = 97
#: A form has at least so many times the occurrences of its variant.
FORM_RATIO = 2
#: Entries, and characters read, of a worker's counter before it is put out.
ENTRIES, READ = 200_000, 1 << 25
#: Rows of an Arrow batch that are held as Python objects at once.
PART_ROWS = 512
#: Hashes generated at once.
GENERATED = 1 << 20
#: Words per possible reduced word of seven letters, which decides the number of symbols.
EXPONENT = 1 / 7

PRIME = 0x100000001B3
INVERSE = pow(PRIME, -1, 1 << 64)
GOLDEN = 0x9E3779B97F4A7C15


# --- words ---------------------------------------------------------------------------------------


def slipped(doc_id: int | None, word: str) -> str:
    """The word as this document has it: now and then with one letter left out."""
    from zlib import crc32

    h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    at = h % len(word)
    return word if h % SLIP else word[:at] + word[at + 1 :]


def _count_words(batches: Iterator) -> Iterator:
    """(word, n) of every batch of (doc_id, text), summed over many documents."""
    import re
    from collections import Counter

    import pyarrow as pa

    run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
    total, read = Counter(), 0

    def told():
        return pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for first in range(0, batch.num_rows, PART_ROWS):
            part = batch.slice(first, PART_ROWS)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                # bytes are lower-cased from A to Z only; a run is as long as it gets
                found = Counter(run.findall(text.encode().lower().decode()))
                for word, n in found.items():
                    word = slipped(doc_id, word)
                    if len(word) >= LEAST_LENGTH:
                        total[word] += n
                read += len(text)
                if len(total) >= ENTRIES or read >= READ:
                    yield told()
                    total, read = Counter(), 0
    yield told()


def vocabulary(df: DataFrame) -> DataFrame:
    """word, n of all words of (doc_id, text) with enough letters and occurrences.

    A null text has no words; a null doc_id is written as nothing in the hash. Repeated rows
    count each. Words are counted inside the tasks first, so a word that a third of all
    rows is made of is a few rows per task.
    """
    texts = pick(df, ("doc_id", "bigint"), ("text", "string")).where("text IS NOT NULL")
    counted = texts.mapInArrow(_count_words, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- reduced words -------------------------------------------------------------------------------


def _mix(x):
    """The finalizer of splitmix64."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, size: int):
    import numpy as np

    powers = np.full(size, base, "u8")
    powers[0] = 1
    return np.cumprod(powers, dtype="u8")


class Reduced:
    """Words as arrays: one symbol (from 1 on) per letter, all words one after the other."""

    def __init__(self, symbols, sizes) -> None:
        import numpy as np

        self.symbols, self.sizes = symbols.astype("u8"), sizes
        ends = np.cumsum(sizes)
        self.starts = ends - sizes
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.powers = _powers(PRIME, int(sizes.max(initial=0)) + 1)
        self.weight = self.powers[np.arange(len(symbols)) - self.starts[self.owner]]
        sums = np.zeros(len(symbols) + 1, "u8")
        np.cumsum(self.symbols * self.weight, out=sums[1:])
        self.total = sums[ends] - sums[self.starts]
        self.before = sums[:-1] - sums[self.starts][self.owner]
        self.keys = self.key(self.total, sizes)

    def key(self, total, sizes):
        import numpy as np

        return _mix(total + sizes.astype("u8") * np.uint64(GOLDEN))

    def neighbours(self, alphabet: int) -> Iterator[tuple]:
        """(word, key) of what one deletion leaves, then of replacements with a lesser key."""
        import numpy as np

        own = self.symbols * self.weight
        after = self.total[self.owner] - self.before - own
        # of a row of equal symbols any deletion leaves the same
        first = np.ones(len(own), bool)
        first[1:] = (self.symbols[1:] != self.symbols[:-1]) | (self.owner[1:] != self.owner[:-1])
        shorter = self.key(self.before + after * np.uint64(INVERSE), self.sizes[self.owner] - 1)
        yield self.owner[first], shorter[first]
        rest = self.total[self.owner] - own
        for symbol in range(1, alphabet + 1):
            other = self.key(rest + np.uint64(symbol) * self.weight, self.sizes[self.owner])
            kept = (self.symbols != symbol) & (other < self.keys[self.owner])
            yield self.owner[kept], other[kept]


def _blocks(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """(first, end) of words with about ``most`` letters together, or one word."""
    import numpy as np

    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, end
        at = end


def _reduce(batches: Iterator, alphabet: int) -> Iterator:
    """word, n, key, reduced of (word, n)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        words = batch.column("word").to_pylist()
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype("u8")
        symbols = (_mix(letters) % np.uint64(alphabet) + np.uint64(1)).astype("u1")
        sizes = np.array([len(w) for w in words], "i8")
        ends = np.concatenate([[0], np.cumsum(sizes)])
        raw = symbols.tobytes()
        reduced = [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]
        keys = Reduced(symbols, sizes).keys.view("i8")
        arrays = [batch.column("word"), batch.column("n"), pa.array(keys), pa.array(reduced, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["word", "n", "key", "reduced"])


def _spread(batches: Iterator, alphabet: int) -> Iterator:
    """a (key of a reduced word), b (key of a neighbour) of the column ``reduced``."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        reduced = batch.column("reduced").to_pylist()
        sizes = np.array([len(r) for r in reduced], "i8")
        for at, end in _blocks(sizes, GENERATED // alphabet):
            words = Reduced(np.frombuffer(b"".join(reduced[at:end]), "u1"), sizes[at:end])
            for owner, keys in words.neighbours(alphabet):
                arrays = [pa.array(words.keys[owner].view("i8")), pa.array(keys.view("i8"))]
                yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: all ordered pairs of ``words`` (word, n) one edit apart.

    The number of symbols grows with the vocabulary, so that few words share a reduced word.
    """
    alphabet = min(64, max(4, round(max(words.count(), 1) ** EXPONENT)))
    reduced = cut(
        words.mapInArrow(
            partial(_reduce, alphabet=alphabet), "word string, n bigint, key bigint, reduced binary"
        )
    )
    distinct = reduced.select("key", "reduced").distinct()
    spread = distinct.select("reduced").mapInArrow(
        partial(_spread, alphabet=alphabet), "a bigint, b bigint"
    )
    keys = reduced.select(F.col("key").alias("b")).distinct()
    met = spread.join(keys, "b").select("a", "b").unionByName(keys.select(F.col("b").alias("a"), "b"))
    one, two = (
        reduced.select(F.col("key").alias(c), F.col("word").alias(f"word_{c}"), F.col("n").alias(f"n_{c}"))
        for c in ("a", "b")
    )
    fresh = (F.col("a") != F.col("b")) | (F.col("word_a") < F.col("word_b"))
    edited = F.levenshtein("word_a", "word_b", 1) == 1
    pairs = cut(
        met.join(one, "a")
        .join(two, "b")
        .where(fresh & edited)
        .select("word_a", "n_a", "word_b", "n_b")
        .distinct()
    )
    discard(reduced)
    back = pairs.select("word_b", "n_b", "word_a", "n_a")
    return pairs.union(back).toDF("word", "n", "other", "other_n")


# --- forms ---------------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): pointer doubling, each round written to the shared folder."""
    reached = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = reached.join(step, "root", "left")
        before, reached = reached, cut(
            further.select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            )
        )
        discard(before)
        if reached.where("moved").isEmpty():
            return reached.select("word", "root")


def variants(df: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (doc_id, text).

    ``form``: the near word of the largest count (ties: the least), if it has at least
    FORM_RATIO times the occurrences, else null, as ``form_n`` then is. ``root``: where forms
    lead in the end, the word itself without a form. ``n_near``: words one edit away. Null,
    empty and wordless texts give no words; an empty table gives no rows; further columns
    are left aside.
    """
    words = cut(vocabulary(df))
    near = near_words(words)
    best = near.groupBy("word").agg(
        F.first("n").alias("own"),
        F.count("*").alias("n_near"),
        # the largest count, of equal ones the least word
        F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"),
    )
    taken = -F.col("best.n") >= FORM_RATIO * F.col("own")
    told = cut(
        best.select(
            "word",
            "n_near",
            F.when(taken, F.col("best.word")).alias("form"),
            F.when(taken, -F.col("best.n")).alias("form_n"),
        )
    )
    roots = _roots(told.where("form IS NOT NULL"))
    return (
        words.join(told, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            "form_n",
        )
    )
