"""What the operators share: picking columns, cached byte-pair encoding, linked classes."""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.slices import cut, discard

#: Entries of a worker's word cache before it is cut down; about 60 MB.
CACHE_ENTRIES = 250_000
#: Rows of an Arrow batch that are turned into Python objects at once.
PART_ROWS = 512


def pick(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, cast; further columns of a table, whatever their names, are left."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in columns])


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text, a null text being empty."""
    return pick(df, ("doc_id", "bigint"), ("text", "string")).na.fill("", ["text"])


def parts(batches: Iterator) -> Iterator:
    """Arrow batches in parts of few rows, so that only these are held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def shrink(cache: dict) -> None:
    """Keep the quarter of a word cache that was met first: frequent words come early."""
    kept = list(islice(cache.items(), CACHE_ENTRIES // 4))
    cache.clear()
    cache.update(kept)


class BytePairs(dict):
    """Words after a space -> their ids as little-endian unsigned 32-bit integers.

    A pretoken never reaches over a single space between two non-spaces, so a text is the
    join of its space-separated chunks, each encoded with its leading space. A chunk that
    is empty or has white space at an end breaks that rule and is kept as None; texts that
    hold one are encoded as a whole.

    ``text`` takes all of a text as ordinary; ``ids`` gives the added tokens that the JSON
    file beside the ranks names their own ids, as the tokenizer does.
    """

    def __init__(self, ranks_path: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        beside, added = f"{path.removesuffix('.tiktoken')}.json", []
        if os.path.exists(beside):
            with open(beside, encoding="utf-8") as file:
                added = json.load(file)["added_tokens"]
        self.added = {t["content"]: int(t["id"]).to_bytes(4, "little") for t in added}
        # of tokens that begin at one place the longest
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(map(re.escape, longest))})") if added else None

    def encode(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) >= CACHE_ENTRIES:
            shrink(self)
        odd = not chunk or chunk[0].isspace() or chunk[-1].isspace()
        found = None if odd else self.encode(f" {chunk}")
        if len(chunk) < 64:
            self[chunk] = found
        return found

    def text(self, text: str) -> bytes:
        """All ids of ``text``; the same as encoding it whole."""
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return self.encode(text) if text else b""
        try:
            return self.encode(first) + b"".join(map(self.__getitem__, rest))
        except TypeError:  # a None: white space beside a space
            return self.encode(text)

    def ids(self, text: str) -> bytes:
        """All ids of ``text``, added tokens being one id each."""
        if not self.marks or not self.marks.search(text):
            return self.text(text)
        parts = self.marks.split(text)
        return b"".join(self.added[p] if i % 2 else self.text(p) for i, p in enumerate(parts))


@lru_cache(maxsize=1)
def byte_pairs(ranks_path: str | None) -> BytePairs:
    """A worker's vocabulary, which it keeps from task to task."""
    return BytePairs(ranks_path)


def token_counts(df: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """doc_id, tokens of every text under the byte-pair vocabulary."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pairs = byte_pairs(ranks_path)
        for batch in parts(batches):
            sizes = [len(pairs.ids(text)) // 4 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64())], ["doc_id", "tokens"]
            )

    return documents(df).mapInArrow(count, "doc_id bigint, tokens bigint")


def linked_classes(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, class): the least node that a chain of links reaches.

    Large-star and small-star steps in turn (Kiveris et al., Connected Components in
    MapReduce and Beyond): every node hooks its neighbours to the least node it knows.
    Each round is written to the shared folder, and rounds end when nothing changes.
    Nothing but two counts reaches the driver.
    """
    links = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        old, links = links, cut(small)
        discard(old)
        seen = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if seen == before:
            break
        before = seen
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class"))
