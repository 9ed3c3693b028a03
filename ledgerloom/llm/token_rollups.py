"""Token totals that are kept up to date by signed deltas, not by counting anew.

A batch of changes is summed per source, language and tokenizer version and added to the
store as one small table. A batch is written to a staging folder and renamed to a name made
from its id; the rename is the commit. A batch whose folder exists was committed before and
is skipped, so replaying one, whole or after a crash, changes nothing. The totals are sums
over committed batches. ``compact`` folds them into a snapshot, a table of one row per key with
the list of the batches in it; a batch that a snapshot lists counts as committed, and its
folder, if it is still there, is not read.

Tokens are those of byte-pair vocabularies, one tokenizer version each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import partial
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import BytePairs, parts, pick

KEYS = ("source", "lang", "tokenizer_version")
DELTAS = "source string, lang string, tokenizer_version string, docs bigint, tokens bigint"


def signed(changes: DataFrame) -> DataFrame:
    """Changes (op, source, lang, tokenizer_version, tokens, old_tokens) -> summed deltas.

    op: ``insert`` adds a document, ``delete`` takes it off, ``revise`` replaces its count
    ``old_tokens`` by ``tokens``. Null counts are 0; other ops, null ones too, are an error.
    A change of source or language is a delete and an insert.
    """
    op = F.col("op")
    tokens = F.coalesce(F.col("tokens"), F.lit(0)).cast("bigint")
    old = F.coalesce(F.col("old_tokens"), F.lit(0)).cast("bigint")
    known = (
        F.when(op == "insert", F.struct(F.lit(1).alias("d"), tokens.alias("t")))
        .when(op == "delete", F.struct(F.lit(-1).alias("d"), (-tokens).alias("t")))
        .when(op == "revise", F.struct(F.lit(0).alias("d"), (tokens - old).alias("t")))
        .otherwise(F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce(op, F.lit("null")))))
    )
    parts = changes.select(*KEYS, known.alias("_delta"))
    return parts.groupBy(*KEYS).agg(
        F.sum("_delta.d").cast("bigint").alias("docs"), F.sum("_delta.t").alias("tokens")
    )


class TokenRollup:
    """Totals in ``folder``, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(self.folder).toUri(), conf
        )
        self._fs = self._path(self.folder).getFileSystem(conf)

    def _home(self, batch_id: str) -> str:
        return f"{self.folder}/batches/{sha256(batch_id.encode()).hexdigest()}"

    def committed(self, batch_id: str) -> bool:
        home = self._home(batch_id)
        return self._fs.exists(self._path(home)) or home.rpartition("/")[2] in self._folded()

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.folder}/{folder}")
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def _snapshot(self) -> str | None:
        """The newest snapshot; they are numbered."""
        names = self._names("snapshots")
        return f"{self.folder}/snapshots/{names[-1]}" if names else None

    def _folded(self) -> set[str]:
        """The names of the batches in the newest snapshot, one short name for each."""
        snapshot = self._snapshot()
        if not snapshot:
            return set()
        return {r.batch for r in self.spark.read.schema("batch string").parquet(f"{snapshot}/batches").collect()}

    def compact(self) -> int:
        """Fold all committed batches into a new snapshot and delete their folders; how many.

        The rename of the snapshot commits it. If it breaks off before, nothing has changed;
        after it, the folders that are left are not read and go with the next compaction.
        """
        folded, there = self._folded(), self._names("batches")
        new = [n for n in there if n not in folded]
        if new:
            number = len(self._names("snapshots"))
            staged = f"{self.folder}/staging/{uuid4().hex}"
            self._deltas().groupBy(*KEYS).agg(
                F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
            ).coalesce(8).write.parquet(f"{staged}/deltas")
            listed = [(n,) for n in sorted(folded | set(new))]
            self.spark.createDataFrame(listed, "batch string").coalesce(1).write.parquet(f"{staged}/batches")
            if not self._rename(staged, f"{self.folder}/snapshots/{number:09}"):
                return 0
        for name in there:
            self._fs.delete(self._path(f"{self.folder}/batches/{name}"), True)
        return len(new)

    def _deltas(self) -> DataFrame:
        """The deltas of the newest snapshot and of the batches that it does not list."""
        folded, snapshot = self._folded(), self._snapshot()
        folders = [f"{self.folder}/batches/{n}" for n in self._names("batches") if n not in folded]
        folders += [f"{snapshot}/deltas"] if snapshot else []
        if not folders:
            return self.spark.createDataFrame([], DELTAS)
        return self.spark.read.schema(DELTAS).parquet(*folders)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before, in which case nothing is read."""
        if self.committed(batch_id):
            return False
        staged = f"{self.folder}/staging/{uuid4().hex}"
        # one small row per key; few files, however many tasks summed them
        signed(changes).coalesce(8).write.parquet(staged)
        return self._rename(staged, self._home(batch_id))

    def _rename(self, staged: str, home: str) -> bool:
        """False if another writer was first: an existing folder is never replaced."""
        self._fs.mkdirs(self._path(home).getParent())
        plain = self.spark._sc._gateway.new_array(
            self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        try:
            self._files.rename(self._path(staged), self._path(home), plain)
        except Exception:
            if self._fs.exists(self._path(home)):
                self._fs.delete(self._path(staged), True)
                return False
            raise
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, docs, tokens; keys without documents are left out.

        No batches, or empty ones, give no rows. Null sources and languages are keys.
        """
        deltas = self._deltas()
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")


#: Tokenizer versions: byte-pair vocabularies, by the names of their rank files.
VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")
SPACE = "[ \t\n\r\f]+"
COUNTED = (
    "doc_id bigint, source string, lang string, h binary, "
    "counts array<struct<tokenizer_version: string, n: bigint, slim: bigint>>"
)

_vocabularies: dict[str, BytePairs] = {}


def vocabulary(version: str, folder: str | None) -> BytePairs:
    """A worker's vocabulary, which it keeps from task to task."""
    import public_tokenizers

    if version not in _vocabularies:
        name = f"{version}.tiktoken"
        _vocabularies[version] = BytePairs(f"{folder}/{name}" if folder else public_tokenizers.path(name))
    return _vocabularies[version]


def squeezed(text: str) -> str:
    """Runs of white space as one space, none at the ends."""
    return re.sub(SPACE, " ", text).strip(" ")


def _count(batches: Iterator, versions: Sequence[str], folder: str | None) -> Iterator:
    import pyarrow as pa

    vocabularies = {v: vocabulary(v, folder) for v in versions}
    kind = pa.list_(pa.struct([("tokenizer_version", pa.string()), ("n", pa.int64()), ("slim", pa.int64())]))
    for batch in batches:
        for part in parts([batch]):
            keys, counts = [], []
            for text in part.column("text").to_pylist():
                text = text or ""
                slim = squeezed(text)
                told = []
                for version, pairs in vocabularies.items():
                    n = len(pairs.ids(text)) // 4
                    less = n if slim == text else len(pairs.ids(slim)) // 4
                    told.append({"tokenizer_version": version, "n": n, "slim": less})
                keys.append(sha256(text.encode()).digest())
                counts.append(told)
            arrays = [part.column(c) for c in ("doc_id", "source", "lang")]
            arrays += [pa.array(keys, pa.binary()), pa.array(counts, kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "source", "lang", "h", "counts"])


def counted(df: DataFrame, versions: Sequence[str] = VERSIONS, folder: str | None = None) -> DataFrame:
    """doc_id, source, lang, h (digest of the text), counts of (doc_id, text, source, lang): tokens
    of the text, and of the text with its white space squeezed, for each tokenizer version.

    Null texts are empty and have no tokens; repeated rows are counted each; further columns are
    left aside. ``folder`` holds the rank files.
    """
    rows = pick(df, ("doc_id", "bigint"), ("source", "string"), ("lang", "string"), ("text", "string"))
    return rows.mapInArrow(partial(_count, versions=tuple(versions), folder=folder), COUNTED)
