"""Single documents written and read by many tasks: JSON arrays, CSV with a mark, reports.

A document is a folder of parts whose names give their order; one after the other they are
the document, and a manifest lists them. Tasks write parts of rows, the driver those between
(brackets, a header). All parts are written beside the target and get there by a rename, so
that a run which breaks off leaves what was there before.

A JSON array is read in splits, although a split may begin inside a record. Files are read up
to each closing brace, so that a piece never begins behind a backslash. Of a piece it is known
by itself how many quotes it has and by how much it changes the depth, once if it begins
outside a string and once if inside. Running sums over one row per split then tell where each
split begins, and a second pass cuts the records out. Records that reach over splits are put
together from their pieces. A task reads many small splits one after the other, so that their
number, which the session's settings give, costs rows and not tasks.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from math import ceil
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.operators.skew import partitions
from ledgerloom.operators.slices import cut, folder_exists

# The batch functions travel to the executors whole, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST = "_manifest.json"
#: Splits whose states may be broadcast, some 100 bytes each.
BROADCAST_SPLITS = 100_000
#: Bytes up to which a task reads small splits one after the other.
TASK_BYTES = 1 << 25
#: Bytes of pieces that are weighed at once; each takes some 60 meanwhile.
WEIGHED_BYTES = 1 << 18


# --- writing -------------------------------------------------------------------------------------


def _system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    system, at = _system(spark, path)
    out = system.create(at(path))
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def replace_folder(spark: SparkSession, staging: str, path: str, mode: str = "errorifexists") -> None:
    """Move a finished folder to its place. ``overwrite`` puts what is there aside first, and
    back if the move fails."""
    system, at = _system(spark, path)
    aside = f"{path}.old-{uuid4().hex}"
    there = system.exists(at(path))
    if there and mode != "overwrite":
        raise FileExistsError(f"{path} already exists")
    if there and not system.rename(at(path), at(aside)):
        raise OSError(f"{path} cannot be replaced")
    try:
        moved = system.rename(at(staging), at(path))
    except Exception:
        moved = False
    if not moved:
        if there:
            system.rename(at(aside), at(path))
        raise OSError(f"{staging} cannot be moved to {path}")
    if there:
        system.delete(at(aside), True)


def overwrite_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Replace tables under ``root`` once all of them are written; until then the old ones stay."""
    spark = next(iter(tables.values())).sparkSession
    staging = f"{root}.new-{uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{staging}/{name}.parquet")
    system, at = _system(spark, root)
    system.mkdirs(at(root))
    for name in tables:
        replace_folder(spark, f"{staging}/{name}.parquet", f"{root}/{name}.parquet", "overwrite")
    system.delete(at(staging), True)


Section = str | tuple[DataFrame, Sequence[str], str]


def write_document(spark: SparkSession, path: str, sections: Sequence[Section], mode: str = "errorifexists") -> None:
    """Write sections one after the other: texts, and (frame, order, joint) of rows.

    A frame has the column ``value`` with a line each and the columns of ``order``, which order
    it fully; ``joint`` stands before each of its lines but the first.
    """
    if mode != "overwrite" and folder_exists(spark, path):
        raise FileExistsError(f"{path} already exists")
    staging = f"{path}.new-{uuid4().hex}"
    system, at = _system(spark, path)
    listed = []
    for number, section in enumerate(sections):
        if isinstance(section, str):
            names = [f"part-{number:03}-00000"]
            _write_text(spark, f"{staging}/{names[0]}", section)
        else:
            names = _write_rows(spark, staging, number, *section)
        listed += names
    manifest = [{"name": n, "bytes": system.getFileStatus(at(f"{staging}/{n}")).getLen()} for n in listed]
    _write_text(spark, f"{staging}/{MANIFEST}", json.dumps({"parts": manifest}))
    replace_folder(spark, staging, path, mode)


def _write_rows(
    spark: SparkSession, staging: str, number: int, df: DataFrame, order: Sequence[str], joint: str
) -> list[str]:
    """Lines in order, as parts by ranges of the order."""
    ranged = cut(df.repartitionByRange(partitions(df), *order).withColumn("_slice", F.spark_partition_id()))
    first = ranged.agg(F.min(F.struct(*order)).alias("least")).scalar()
    joined = F.when(F.struct(*order) == first, F.col("value")).otherwise(F.concat(F.lit(joint), "value"))
    folder = f"{staging}/_rows-{number}"
    dealt = ranged.withColumn("value", joined).repartitionByRange(partitions(df), "_slice")
    dealt.sortWithinPartitions("_slice", *order).select("value").write.text(folder)
    system, at = _system(spark, folder)
    parts = sorted(s.getPath().getName() for s in system.listStatus(at(folder)))
    names = []
    for place, part in enumerate(p for p in parts if p.startswith("part-")):
        names.append(f"part-{number:03}-{place:05}")
        system.rename(at(f"{folder}/{part}"), at(f"{staging}/{names[-1]}"))
    system.delete(at(folder), True)
    return names


def _as_json(df: DataFrame, order: Sequence[str]) -> DataFrame:
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(record.alias("value"), *order)


def write_json_array(df: DataFrame, path: str, order: Sequence[str], mode: str = "errorifexists") -> None:
    """Records as one JSON array, in order; NULL fields are kept and text stays UTF-8."""
    write_document(df.sparkSession, path, ["[\n", (_as_json(df, order), order, ","), "]\n"], mode)


def write_csv_document(
    df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str], mode: str = "errorifexists"
) -> None:
    """CSV with a byte order mark, one header, a fixed column order, and rows in order."""
    kept = {f"ignore{side}WhiteSpace": "false" for side in ("Leading", "Trailing")}
    options = {"quote": '"', "escape": '"', **kept}
    line = F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), options)
    header = "﻿" + ",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n') else c for c in columns)
    lines = df.select(line.alias("value"), *order)
    write_document(df.sparkSession, path, [f"{header}\n", (lines, order, "")], mode)


def write_report_document(
    spark: SparkSession,
    path: str,
    summary: DataFrame,
    lists: dict[str, tuple[DataFrame, Sequence[str]]],
    mode: str = "errorifexists",
) -> None:
    """One JSON object: ``summary`` (one row), and lists of rows (frame, order) of any size."""
    row = _as_json(summary, []).first()
    sections: list[Section] = [f'{{"summary": {row.value if row else "null"}\n']
    for name, (df, order) in lists.items():
        sections += [f", {json.dumps(name)}: [\n", (_as_json(df, order), order, ","), "]\n"]
    write_document(spark, path, [*sections, "}\n"], mode)


# --- reading JSON arrays -------------------------------------------------------------------------


def _effects(values: list[str]) -> tuple:
    """Of pieces, each with its closing brace: parity of the quotes, change of depth if the
    piece begins outside a string, and if inside."""
    import numpy as np

    pieces = [v.encode() + b"}" for v in values]
    sizes = np.array([len(p) for p in pieces], "i8")
    raw = np.frombuffer(b"".join(pieces), "u1")
    at = np.arange(len(raw))
    slash = raw == 92
    plain = np.maximum.accumulate(np.where(slash, -1, at))
    before = np.concatenate([[0], at[1:] - 1 - plain[:-1]])  # backslashes just before
    quote = (raw == 34) & (before % 2 == 0)
    starts = np.cumsum(sizes) - sizes
    seen = np.cumsum(quote) - quote
    inside = (seen - np.repeat(seen[starts], sizes)) % 2 == 1
    step = ((raw == 123) | (raw == 91)).astype("i8") - ((raw == 125) | (raw == 93))
    quotes = np.add.reduceat(quote.astype("i8"), starts) % 2
    return quotes, np.add.reduceat(np.where(inside, 0, step), starts), np.add.reduceat(np.where(inside, step, 0), starts)


def _weighed(batches: Iterator) -> Iterator:
    """The pieces of lines with their effects, of few bytes at a time or of one piece."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.binary_length(batch.column("value")).to_numpy(zero_copy_only=False).astype("i8") + 1
        ends, at = np.cumsum(sizes), 0
        while at < len(ends):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + WEIGHED_BYTES, "right")))
            part = batch.slice(at, end - at)
            columns = [sizes[at:end], *_effects(part.column("value").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *[pa.array(x, pa.int64()) for x in columns]],
                [*part.schema.names, "size", "quotes", "outside", "inside"],
            )
            at = end


def _summed(batches: Iterator) -> Iterator:
    """One row per split of a task's lines: size, quotes, outside, inside, first character."""
    import pyarrow as pa

    names = ["source_file", "block", "file_size", "size", "quotes", "outside", "inside", "begins"]
    held: dict[tuple, list] = {}
    for batch in _weighed(batches):
        columns = [batch.column(c).to_pylist() for c in ("source_file", "block", "file_size", "size", "quotes", "outside", "inside", "value")]
        for name, block, whole, size, quotes, outside, inside, value in zip(*columns):
            own = held.setdefault((name, block), [whole, 0, 0, 0, 0, None])
            change = (outside, inside) if own[2] == 0 else (inside, outside)
            own[1] += size
            own[2] = (own[2] + quotes) % 2
            own[3] += change[0]
            own[4] += change[1]
            if own[5] is None:
                own[5] = value.lstrip()[:1] or None
    rows = [(*key, *own) for key, own in held.items()]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _cut_out(batches: Iterator) -> Iterator:
    """number (of the split), kind, value: whole records, and the ends (1), middles (2) and
    beginnings (3) of records that reach over splits. Lines come split by split, in order."""
    import pyarrow as pa

    out: list[tuple] = []
    split, open_tail, parity, depth, piece, first = None, False, 0, 0, [], True
    waiting = None

    def piece_done(value: str, closed: bool, quotes: int, change: int) -> None:
        nonlocal parity, depth, piece, first
        if not piece and depth < 2:
            value = value.lstrip(" \t\r\n,")
            if depth == 0 and value.startswith("["):  # the list itself; one in it is no record
                value = value[1:].lstrip()
            if not value and not closed:
                return
            if closed and not value.startswith("{"):
                raise ValueError(f"no list of records: {value[:80]!r}")
            if not closed and not value.startswith("{"):
                if value.strip(" \t\r\n]"):
                    raise ValueError(f"no list of records: {value[:80]!r}")
                return
        parity = (parity + quotes) % 2
        depth += change
        piece.append(value + "}" if closed else value)
        if closed and parity == 0 and depth == 1:
            out.append((split, 0 if first is False else 1, "".join(piece)))
            piece, first = [], False

    def finish() -> None:
        """The last line of a split; what is left of it goes on in the next one."""
        nonlocal piece
        if waiting is not None:
            value, quotes, outside, inside = waiting
            change = inside if parity else outside
            if open_tail and quotes == parity:  # no brace follows, outside a string
                change += 1
            piece_done(value, not open_tail, quotes, change)
        if piece:
            out.append((split, 2 if first else 3, "".join(piece)))
        piece = []

    names = ("value", "number", "open_tail", "parity", "depth", "quotes", "outside", "inside")
    for batch in _weighed(batches):
        for value, number, tail, p, d, quotes, outside, inside in zip(*[batch.column(c).to_pylist() for c in names]):
            if number != split:
                finish()
                split, open_tail, parity, depth, waiting = number, tail, p, d, None
                # nothing is open at the begin of a split at depth 1 and outside strings
                first = d > 1 or p == 1
            elif waiting is not None:
                w, q, o, i = waiting
                piece_done(w, True, q, i if parity else o)
            waiting = (value, quotes, outside, inside)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(("number", "kind", "value"), r)) for r in out], RECORD)
            out.clear()
    finish()
    yield pa.RecordBatch.from_pylist([dict(zip(("number", "kind", "value"), r)) for r in out], RECORD)


def _record_schema():
    import pyarrow as pa

    return pa.schema([("number", pa.int64()), ("kind", pa.int64()), ("value", pa.string())])


RECORD = _record_schema()


def _tasks(lines: DataFrame, path: str) -> int:
    """Tasks for a pass over a document: as many as a shuffle has, more if they would read
    more than ``TASK_BYTES`` each. Splits that are larger stay tasks of their own."""
    system, at = _system(lines.sparkSession, path)
    size = sum(system.getContentSummary(s.getPath()).getLength() for s in system.globStatus(at(path)) or [])
    return max(partitions(lines), ceil(size / TASK_BYTES))


def array_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: the records of a JSON array as texts, in no order. A file or a folder of parts.

    Anything but a list of records fails, here or while it is read.
    """
    lines = spark.read.text(path, lineSep="}").select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    lines = lines.coalesce(_tasks(lines, path))  # the lines of a split stay together, in order
    splits = cut(
        lines.mapInArrow(
            _summed,
            "source_file string, block bigint, file_size bigint, size bigint, quotes bigint, outside bigint, "
            "inside bigint, begins string",
        )
    )
    whole = Window.partitionBy("source_file")
    order = Window.orderBy("source_file", "block")
    # a file that does not end with a brace has got one too many
    last = F.col("block") == F.max("block").over(whole)
    tail = last & (F.sum("size").over(whole) == F.col("file_size") + 1)
    fixed = splits.withColumn("open_tail", tail)
    one = F.when(F.col("open_tail"), 1).otherwise(0)
    fixed = fixed.withColumn("outside", F.col("outside") + F.when(F.col("quotes") == 0, one).otherwise(0))
    fixed = fixed.withColumn("inside", F.col("inside") + F.when(F.col("quotes") == 1, one).otherwise(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = fixed.withColumn("number", F.row_number().over(order).cast("bigint"))
    fixed = fixed.withColumn("parity", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    fixed = fixed.withColumn("change", F.when(F.col("parity") == 1, F.col("inside")).otherwise(F.col("outside")))
    fixed = cut(fixed.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0))))
    told = fixed.agg(
        F.count("*").alias("n"),
        F.sum("change").alias("depth"),
        (F.sum("quotes") % 2).alias("parity"),
        F.min_by("begins", F.when(F.col("begins").isNotNull(), F.col("number"))).alias("begins"),
    ).first()
    if told.begins != "[" or told.depth != 0 or told.parity != 0:
        raise ValueError(f"{path} holds no list of records")
    states = fixed.select("source_file", "block", "number", "open_tail", "parity", "depth")
    if told.n <= BROADCAST_SPLITS:
        # lines stay where they were read, in order
        placed = lines.join(F.broadcast(states), ["source_file", "block"])
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        placed = numbered.join(states, ["source_file", "block"]).repartition(partitions(lines), "number")
        placed = placed.sortWithinPartitions("number", "line")
    columns = ("value", "number", "open_tail", "parity", "depth")
    cut_out = cut(placed.select(*columns).mapInArrow(_cut_out, "number bigint, kind bigint, value string"))
    # kinds: 0 a record, 1 the end of one, 2 a split inside one, 3 the beginning of one
    marks = cut_out.where("kind > 0").select("number", "kind")
    begun = F.max(F.when(F.col("kind") == 3, F.col("number"))).over(
        Window.orderBy("number", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    keyed = cut_out.where("kind > 0").join(marks.withColumn("begun", begun), ["number", "kind"])
    pieces = keyed.groupBy("begun").agg(F.array_sort(F.collect_list(F.struct("number", "value"))).alias("p"))
    joined = pieces.select(F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    return cut_out.where("kind = 0").select("value").unionByName(joined)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The records of a JSON array, read by many tasks; a record that does not parse fails."""
    lines = array_lines(spark, path)
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
