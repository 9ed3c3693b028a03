"""Publishing the profile feed: slices, payloads, create or update, progress and its audit.

The feed is an append-only set of records. A batch is published as a whole, never record by
record. The streaming job keeps its place in Spark's own checkpoint and the published ids in
the state store, where a batch looks up its own ids only; a batch that is replayed after a
crash writes the same folder again. Beside the published records lie the digests of ranges of
positions, so that a feed whose published part has changed is found out and the changes are
found without reading all of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.exprs import count_if, display_label, is_present, or_blank
from ledgerloom.operators.relate import ID
from ledgerloom.operators.skew import beside, lookup_join
from ledgerloom.operators.slices import cut, folder_exists, number_rows, with_previous
from ledgerloom.sources.register import PLACE, place_lines
from ledgerloom.streaming import hashtree, known as keyed

# Actions and states of a publishing run.
CREATE, UPDATE = "CREATE", "UPDATE"
FAILED, READY = "FAILED", "READY_TO_RESUME"


# --- slices and payloads ----------------------------------------------------------------------


def feed_slice(feed: DataFrame, offset: int, size: int, position: str = "feed_index") -> DataFrame:
    """The records from ``offset`` on, ``size`` of them: a range filter that is pushed down."""
    return feed.where((F.col(position) >= offset) & (F.col(position) < offset + size))


def feed_slices(feed: DataFrame, size: int, position: str = "feed_index") -> DataFrame:
    """The whole feed cut into slices: ``slice, first, last, records`` each."""
    number = F.floor(F.col(position) / size).cast("long")
    return feed.groupBy(number.alias("slice")).agg(
        F.min(position).alias("first_index"),
        F.max(position).alias("last_index"),
        F.count("*").alias("records"),
    )


def sync_payload(feed: DataFrame) -> DataFrame:
    """The flat payload of each record: nested fields lifted out, blanks for missing texts."""
    return feed.select(
        ID,
        display_label(F.col("label"), F.col(ID)).alias("title"),
        "profile_feed_version",
        "schema_version",
        or_blank(F.col("status")).alias("status"),
        or_blank(F.col("gender")).alias("gender"),
        or_blank(F.col("country")).alias("country"),
        or_blank(F.col("position.primary")).alias("primary_position"),
        or_blank(F.col("position.secondary")).alias("secondary_positions"),
        or_blank(F.col("position.status")).alias("position_status"),
        F.col("position.evidence_count").alias("position_evidence_count"),
        F.col("position.provider_count").alias("position_provider_count"),
        "club_evidence",
        F.col("index.alias_count").alias("alias_count"),
        F.col("index.external_id_count").alias("external_id_count"),
        *[c for c in ("feed_index", *PLACE) if c in feed.columns],
    )


# --- create or update ---------------------------------------------------------------------------


def upsert_plan(batch: DataFrame, published: DataFrame, position: str = "feed_index") -> DataFrame:
    """Each record with its action. The first record of an unknown id creates it; whatever
    follows, in this batch or after earlier ones, updates it. Records without an id fail."""
    known = published.where(F.col(ID).isNotNull()).select(ID).distinct().withColumn(
        "_known", F.lit(True)
    )
    first = batch.where(F.col(ID).isNotNull()).groupBy(ID).agg(
        F.min(position).alias("_first"), F.count("*").alias("n")
    )
    seen = first.join(known, ID, "left").select(ID, "_first", "_known")
    planned = lookup_join(batch, seen, ID, "left", first.select(ID, "n"), distinct=True)
    action = (
        F.when(~is_present(F.col(ID)), FAILED)
        .when(F.col("_known").isNotNull(), UPDATE)
        .when(F.col(position) == F.col("_first"), CREATE)
        .otherwise(UPDATE)
    )
    return planned.withColumn("action", action).drop("_first", "_known")


def latest_payloads(batch: DataFrame, position: str = "feed_index") -> DataFrame:
    """The last record of each id; a partial aggregate, so a hot id is folded in the map tasks."""
    fields = [c for c in batch.columns if c != ID]
    last = batch.where(is_present(F.col(ID))).groupBy(ID).agg(
        F.max_by(F.struct(*fields), F.col(position)).alias("_last")
    )
    return last.select(ID, *[F.col(f"_last.{c}").alias(c) for c in fields])


def action_counts(plan: DataFrame) -> DataFrame:
    """One row: records selected, created, updated and failed."""
    return plan.agg(
        F.count("*").alias("selected"),
        count_if(F.col("action") == CREATE).alias("created"),
        count_if(F.col("action") == UPDATE).alias("updated"),
        count_if(F.col("action") == FAILED).alias("failed"),
    )


def identity_mismatches(
    sent: DataFrame, returned: DataFrame, key: str = "publish_id"
) -> DataFrame:
    """Published records that came back under another id, or under none."""
    a = sent.select(key, F.col(ID).alias("sent_id"))
    b = returned.select(key, F.col(ID).alias("returned_id"))
    joined = a.join(b, key, "left")
    return joined.where(~F.col("sent_id").eqNullSafe(F.col("returned_id")))


# --- the running job ------------------------------------------------------------------------------


# One row per batch; counters run over all batches so far.
PROGRESS = (
    "feed string, feed_sha256 string, published_sha256 string, last_file string, next_offset bigint, selected bigint, created bigint, "
    "updated bigint, failed bigint, status string, started_at timestamp, last_success_at timestamp, completed_at timestamp"
)
RANGE_SUMS = "leaf bigint, n bigint, " + ", ".join(f"{s} decimal(38,0)" for s in hashtree.SUMS)
#: Positions of a range whose records share a digest.
RANGE = 1 << 16


def _earlier(spark: SparkSession, folder: str, schema: str, before: int) -> DataFrame:
    """Rows of the batches before this one."""
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], f"{schema}, batch int")
    return spark.read.schema(f"{schema}, batch int").parquet(folder).where(F.col("batch") < before)


def _fingerprint(records: DataFrame, position: str) -> Column:
    """The digest of a record at its position, whatever the order of its columns."""
    fields = sorted(c for c in records.columns if c not in (position, "known", "action", *PLACE))
    packed = [_packed(c, records.schema[c].dataType) for c in fields]
    return hashtree.record_digest([F.col(position), *packed])


def _packed(name: str, kind: T.DataType) -> Column:
    """``to_json`` of one field; whole numbers and plain texts are put together without it."""
    json, value = F.to_json(F.struct(name)), F.col(name)
    if not name.isidentifier() or not isinstance(kind, (T.IntegralType, T.StringType)):
        return json
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.concat(F.lit(f'{{"{name}":'), value.cast("string"), F.lit("}")), F.lit("{}"))
    plain = F.concat(F.lit(f'{{"{name}":"'), value, F.lit('"}'))
    return F.when(value.isNull(), "{}").when(value.rlike(r"^[ !#-\[\]-~]*\z"), plain).otherwise(json)


def _ranges(records: DataFrame, position: str, fingerprint: Column) -> DataFrame:
    return hashtree.leaves(records, F.floor(F.col(position) / F.lit(RANGE)), fingerprint)


def publish_batch(
    batch: DataFrame,
    batch_id: int,
    sink: str,
    position: str = "feed_index",
    feed: str = "feed",
    feed_sha256: str | None = None,
) -> None:
    """Publish one batch into folders of its own; doing it again changes nothing.

    Lines of a feed (``read_feed`` as a stream) get their positions after the lines of the
    batches before, so files come in the order of their names; other records without a position go on counting where the batch before has
    stopped. A batch with a column ``told`` brings what the state store said of its ids, and
    reads no earlier batch. Otherwise ``known`` in the sink, which holds every published id once,
    is read. ``progress`` is the state to resume from and the history to audit: feed, next
    offset, counters over all batches, status and times. ``published_sha256`` is the hash of all
    that was published so far. ``feed_sha256`` is that of the first batch, until a run finds
    (``resumed_sha256``) that the feed no longer begins with what was published.
    """
    spark = batch.sparkSession
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    state = _earlier(spark, f"{sink}/progress", PROGRESS, batch_id).orderBy(F.desc("batch")).first()
    before = state.asDict() if state else {}
    base, ending, last_file = before.get("next_offset") or 0, None, None
    told, fixed = None, keyed.TOLD in batch.columns
    if fixed:
        batch = cut(batch)
        told = batch.where(F.col(keyed.TOLD).isNotNull()).select(ID, keyed.TOLD)
        batch = batch.where(F.col(keyed.TOLD).isNull()).drop(keyed.TOLD)
    if position not in batch.columns and "line" in batch.columns:
        batch = batch if fixed else cut(batch)
        first, last_file, lines = batch.agg(F.min("source_file"), F.max("source_file"), F.count("*")).first()
        if first is not None and (before.get("last_file") or "") >= first:
            raise ValueError(f"{first} comes after {before['last_file']}: files of a feed come in the order of their names")
        ending = base + lines
        batch = place_lines(batch, base, position).drop("source_file")
    elif position not in batch.columns:
        placed = number_rows(batch.withColumn("_order", F.monotonically_increasing_id()), ["_order"], position)
        batch = placed.withColumn(position, F.col(position) - 1 + base).drop("_order")
    if fixed:
        known = keyed.known_ids(told, batch)
    else:
        id_type = batch.schema[ID].dataType.simpleString()
        known = _earlier(spark, f"{sink}/known", f"{ID} {id_type}", batch_id).select(ID)
    planned = upsert_plan(batch, known, position)
    plan = cut(planned.withColumn("fingerprint", _fingerprint(batch, position)))
    good = plan.where(F.col("action") != FAILED).drop("fingerprint")

    def write(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{sink}/{table}/batch={batch_id}")

    write(latest_payloads(good.drop("action"), position), "published")
    write(plan.where(F.col("action") == CREATE).select(ID), "known")
    event = F.when(F.col("action") == FAILED, "failure").otherwise("success").alias("event")
    events = plan.select(ID, position, "action", event, "fingerprint")
    write(events.withColumn("logged_at", F.current_timestamp()), "events")
    write(_ranges(plan, position, F.col("fingerprint")), "ranges")
    published = hashtree.root_sha256(_published_ranges(spark, sink, batch_id + 1)).first().sha256
    now = beside(action_counts(plan), plan.agg(F.max(position).alias("last"))).first()
    if ending is None:
        ending = before.get("next_offset") if now.last is None else int(now.last) + 1
    ended = datetime.now(timezone.utc).replace(tzinfo=None)
    status = FAILED if now.failed else READY
    row = (
        feed,
        feed_sha256 or before.get("feed_sha256") or published,
        published,
        last_file or before.get("last_file"),
        ending,
        *[(before.get(n) or 0) + now[n] for n in ("selected", "created", "updated", "failed")],
        status,
        started,
        ended if status == READY else before.get("last_success_at"),
        ended,
    )
    write(spark.createDataFrame([row], PROGRESS), "progress")


def _published_ranges(spark: SparkSession, sink: str, before: int) -> DataFrame:
    """The ranges of all batches up to one; a row for each range, not for each record."""
    return hashtree.added(_earlier(spark, f"{sink}/ranges", RANGE_SUMS, before))


def _last_progress(spark: SparkSession, sink: str) -> dict:
    row = _earlier(spark, f"{sink}/progress", PROGRESS, 1 << 30).orderBy(F.desc("batch")).first()
    return row.asDict() if row else {}


def resumed_sha256(spark: SparkSession, sink: str, feed: DataFrame, position: str = "feed_index") -> str | None:
    """The fingerprint for the steps of a run that goes on with ``feed`` (payloads with positions).

    As long as the feed begins with what was published that is the one of the steps before;
    otherwise it is the hash of what the feed now has there. None before the first batch.
    """
    last = _last_progress(spark, sink)
    if not last:
        return None
    begin = feed.where(F.col(position) < (last["next_offset"] or 0))
    now = hashtree.root_sha256(_ranges(begin, position, _fingerprint(feed, position))).first().sha256
    return last["feed_sha256"] if now == last["published_sha256"] else now


def changed_positions(spark: SparkSession, sink: str, feed: DataFrame, position: str = "feed_index") -> DataFrame:
    """position, change, ranges_read: where ``feed`` differs from what was published of it.

    The digests of ranges are compared from the root down; the events and the records of the
    ranges that differ are read.
    """
    last = _last_progress(spark, sink)
    offset = last.get("next_offset") or 0
    now = feed.where(F.col(position) < offset).select(position, _fingerprint(feed, position).alias("fingerprint"))
    # every level reads both trees, so the feed is read once for them
    trees = [cut(t) for t in (_published_ranges(spark, sink, 1 << 30), _ranges(now, position, F.col("fingerprint")))]
    moved = cut(hashtree.differing(*trees, max(1, -(-offset // RANGE))))
    told = _earlier(spark, f"{sink}/events", f"{position} bigint, fingerprint string", 1 << 30)
    leaf = F.floor(F.col(position) / F.lit(RANGE)).alias("leaf")
    sides = [
        df.select(F.col(position).alias(ID), "fingerprint", leaf).join(moved, "leaf", "left_semi").drop("leaf")
        for df in (told, now)
    ]
    counted = moved.agg(F.count("*").alias("ranges_read"))
    changes = changed_records(*sides).withColumnRenamed(ID, position)
    return changes.withColumn("ranges_read", counted.scalar())


def publish_stream(
    feed: DataFrame,
    sink: str,
    checkpoint: str,
    position: str = "feed_index",
    available_now: bool = False,
    name: str = "feed",
    published: DataFrame | None = None,
) -> StreamingQuery:
    """Publish a streaming feed. ``sink`` and ``checkpoint`` are folders all executors share.

    Published ids are state of the query. ``published`` is the feed as a batch frame, read anew:
    with it a run tells in its steps if the part published before is no longer the same.
    """
    spark = feed.sparkSession
    sha256 = resumed_sha256(spark, sink, published, position) if published is not None else None
    writer = (
        keyed.with_told(feed)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch_id: publish_batch(df, batch_id, sink, position, name, sha256))
    )
    provider = spark.conf.get(keyed.PROVIDER)
    spark.conf.set(keyed.PROVIDER, keyed.ROCKSDB)  # a query keeps the provider it starts with
    try:
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(keyed.PROVIDER, provider)


def published_state(spark: SparkSession, sink: str) -> DataFrame:
    """The current payload of every published id: that of its last batch."""
    rows = spark.read.parquet(f"{sink}/published")
    fields = [c for c in rows.columns if c not in (ID, "batch")]
    last = rows.groupBy(ID).agg(F.max_by(F.struct(*fields), F.col("batch")).alias("_last"))
    return last.select(ID, *[F.col(f"_last.{c}").alias(c) for c in fields])


# --- fingerprints ---------------------------------------------------------------------------------


def row_text(columns: Sequence[Column]) -> Column:
    """Fields of a record as one text; NULL and blank stay apart."""
    return F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns])


def exact_double(value: Column) -> Column:
    """A double as two whole numbers, which every engine writes alike: floor, and 2^60 of the rest."""
    whole = F.floor(value)
    rest = F.floor((value - whole) * F.lit(2.0**60))
    return F.concat_ws("/", whole.cast("string"), rest.cast("string"))


def record_fingerprints(feed: DataFrame, columns: Sequence[Column]) -> DataFrame:
    return feed.withColumn("fingerprint", F.sha2(row_text(columns), 256))


def feed_fingerprint(feed: DataFrame, columns: Sequence[Column], buckets: int = 256) -> DataFrame:
    """One row: a fingerprint of the whole feed that does not hang on the order of its records.

    Record digests are summed in ``buckets`` groups (by their first byte), in the map tasks
    first, and the sums are hashed. No list of digests is ever built.
    """
    digests = feed.select(F.sha2(row_text(columns), 256).alias("d"))
    # all 64 digits, twelve at a time, so that sums of many records do not overflow
    parts = [
        F.conv(F.substring("d", start, 12), 16, 10).cast("decimal(38,0)") for start in range(1, 64, 12)
    ]
    sums = digests.groupBy(F.substring("d", 1, 2).alias("b")).agg(
        F.count("*").alias("n"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)]
    )
    line = F.concat_ws(":", "b", F.col("n").cast("string"), *[F.col(f"s{i}").cast("string") for i in range(len(parts))])
    return sums.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "|"), 256).alias("feed_sha256"),
    )


def changed_records(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids whose set of fingerprints differs: ``added``, ``removed`` or ``changed``.

    Works on (id, fingerprint) counts, so copies count and no id collects its records.
    """
    tagged = before.select(ID, "fingerprint", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(ID, "fingerprint", F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    balance = tagged.groupBy(ID, "fingerprint").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    per = balance.groupBy(ID).agg(
        F.sum("b").alias("b"), F.sum("a").alias("a"), F.bool_or(F.col("a") != F.col("b")).alias("moved")
    )
    return per.where("moved").select(
        ID,
        F.when(F.col("b") == 0, "added").when(F.col("a") == 0, "removed").otherwise("changed").alias("change"),
    )


# --- audit of the progress history ----------------------------------------------------------------


def progress_violations(
    history: DataFrame,
    batch_size: int,
    order: Sequence[str] = ("ts",),
    key: str = "feed",
    records: DataFrame | None = None,
) -> DataFrame:
    """Each step of a progress history with what is wrong about it.

    ``history``: feed, feed_sha256, next_offset, status and the columns of ``order``, which
    must order the steps of a feed fully; the progress table of ``publish_batch`` ordered by
    ``batch`` is one. ``records`` (feed, records) has the size of each feed, beyond which no
    offset may lie; offsets of feeds that it lacks are not held against it.
    """
    if records is None:
        history = history.withColumn("records", F.lit(None).cast("long"))
    else:
        history = lookup_join(history, records.select(key, F.col("records").cast("long")), key, "left")
    stepped = with_previous(history, key, order, ["feed_sha256", "next_offset"])
    offset, before = F.col("next_offset"), F.col("previous_next_offset")
    later = F.col("previous_feed_sha256").isNotNull() | before.isNotNull()
    return stepped.select(
        *[c for c in history.columns if c != "records"],
        F.coalesce(offset > F.col("records"), F.lit(False)).alias("offset_past_end"),
        F.coalesce(offset.isNull() | (offset < 0), F.lit(True)).alias("invalid_offset"),
        F.coalesce(F.length("feed_sha256") != 64, F.lit(True)).alias("invalid_fingerprint"),
        (later & ~F.col("feed_sha256").eqNullSafe(F.col("previous_feed_sha256"))).alias(
            "fingerprint_changed"
        ),
        F.coalesce(offset < before, F.lit(False)).alias("offset_regression"),
        F.coalesce(offset - before > batch_size, F.lit(False)).alias("oversize_batch"),
        (~F.coalesce(F.col("status").isin(FAILED, READY), F.lit(False))).alias("bad_status"),
    )


def recoverable_steps(violations: DataFrame) -> DataFrame:
    """Failed steps that moved forward within bounds; a run may resume after them."""
    clean = ~(
        F.col("invalid_offset")
        | F.col("invalid_fingerprint")
        | F.col("fingerprint_changed")
        | F.col("offset_regression")
        | F.col("oversize_batch")
        | F.col("offset_past_end")
    )
    return violations.where(clean & (F.col("status") == FAILED)).withColumn("status", F.lit(READY))
