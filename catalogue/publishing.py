"""Publishing: slices, payloads, create or update, fingerprints, progress audit."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from catalogue.registers import over
from ledgerloom.operators.skew import partitions
from ledgerloom.operators.slices import ensure_checkpoint_dir
from ledgerloom.sources import register
from ledgerloom.streaming import hashtree, publish


def feed(r) -> DataFrame:
    """Events as profile records of their users, in the order of the events."""
    return r.table("events").select(
        F.col("event_id").alias("feed_index"),
        F.col("user_id").alias("entity_id"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("label"),
        F.lit("1.0").alias("profile_feed_version"),
        F.lit("2").alias("schema_version"),
        F.when(F.col("event_type") == "error", "retired").alias("status"),
        F.lit(None).cast("string").alias("gender"),
        F.when(F.col("value") > 50, "XX").alias("country"),
        F.struct(
            F.when(F.col("event_type") == "view", "GK").alias("primary"),
            F.lit(None).cast("string").alias("secondary"),
            F.lit("known").alias("status"),
            F.get_json_object("props", "$.k").cast("long").alias("evidence_count"),
            F.lit(1).cast("long").alias("provider_count"),
        ).alias("position"),
        F.lit(None).cast("string").alias("club_evidence"),
        F.struct(
            F.length("props").cast("long").alias("alias_count"),
            F.lit(None).cast("long").alias("external_id_count"),
        ).alias("index"),
    )


PAYLOAD = (
    "payload AS (SELECT user_id AS entity_id, COALESCE(CASE WHEN event_type <> 'signup' THEN event_type END, CONCAT('Player ', "
    "user_id)) AS title, '1.0' AS profile_feed_version, '2' AS schema_version, CASE WHEN event_type = 'error' THEN 'retired' "
    "ELSE '' END AS status, '' AS gender, CASE WHEN value > 50 THEN 'XX' ELSE '' END AS country, CASE WHEN event_type = 'view' "
    "THEN 'GK' ELSE '' END AS primary_position, '' AS secondary_positions, 'known' AS position_status, CAST(json_extract(props, "
    "'$.k') AS BIGINT) AS position_evidence_count, CAST(1 AS BIGINT) AS position_provider_count, CAST(NULL AS VARCHAR) AS "
    "club_evidence, LENGTH(props) AS alias_count, CAST(NULL AS BIGINT) AS external_id_count, event_id AS feed_index FROM events)"
)
PLAN = (
    "plan AS (SELECT event_id AS feed_index, user_id AS entity_id, CASE WHEN user_id IN (SELECT doc_id FROM labels) THEN 'UPDATE' "
    "WHEN event_id = MIN(event_id) OVER (PARTITION BY user_id) THEN 'CREATE' ELSE 'UPDATE' END AS action FROM events)"
)


def published(r) -> DataFrame:
    return r.table("labels").select(F.col("doc_id").alias("entity_id"))


def plan(r) -> DataFrame:
    return publish.upsert_plan(feed(r).select("feed_index", "entity_id"), published(r))


def fingerprint_columns() -> list:
    """All columns of events."""
    moment = F.date_format("ts", "yyyyMMddHHmmssSSSSSS")
    value = publish.exact_double(F.col("value"))
    return [F.col("event_id"), moment, F.col("user_id"), F.col("event_type"), value, F.col("props")]


VALUE = "CONCAT(CAST(FLOOR(value) AS BIGINT), '/', CAST(FLOOR((value - FLOOR(value)) * 1152921504606846976) AS BIGINT))"
ROW_TEXT = f"CONCAT_WS(CHR(31), event_id, STRFTIME(ts, '%Y%m%d%H%M%S%f'), user_id, event_type, {VALUE}, props)"


def order_columns() -> list:
    """All columns of orders."""
    moment = F.date_format("o_orderdate", "yyyyMMddHHmmssSSSSSS")
    price = publish.exact_double(F.col("o_totalprice"))
    return [F.col("o_orderkey"), F.col("entity_id"), F.col("o_orderstatus"), price, moment, F.col("o_orderpriority")]


def closed(orders: DataFrame) -> DataFrame:
    """A later snapshot: pending orders are closed, and urgent ones are gone to another customer."""
    moved = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("entity_id") + 1).otherwise(F.col("entity_id"))
    status = F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    return orders.withColumn("entity_id", moved).withColumn("o_orderstatus", status)


def snapshots(r) -> list[DataFrame]:
    orders = r.table("orders").withColumnRenamed("o_custkey", "entity_id")
    return [publish.record_fingerprints(df, order_columns()) for df in (orders, closed(orders))]


def history(r) -> DataFrame:
    """Events as the progress history of one feed per event type."""
    return r.table("events").select(
        F.col("event_type").alias("feed"),
        "ts",
        "event_id",
        F.when(F.col("value") < 30, F.sha2("event_type", 256)).otherwise("short").alias("feed_sha256"),
        F.when(F.col("value") > 0.05, F.get_json_object("props", "$.k").cast("long")).alias("next_offset"),
        F.when(F.col("value") < 10, "FAILED")
        .when(F.col("value") < 60, "READY_TO_RESUME")
        .otherwise("RUNNING")
        .alias("status"),
    )


HISTORY = (
    "history AS (SELECT event_type AS feed, ts, event_id, CASE WHEN value < 30 THEN SHA256(event_type) ELSE 'short' END AS "
    "feed_sha256, CASE WHEN value > 0.05 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS next_offset, CASE WHEN value < 10 "
    "THEN 'FAILED' WHEN value < 60 THEN 'READY_TO_RESUME' ELSE 'RUNNING' END AS status FROM events), stepped AS (SELECT *, "
    "LAG(feed_sha256) OVER w AS psha, LAG(next_offset) OVER w AS poff FROM history WINDOW w AS (PARTITION BY feed ORDER BY ts, "
    "event_id)), violations AS (SELECT * EXCLUDE (psha, poff, records), COALESCE(next_offset IS NULL OR next_offset < 0, true) AS "
    "invalid_offset, COALESCE(LENGTH(feed_sha256) <> 64, true) AS invalid_fingerprint, (psha IS NOT NULL OR poff IS NOT NULL) AND "
    "feed_sha256 IS DISTINCT FROM psha AS fingerprint_changed, COALESCE(next_offset < poff, false) AS offset_regression, "
    "COALESCE(next_offset - poff > 40, false) AS oversize_batch, status NOT IN ('FAILED', 'READY_TO_RESUME') AS bad_status, "
    "COALESCE(next_offset > records, false) AS offset_past_end FROM stepped LEFT JOIN (SELECT event_type AS feed, COUNT(DISTINCT "
    "props) AS records FROM events GROUP BY 1) USING (feed))"
)


def violations(r) -> DataFrame:
    sizes = r.table("events").groupBy(F.col("event_type").alias("feed")).agg(
        F.count_distinct("props").alias("records")
    )
    return publish.progress_violations(history(r), 40, ("ts", "event_id"), records=sizes)


def returned(r) -> DataFrame:
    """What came back of the published orders: pending ones of two priorities under another id, or none."""
    pending, kind = F.col("o_orderstatus") == "P", F.col("o_orderpriority")
    known = F.when(pending & (kind == "1-URGENT"), F.col("o_custkey") + 1).when(
        ~(pending & (kind == "5-LOW")), F.col("o_custkey")
    )
    return r.table("orders").select(F.col("o_orderkey").alias("publish_id"), known.alias("entity_id"))


RUNS = 3
SCHEMA = register.FEED_SCHEMA.replace("entity_id string", "entity_id bigint")


def write_lines(r, source: str, run: int) -> None:
    """One third of the events as lines of JSON, in order, in files of their own."""
    size = -(-r.table("events").count() // RUNS)
    third = publish.feed_slice(feed(r), run * size, size)
    line = F.to_json(F.struct(*[c for c in third.columns if c != "feed_index"]), {"ignoreNullFields": "false"})
    ordered = third.repartitionByRange(partitions(third), "feed_index").sortWithinPartitions("feed_index")
    ordered.select(line.alias("value")).write.text(f"{source}/{run}")


def changed(payloads: DataFrame) -> DataFrame:
    """The feed with other titles for retired records in its first half."""
    half = payloads.agg(F.floor(F.max("feed_index") / 2)).scalar()
    other = (F.col("status") == "retired") & (F.col("feed_index") < half)
    return payloads.withColumn("title", F.when(other, "renamed").otherwise(F.col("title")))


def published_run(r, change: bool = False) -> tuple[str, DataFrame]:
    """Publish all events as a feed of lines, by a query that is started anew for each third of
    them; the sink, and the feed as it is at the end. ``change``: it is another one by then."""
    folder = f"{ensure_checkpoint_dir(r.spark)}/publishing-{uuid4().hex}"
    source, sink = f"{folder}/feed", f"{folder}/sink"
    for run in range(RUNS):
        write_lines(r, source, run)
        present = publish.sync_payload(register.read_feed(r.spark, f"{source}/*", schema=SCHEMA))
        if change and run == RUNS - 1:
            present = changed(present)
        stream = publish.sync_payload(register.read_feed(r.spark, f"{source}/*", stream=True, schema=SCHEMA))
        query = publish.publish_stream(
            stream, sink, f"{folder}/checkpoint", available_now=True, published=present if run else None
        )
        query.awaitTermination()
    return sink, present


STATE = ("feed", "next_offset", "selected", "created", "updated", "failed", "status", "batch")
FLAGS = ("invalid_offset", "invalid_fingerprint", "fingerprint_changed", "offset_regression",
         "oversize_batch", "offset_past_end", "bad_status")


def progress_sql(change: bool) -> str:
    flags = ", ".join(f"{'batch = 2' if change and c == 'fingerprint_changed' else 'false'} AS {c}" for c in FLAGS)
    return (
        f"WITH {PLAN.replace('user_id IN (SELECT doc_id FROM labels)', 'false')}, z AS (SELECT (COUNT(*) + 2) // 3 AS size FROM "
        "events), b AS (SELECT feed_index // size AS batch, MAX(feed_index) + 1 AS next_offset, COUNT(*) AS n, COUNT(*) FILTER "
        "(action = 'CREATE') AS c FROM plan, z GROUP BY 1) SELECT 'feed' AS feed, next_offset, CAST(SUM(n) OVER w AS BIGINT) AS "
        "selected, CAST(SUM(c) OVER w AS BIGINT) AS created, CAST(SUM(n - c) OVER w AS BIGINT) AS updated, CAST(0 AS BIGINT) AS "
        f"failed, 'READY_TO_RESUME' AS status, CAST(batch AS INT) AS batch, {flags} FROM b WINDOW w AS (ORDER BY batch)"
    )


def run_progress(r, change: bool = False) -> DataFrame:
    """The progress of that run, with what its audit says."""
    sink, _ = published_run(r, change)
    progress = r.spark.read.parquet(f"{sink}/progress")
    sizes = r.table("events").agg(F.lit("feed").alias("feed"), F.count("*").alias("records"))
    size = -(-r.table("events").count() // RUNS)
    told = publish.progress_violations(progress, size, ("batch",), records=sizes)
    return told.select(*STATE, *FLAGS)


def run_state(r) -> DataFrame:
    return publish.published_state(r.spark, published_run(r)[0])


def run_changes(r) -> DataFrame:
    """Where a feed that was published is another one now."""
    sink, present = published_run(r)
    return publish.changed_positions(r.spark, sink, changed(present))


def run_events(r) -> DataFrame:
    """The event log of that run."""
    events = r.spark.read.parquet(f"{published_run(r)[0]}/events")
    return events.select("entity_id", "feed_index", "action", "event", "batch")


def snapshot_changes(r) -> DataFrame:
    """Two snapshots of orders, compared by their hash trees."""
    folder = f"{ensure_checkpoint_dir(r.spark)}/snapshots-{uuid4().hex}"
    orders = r.table("orders").withColumnRenamed("o_custkey", "entity_id")
    for name, df in (("before", orders), ("after", closed(orders))):
        hashtree.write_snapshot(df, f"{folder}/{name}", order_columns(), SNAPSHOT_RANGES)
    return hashtree.snapshot_changes(r.spark, f"{folder}/before", f"{folder}/after", SNAPSHOT_RANGES)


def positions(r) -> DataFrame:
    """Positions of records in files of lines, read in small blocks."""
    source = f"{ensure_checkpoint_dir(r.spark)}/lines-{uuid4().hex}"
    for run in range(RUNS):
        write_lines(r, source, run)
    lines = register.feed_lines(r.spark, f"{source}/*")
    return register.parse_lines(register.place_lines(lines), SCHEMA).select("feed_index", "entity_id", "label", "index.alias_count")


SNAPSHOT_RANGES = 256


QUERIES = {
    "feed_slices": (
        over(lambda r: publish.feed_slices(feed(r), 250)),
        "SELECT event_id // 250 AS slice, MIN(event_id) AS first_index, MAX(event_id) AS last_index, COUNT(*) AS records FROM "
        "events GROUP BY 1",
    ),
    "feed_slice": (
        over(lambda r: publish.feed_slice(feed(r).select("feed_index", "entity_id"), 300, 450)),
        "SELECT event_id AS feed_index, user_id AS entity_id FROM events WHERE event_id BETWEEN 300 AND 749",
    ),
    "sync_payload": (
        over(lambda r: publish.sync_payload(feed(r))),
        f"WITH {PAYLOAD} SELECT * FROM payload",
    ),
    "latest_payloads": (
        over(lambda r: publish.latest_payloads(publish.sync_payload(feed(r)))),
        f"WITH {PAYLOAD} SELECT * FROM payload QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY feed_index DESC) = 1",
    ),
    "upsert_plan": (
        over(plan),
        f"WITH {PLAN} SELECT * FROM plan",
    ),
    "action_counts": (
        over(lambda r: publish.action_counts(plan(r))),
        f"WITH {PLAN} SELECT COUNT(*) AS selected, COUNT(*) FILTER (action = 'CREATE') AS created, COUNT(*) FILTER (action = "
        "'UPDATE') AS updated, COUNT(*) FILTER (action = 'FAILED') AS failed FROM plan",
    ),
    "identity_mismatches": (
        over(
            lambda r: publish.identity_mismatches(
                r.table("orders").select(F.col("o_orderkey").alias("publish_id"), F.col("o_custkey").alias("entity_id")),
                returned(r),
            )
        ),
        "SELECT * FROM (SELECT o_orderkey AS publish_id, o_custkey AS sent_id, CASE WHEN o_orderpriority = '1-URGENT' AND "
        "o_orderstatus = 'P' THEN o_custkey + 1 WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_custkey "
        "END AS returned_id FROM orders) WHERE sent_id IS DISTINCT FROM returned_id",
    ),
    "publish_progress": (over(run_progress), progress_sql(False)),
    "publish_changed_feed": (over(lambda r: run_progress(r, True)), progress_sql(True)),
    "changed_positions": (
        over(run_changes),
        "WITH c AS (SELECT event_id AS feed_index FROM events WHERE event_type = 'error' AND event_id < (SELECT MAX(event_id) // 2 "
        "FROM events)) SELECT feed_index, 'changed' AS change, (SELECT COUNT(DISTINCT feed_index // 65536) FROM c) AS ranges_read "
        "FROM c",
    ),
    "publish_events": (
        over(run_events),
        f"WITH {PLAN.replace('user_id IN (SELECT doc_id FROM labels)', 'false')} SELECT entity_id, feed_index, action, 'success' AS "
        "event, CAST(feed_index // (((SELECT COUNT(*) FROM events) + 2) // 3) AS INT) AS batch FROM plan",
    ),
    "feed_positions": (
        over(positions),
        "SELECT event_id AS feed_index, user_id AS entity_id, CASE WHEN event_type <> 'signup' THEN event_type END AS label, "
        "LENGTH(props) AS alias_count FROM events",
    ),
    "snapshot_changes": (
        over(snapshot_changes),
        "WITH t AS (SELECT o_custkey AS entity_id, o_orderkey, o_orderstatus AS status, 1 AS b, 0 AS a FROM orders UNION ALL "
        "SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey + 1 ELSE o_custkey END, o_orderkey, CASE WHEN o_orderstatus "
        "= 'P' THEN 'F' ELSE o_orderstatus END, 0, 1 FROM orders), c AS (SELECT entity_id, o_orderkey, status, SUM(b) AS b, "
        "SUM(a) AS a FROM t GROUP BY ALL), m AS (SELECT entity_id, CASE WHEN SUM(b) = 0 THEN 'added' WHEN SUM(a) = 0 THEN "
        "'removed' ELSE 'changed' END AS change, CAST('0x' || SUBSTRING(SHA256(CAST(entity_id AS VARCHAR)), 1, 8) AS BIGINT) * "
        f"{SNAPSHOT_RANGES} // 4294967296 AS leaf FROM c GROUP BY 1 HAVING BOOL_OR(a <> b)) SELECT entity_id, change, (SELECT "
        "COUNT(DISTINCT leaf) FROM m) AS ranges_read FROM m",
    ),
    "publish_state": (
        over(run_state),
        f"WITH {PAYLOAD} SELECT * FROM payload QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY feed_index DESC) = 1",
    ),
    "record_fingerprints": (
        over(
            lambda r: publish.record_fingerprints(r.table("events"), fingerprint_columns()).select(
                "event_id", "fingerprint"
            )
        ),
        f"SELECT event_id, SHA256({ROW_TEXT}) AS fingerprint FROM events",
    ),
    "feed_fingerprint": (
        over(lambda r: publish.feed_fingerprint(r.table("events"), fingerprint_columns())),
        f"WITH d AS (SELECT SHA256({ROW_TEXT}) AS d FROM events), s AS (SELECT SUBSTRING(d, 1, 2) AS b, COUNT(*) AS n, "
        + ", ".join(
            f"SUM(CAST(CONCAT('0x', SUBSTRING(d, {start}, 12)) AS BIGINT)) AS s{i}"
            for i, start in enumerate(range(1, 64, 12))
        )
        + " FROM d GROUP BY 1) SELECT CAST(SUM(n) AS BIGINT) AS records, SHA256(STRING_AGG(CONCAT_WS(':', b, n, s0, s1, s2, s3, s4, s5), "
        "'|' ORDER BY b)) AS feed_sha256 FROM s",
    ),
    "changed_records": (
        over(
            lambda r: publish.changed_records(*snapshots(r))
        ),
        "WITH t AS (SELECT o_custkey AS entity_id, o_orderkey, o_orderstatus AS status, 1 AS b, 0 AS a FROM orders UNION ALL "
        "SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey + 1 ELSE o_custkey END, o_orderkey, CASE WHEN o_orderstatus "
        "= 'P' THEN 'F' ELSE o_orderstatus END, 0, 1 FROM orders), c AS (SELECT entity_id, o_orderkey, status, SUM(b) AS b, "
        "SUM(a) AS a FROM t GROUP BY ALL) SELECT entity_id, CASE WHEN SUM(b) = 0 THEN 'added' WHEN SUM(a) = 0 THEN 'removed' ELSE "
        "'changed' END AS change FROM c GROUP BY 1 HAVING BOOL_OR(a <> b)",
    ),
    "progress_violations": (
        over(violations),
        f"WITH {HISTORY} SELECT * FROM violations",
    ),
    "recoverable_steps": (
        over(lambda r: publish.recoverable_steps(violations(r))),
        f"WITH {HISTORY} SELECT * REPLACE ('READY_TO_RESUME' AS status) FROM violations WHERE status = 'FAILED' AND NOT "
        "(invalid_offset OR invalid_fingerprint OR fingerprint_changed OR offset_regression OR oversize_batch OR offset_past_end)",
    ),
}
