import json

from pyspark.sql import functions as F

from ledgerloom.operators import slices
from ledgerloom.sources import register, sinks
from ledgerloom.streaming import publish
from tests.conftest import by, rows


def feed_rows(spark, pairs):
    return spark.createDataFrame(pairs, "feed_index long, entity_id string, label string")


def test_first_record_of_an_unknown_id_creates(spark, all_hot):
    batch = feed_rows(spark, [(0, "a", "A"), (1, "b", "B"), (2, "a", "A2"), (3, None, "x"), (4, "b", "B2")])
    known = spark.createDataFrame([("b",)], "entity_id string")
    assert by(publish.upsert_plan(batch, known), "feed_index", "action") == {
        0: "CREATE", 1: "UPDATE", 2: "UPDATE", 3: "FAILED", 4: "UPDATE",
    }
    assert by(publish.latest_payloads(batch), "entity_id", "label") == {"a": "A2", "b": "B2"}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    sink = str(tmp_path)
    publish.publish_batch(feed_rows(spark, [(0, "a", "A"), (1, "b", "B")]), 0, sink)
    second = feed_rows(spark, [(2, "b", "B2"), (3, "c", "C")])
    publish.publish_batch(second, 1, sink)
    before = rows(publish.published_state(spark, sink), "entity_id", "label")
    publish.publish_batch(second, 1, sink)
    assert rows(publish.published_state(spark, sink), "entity_id", "label") == before
    assert before == [("a", "A"), ("b", "B2"), ("c", "C")]
    progress = spark.read.parquet(f"{sink}/progress").where("batch = 1").first()
    assert (progress.selected, progress.created, progress.updated, progress.next_offset) == (4, 3, 1, 4)
    assert progress.status == "READY_TO_RESUME" and progress.last_success_at == progress.completed_at
    assert spark.read.parquet(f"{sink}/known").count() == 3


def test_positions_go_on_and_the_audit_reads_the_progress(spark, tmp_path):
    sink = str(tmp_path)
    for batch in range(3):
        records = [(f"e{(7 * batch + i) % 11}" if i else None, f"L{i}") for i in range(8)]
        df = spark.createDataFrame(records, "entity_id string, label string").repartition(4)
        publish.publish_batch(df, batch, sink)
    progress = spark.read.parquet(f"{sink}/progress")
    assert by(progress, "batch", "next_offset") == {0: 8, 1: 16, 2: 24}
    assert by(progress, "batch", "failed") == {0: 1, 1: 2, 2: 3}
    events = spark.read.parquet(f"{sink}/events")
    assert sorted(r.feed_index for r in events.collect()) == list(range(24))
    for size, past in ((24, False), (20, True)):
        sizes = spark.createDataFrame([("feed", size)], "feed string, records long")
        told = publish.progress_violations(progress, 8, ("batch",), records=sizes).orderBy("batch").collect()
        assert told[2].offset_past_end is past
        wrong = ("invalid_offset", "invalid_fingerprint", "fingerprint_changed", "offset_regression", "oversize_batch", "bad_status")
        assert not any(r[c] for r in told for c in wrong)
    assert publish.recoverable_steps(publish.progress_violations(progress, 8, ("batch",))).count() == 3


def test_cut_tables_are_deleted(spark):
    one, two = slices.cut(spark.range(3)), slices.cut(spark.range(4))
    assert one.count() == 3 and slices.folder_exists(spark, one._cut_folder)
    slices.discard(one)
    assert not slices.folder_exists(spark, one._cut_folder) and two.count() == 4
    others = [x for x in slices._written if x[1] != two._cut_folder]
    slices._written[:] = [(spark, two._cut_folder)]
    assert slices.release(spark) == 1 and not slices.folder_exists(spark, two._cut_folder)
    slices._written[:] = others


def test_stream_publishes_a_feed_and_resumes(spark, tmp_path):
    source, sink, place = (str(tmp_path / n) for n in ("feed", "sink", "checkpoint"))
    (tmp_path / "feed").mkdir()

    def add(name, *records):
        (tmp_path / "feed" / name).write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")

    def run():
        stream = publish.sync_payload(register.read_feed(spark, source, stream=True))
        query = publish.publish_stream(stream, sink, place, available_now=True)
        query.awaitTermination(120)
        assert query.exception() is None

    add("1.json", {"entity_id": "a", "label": "", "position": {"primary": "GK"}}, {"entity_id": "b", "label": "Bé"})
    run()
    add("2.json", {"entity_id": "a", "label": "A"})
    run()
    run()
    state = publish.published_state(spark, sink)
    assert by(state, "entity_id", "title") == {"a": "A", "b": "Bé"}
    events = spark.read.parquet(f"{sink}/events")
    assert by(events.groupBy("action").count(), "action", "count") == {"CREATE": 2, "UPDATE": 1}


def test_progress_audit(spark, all_hot):
    sha = "0" * 64
    steps = [(1, sha, 0, "READY_TO_RESUME"), (2, sha, 50, "FAILED"), (3, sha, 20, "FAILED"), (4, "1" * 64, 30, "RUNNING"),
             (5, "1" * 64, 900, "READY_TO_RESUME"), (6, "short", None, "FAILED")]
    history = spark.createDataFrame([("f", *s) for s in steps], "feed string, ts int, feed_sha256 string, next_offset long, status string")
    got = {r.ts: r for r in publish.progress_violations(history, 100).collect()}
    assert got[3].offset_regression and got[4].fingerprint_changed and got[4].bad_status
    assert got[5].oversize_batch and got[6].invalid_offset and got[6].invalid_fingerprint
    assert not any(got[1][c] for c in ("invalid_offset", "fingerprint_changed", "offset_regression", "bad_status"))
    assert [r.ts for r in publish.recoverable_steps(publish.progress_violations(history, 100)).collect()] == [2]


def test_fingerprint_ignores_order_and_sees_copies(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("entity_id"))
    key = [F.col("entity_id")]
    one = publish.feed_fingerprint(df, key).first()
    assert publish.feed_fingerprint(df.orderBy(F.desc("entity_id")), key).first() == one
    assert publish.feed_fingerprint(df.union(df.limit(1)), key).first() != one


def test_sinks_keep_nulls_and_refuse_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    path = str(tmp_path / "out.json")
    sinks.write_records_json(df, path)
    assert '{"a":"é","b":null}' in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out.json").glob("*.json"))
    try:
        sinks.write_records_json(df, path)
        raise AssertionError("overwrote")
    except Exception as error:
        assert "already exists" in str(error)
    sinks.write_csv(df, str(tmp_path / "csv"), ["b", "a"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["b", "a"]
    sinks.append_events(df, str(tmp_path / "log"))
    sinks.append_events(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    (tmp_path / "list.json").write_text('[{"a": "x"}, {"a": "y", "b": "z"}]')
    assert register.read_records_json(spark, str(tmp_path / "list.json"), "a string, b string").count() == 2
    report = df.agg(F.count("*").alias("n")).select(sinks.nested_report(sizes=df.agg(F.count("*").alias("rows"))).alias("r"))
    sinks.write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().r.sizes.rows == 1


def test_register_reads_describes_and_keeps_provenance(spark, tmp_path):
    people = spark.range(3).withColumnRenamed("id", "entity_id")
    root = str(tmp_path / "register")
    sinks.write_tables({"people": people}, root)
    try:
        sinks.write_tables({"people": people}, root)
        raise AssertionError("overwrote")
    except Exception as error:
        assert "already exists" in str(error)
    sinks.write_tables({"people": people}, root, mode="overwrite")
    tables = register.load_register(spark, root, ["people"], views=True)
    assert spark.sql("SELECT COUNT(*) AS n FROM people").first().n == 3
    assert rows(register.describe_tables(tables)) == [("people", "entity_id", "bigint", 0)]
    assert rows(register.catalog_profile(tables)) == [("people", "entity_id", "bigint", 0, 3)]
    assert register.sample_tables(tables, 2)["people"].count() == 2
    report = register.with_provenance(people.agg(F.count("*").alias("n")), tables["people"]).first()
    assert report.n == 3 and report.input_files >= 1 and report.input_bytes > 0 and report.generated_at


def test_slices_of_the_feed(spark):
    feed = feed_rows(spark, [(i, str(i), None) for i in range(10)])
    assert [r.feed_index for r in publish.feed_slice(feed, 4, 3).orderBy("feed_index").collect()] == [4, 5, 6]
    assert rows(publish.feed_slices(feed, 4)) == [(0, 0, 3, 4), (1, 4, 7, 4), (2, 8, 9, 2)]
    sent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "publish_id long, entity_id string")
    back = spark.createDataFrame([(1, "a"), (2, "x")], "publish_id long, entity_id string")
    assert rows(publish.identity_mismatches(sent, back)) == [(2, "b", "x"), (3, "c", None)]
