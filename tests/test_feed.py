"""Positions of feed lines, known ids as state, hash trees, and feeds that change."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import register
from ledgerloom.streaming import hashtree, known, publish
from tests.conftest import rows


def add_file(folder, number, text):
    """Files of a feed come in the order of their names."""
    path = folder / f"{number:03}.json"
    path.write_text(text, encoding="utf-8")
    os.utime(path, (1_700_000_000 + number,) * 2)


def write_feed(folder, files, seed=1, per_file=8):
    """Files of lines with blank ones, records without an id and a common id."""
    rng = random.Random(seed)
    folder.mkdir(exist_ok=True)
    want, at = [], 0
    for f in range(files):
        lines = []
        for _ in range(per_file):
            kind = rng.random()
            record = {"entity_id": None if kind < 0.1 else "hot" if kind < 0.4 else f"e{rng.randrange(30)}", "label": f"é{at}"}
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "  "]))
                at += 1
            lines.append(json.dumps(record, ensure_ascii=False))
            want.append((at, record["entity_id"], record["label"]))
            at += 1
        add_file(folder, f, "\n".join(lines) + "\n")
    return want


def test_positions_do_not_hang_on_blocks(spark, tmp_path):
    want = write_feed(tmp_path / "feed", 5, per_file=40)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("100", "333", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            feed = register.read_feed(spark, str(tmp_path / "feed"))
            assert rows(feed, "feed_index", "entity_id", "label") == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_that_are_no_records_fail(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"entity_id": "a"}\n{"entity_id": \n', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        register.read_feed(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "empty.json").write_text("\n \n", encoding="utf-8")
    assert register.read_feed(spark, str(tmp_path / "empty.json")).count() == 0


def run(spark, source, folder, files, published=None):
    """Publish what lies in ``source``, so many files a batch; what the batches looked up."""
    stream = publish.sync_payload(register.read_feed(spark, str(source), stream=True, maxFilesPerTrigger=files))
    query = publish.publish_stream(
        stream, f"{folder}/sink", f"{folder}/checkpoint", available_now=True, published=published
    )
    query.awaitTermination(300)
    assert query.exception() is None
    return [p.stateOperators[0].customMetrics["rocksdbGetCount"] for p in query.recentProgress if p.numInputRows]


def test_batches_of_any_size_publish_the_same(spark, tmp_path):
    """One, two and eight batches; each looks up its own ids only."""
    want = write_feed(tmp_path / "feed", 8)
    seen = {}
    for files in (8, 4, 1):
        folder = tmp_path / f"by{files}"
        looked_up = run(spark, tmp_path / "feed", folder, files)
        assert len(looked_up) == 8 // files
        progress = spark.read.parquet(f"{folder}/sink/progress").orderBy("batch").collect()
        events = spark.read.parquet(f"{folder}/sink/events")
        assert sorted(r.feed_index for r in events.collect()) == [at for at, *_ in want]
        per_batch = {r.batch: r.n for r in events.groupBy("batch").agg(F.count_distinct("entity_id").alias("n")).collect()}
        # a look at each id of the batch and one to add it, whatever is known already
        assert all(n <= 2 * per_batch[b] for b, n in enumerate(looked_up))
        last = progress[-1]
        state = rows(publish.published_state(spark, f"{folder}/sink"), "entity_id", "title", "feed_index")
        seen[files] = state, last.published_sha256, last.next_offset, last.created, last.updated, last.failed
        assert len({r.feed_sha256 for r in progress}) == 1
        created = events.where("action = 'CREATE'").groupBy("entity_id").count().where("count > 1")
        assert created.isEmpty()
    assert seen[8] == seen[4] == seen[1]
    newest = {}
    for at, entity, label in want:
        if entity:
            newest[entity] = (entity, label, at)
    assert seen[1][0] == sorted(newest.values(), key=str)


def test_files_that_come_too_late_are_refused(spark, tmp_path):
    write_feed(tmp_path / "feed", 2)
    lines = register.read_feed(spark, str(tmp_path / "feed"))
    for batch, name in enumerate(("001", "000")):
        df = lines.where(F.col("source_file").endswith(f"{name}.json")).drop("feed_index")
        df = df.withColumn("block", F.lit(0)).withColumn("line", F.monotonically_increasing_id()).withColumn("blank", F.lit(False))
        if batch:
            with pytest.raises(ValueError, match="order of their names"):
                publish.publish_batch(df, batch, f"{tmp_path}/sink")
        else:
            publish.publish_batch(df, batch, f"{tmp_path}/sink")


def test_a_feed_that_changed_is_found_out(spark, tmp_path):
    source = tmp_path / "feed"
    write_feed(source, 3)

    def present():
        return publish.sync_payload(register.read_feed(spark, str(source)))

    run(spark, source, tmp_path, 10)
    assert publish.changed_positions(spark, f"{tmp_path}/sink", present()).isEmpty()
    add_file(source, 3, '{"entity_id": "new", "label": "x"}\n')
    run(spark, source, tmp_path, 10, present())
    other = present().withColumn("title", F.when(F.col("feed_index") == 2, "other").otherwise(F.col("title")))
    other = other.where("feed_index <> 3")
    add_file(source, 4, '{"entity_id": "newer", "label": "y"}\n')
    run(spark, source, tmp_path, 10, other)
    progress = spark.read.parquet(f"{tmp_path}/sink/progress")
    told = publish.progress_violations(progress, 100, ("batch",)).orderBy("batch").collect()
    assert [r.fingerprint_changed for r in told] == [False, False, True]
    assert not any(r.invalid_fingerprint or r.offset_regression for r in told)
    held = {r.feed_index for r in present().collect()}
    changes = rows(publish.changed_positions(spark, f"{tmp_path}/sink", other.where("feed_index < 20")), "feed_index", "change")
    published = spark.read.parquet(f"{tmp_path}/sink/progress").agg(F.max("next_offset")).first()[0]
    gone = {(at, "removed") for at in held if at >= 20 and at < published} | ({(3, "removed")} & {(at, "removed") for at in held})
    assert set(changes) == gone | ({(2, "changed")} & {(at, "changed") for at in held})


def test_batches_without_state_read_the_known_ids(spark, tmp_path):
    """Plain batches and streams agree on what is created."""
    sink = str(tmp_path)
    for batch in range(2):
        df = spark.createDataFrame([(f"e{i}", str(batch)) for i in range(3 + batch)], "entity_id string, label string")
        publish.publish_batch(df, batch, sink)
    last = spark.read.parquet(f"{sink}/progress").where("batch = 1").first()
    assert (last.created, last.updated, last.next_offset) == (4, 3, 7)
    assert last.published_sha256 != last.feed_sha256


def snapshot(spark, data, folder):
    df = spark.createDataFrame(data, "entity_id string, label string")
    hashtree.write_snapshot(df, folder, [F.col("entity_id"), F.col("label")], ranges=64)
    return df


@pytest.mark.parametrize("moved", [0, 1, 5, 300])
def test_snapshots_are_compared_by_their_trees(spark, tmp_path, moved):
    before = [(f"e{i % 280}", f"l{i}") for i in range(300)] + [(None, "x"), (None, "x")]
    after = [(e, f"{l}!" if i < moved else l) for i, (e, l) in enumerate(before)] + [("added", "a")] * (moved > 1)
    one, two = (snapshot(spark, data, str(tmp_path / name)) for name, data in (("b", before), ("a", after)))
    key = [F.col("entity_id"), F.col("label")]
    got = hashtree.snapshot_changes(spark, str(tmp_path / "b"), str(tmp_path / "a"), ranges=64).collect()
    want = publish.changed_records(*[df.withColumn("fingerprint", hashtree.record_digest(key)) for df in (one, two)])
    assert sorted((r.entity_id, r.change) for r in got) == sorted((r.entity_id, r.change) for r in want.collect())
    ranges = {r.leaf for df in (one, two) for r in df.join(want, "entity_id", "left_semi").select(hashtree.id_range(64).alias("leaf")).collect()}
    assert {r.ranges_read for r in got} <= {len(ranges)}
    roots = [hashtree.root_sha256(spark.read.parquet(f"{tmp_path}/{n}/tree")).first() for n in "ba"]
    assert (roots[0] == roots[1]) == (moved == 0)


def test_only_folders_of_ranges_that_differ_are_read(spark, tmp_path):
    before = [(f"e{i}", "l") for i in range(500)]
    snapshot(spark, before, str(tmp_path / "b"))
    snapshot(spark, [*before[:-1], ("e499", "other")], str(tmp_path / "a"))
    changes = hashtree.snapshot_changes(spark, str(tmp_path / "b"), str(tmp_path / "a"), ranges=64)
    assert [(r.entity_id, r.change, r.ranges_read) for r in changes.collect()] == [("e499", "changed", 1)]
    assert "dynamicpruning" in changes._jdf.queryExecution().executedPlan().toString()


def test_trees_of_ranges_add_up(spark):
    df = spark.range(1000).withColumn("d", F.sha2(F.col("id").cast("string"), 256))
    whole = hashtree.leaves(df, F.col("id") / 10, F.col("d"))
    parts = [hashtree.leaves(df.where(f"id % 3 = {k}"), F.col("id") / 10, F.col("d")) for k in range(3)]
    summed = hashtree.added(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert hashtree.root_sha256(whole).first() == hashtree.root_sha256(summed).first()
    assert hashtree.differing(whole, summed, 100).isEmpty()
    less = hashtree.leaves(df.where("id NOT IN (5, 777)"), F.col("id") / 10, F.col("d"))
    assert sorted(r.leaf for r in hashtree.differing(whole, less, 100).collect()) == [0, 77]
    none = whole.where("false")
    assert hashtree.differing(none, whole, 100).count() == 100 and hashtree.root_sha256(none).first().records == 0


def test_records_do_not_pass_through_the_state(spark, tmp_path):
    """Records go on beside the counts of their ids, which the map tasks fold first."""
    write_feed(tmp_path / "feed", 4, per_file=40)
    run(spark, tmp_path / "feed", tmp_path, 2)
    stream = publish.sync_payload(register.read_feed(spark, str(tmp_path / "feed"), stream=True))
    told = known.with_told(stream)
    plan = told._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Union" in plan and "Aggregate" in plan
    events = spark.read.parquet(f"{tmp_path}/sink/events").where("entity_id = 'hot'").orderBy("feed_index").collect()
    assert [r.action for r in events] == ["CREATE"] + ["UPDATE"] * (len(events) - 1)


def test_fingerprints_are_those_of_to_json(spark):
    """Fields that are put together by hand, and sums of halves, give what they always gave."""
    texts = ["", "a", None, 'q"', "b\\", "é", "\n", "a\n", "\x7f", "~ !", " ", "😀", "\x1f", "z[]^"]
    df = spark.createDataFrame([(i, t, i if i % 3 else None, i % 2 == 0, i / 7) for i, t in enumerate(texts)],
                               "feed_index long, t string, n int, b boolean, d double")
    old = hashtree.record_digest([F.col("feed_index"), *[F.to_json(F.struct(c)) for c in "bdnt"]])
    assert df.where(old != publish._fingerprint(df, "feed_index")).isEmpty()
    digests = df.select("feed_index", old.alias("x"))
    got = hashtree.leaves(digests, F.col("feed_index") / 5, F.col("x")).orderBy("leaf").collect()
    want = {}
    for r in digests.collect():
        sums = want.setdefault(r.feed_index // 5, [0] * 6)
        for i in range(6):
            sums[i] += int(r.x[12 * i : 12 * i + 12], 16)
    assert [[int(r[s]) for s in hashtree.SUMS] for r in got] == [want[r.leaf] for r in got]


def test_lines_get_their_places_without_being_moved(spark, tmp_path):
    write_feed(tmp_path / "feed", 3)
    placed = register.place_lines(register.feed_lines(spark, str(tmp_path / "feed")))
    assert "SortMergeJoin" not in placed._jdf.queryExecution().executedPlan().toString()
