import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.operators import collide, listing, skew, slices
from tests.conftest import rows


@pytest.fixture
def skewed(spark):
    """A key with 40 percent of the rows, of which many are copies, and NULL keys."""
    key = (
        F.when(F.col("id") < 400, 1)
        .when(F.col("id") < 600, F.lit(None))
        .otherwise(F.col("id") % 50)
    )
    return spark.range(1000).select(key.cast("long").alias("k"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(spark, skewed, all_hot, how, distinct):
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert skew.measure_hot(skew.key_counts(skewed, ["k"]), ["k"])
    got = skew.lookup_join(skewed, lookup, "k", how, distinct=distinct)
    assert rows(got) == rows(skewed.join(lookup, "k", how))


def test_hot_keys_are_fewer_than_partitions(spark, skewed):
    hot = skew.measure_hot(skew.key_counts(skewed, ["k"]), ["k"])
    assert 0 < len(hot) < skew.partitions(skewed) and max(hot.values()) >= 2


def test_no_hot_key_is_a_plain_join(spark):
    even = spark.range(1000).select((F.col("id") % 50).alias("k"))
    lookup = spark.range(40).withColumnRenamed("id", "k")
    plan = skew.lookup_join(even, lookup, "k", "left_semi")._jdf.queryExecution().toString()
    assert "_hot_slice" not in plan and "Union" not in plan


def test_key_types_must_agree(spark, skewed):
    with pytest.raises(TypeError):
        skew.lookup_join(skewed, spark.range(3).selectExpr("CAST(id AS int) AS k"), "k")


def test_numbers_follow_the_order(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), F.lpad("id", 4, "0")).alias("name"))
    got = slices.number_rows(df, ["name"])
    assert [r.name for r in got.orderBy("group_id").collect()] == sorted(r.name for r in df.collect())
    assert sorted(r.group_id for r in got.collect()) == list(range(1, 501))


def test_previous_row_across_slices(spark, all_hot):
    df = spark.range(600).select(
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 5)).alias("feed"), "id"
    )
    got = slices.with_previous(df, "feed", ["id"], ["id"])
    want = df.withColumn("previous_id", F.lag("id").over(Window.partitionBy("feed").orderBy("id")))
    assert rows(got) == rows(want)


def test_members_come_one_per_row(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (None, "c")], "k int, v string")
    assert rows(listing.member_values(df, ["k"], "v")) == [(1, "a"), (1, "b"), (None, "c")]
    records = listing.member_records(df.withColumn("w", F.lit(None).cast("string")), ["k"], "v", ["w"])
    assert rows(records.where("k = 1")) == [(1, "a", "NULL", 1), (1, "b", "NULL", 2), (1, None, "NULL", 1)]


def test_distribution_text(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None)], "k int, v string")
    assert listing.value_counts_text(df, ["k"], ["v"]).first().v_counts == "<NULL>=1; a=1; b=2"


def test_hot_keys_are_found_by_their_buckets(spark, skewed, monkeypatch):
    """As by a count of every key, also if all keys share a few buckets; no key need be hot."""
    want = skew.measure_hot(skew.key_counts(skewed, ["k"]), ["k"])
    assert len(want) == 1
    for buckets in (1, 3, 1 << 16):
        monkeypatch.setattr(skew, "BUCKETS", buckets)
        assert skew.hot_of_rows(skewed, ["k"]) == want
    assert skew.hot_of_rows(spark.range(1000), ["id"]) == {} == skew.hot_of_rows(spark.range(0), ["id"])


def test_texts_of_several_attributes(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "y"), (1, None, "y"), (2, None, None)], "k long, v string, w string")
    got = listing.value_counts_text(df, ["k"], ["v", "w"], None, n_rows="n", sizes={"v": "s"})
    assert rows(got, "k", "v_counts", "w_counts", "n", "s") == [(1, "a=2", "y=2", 3, 1), (2, "", "", 1, 0)]
    got = listing.value_counts_text(df, ["k"], ["v", "w"], "-")
    assert rows(got) == [(1, "-=1; a=2", "-=1; y=2"), (2, "-=1", "-=1")]


def test_entities_in_collisions_without_a_join(spark):
    """Copies, NULL ids and NULL keys; entities with own and shared keys."""
    data = [("p", "x", 1), ("p", "x", 1), ("p", "x", 2), ("p", "y", 3), ("q", "x", 3), (None, "x", 4), (None, "x", 5),
            ("q", "z", None), ("q", "z", 6), ("q", "w", None), ("q", "y", 2)]
    df = spark.createDataFrame(data, "a string, b string, entity_id long")
    totals = collide.collision_totals(df, ["a", "b"])
    assert rows(totals) == [(7, 3, 6, 3)]
    assert "Join" not in collide.colliding_entities(df.distinct(), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert rows(collide.shared_keys(df, ["a", "b"])) == rows(
        df.distinct().groupBy("a", "b").count().where("count > 1").select("a", "b")
    )
