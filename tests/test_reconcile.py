"""Differences of tables by sketches, against EXCEPT ALL."""

import random
from collections import Counter

import pytest

from ledgerloom.plans import reconcile

SCHEMA = "entity_id string, label string, n bigint, x double"


def table(number, seed=1):
    rng = random.Random(seed)
    rows = [(f"e{rng.randrange(number)}", rng.choice(["a", "", None, "é\u001f"]), rng.choice([None, 2**62, i]), rng.choice([0.1, None, -0.5])) for i in range(number)]
    return rows + rows[: number // 10] + [(None, None, None, None)] * 3


def want(before, after):
    a, b = Counter(before), Counter(after)
    return sorted([(*r, "lost", n) for r, n in (a - b).items()] + [(*r, "added", n) for r, n in (b - a).items()], key=str)


@pytest.mark.parametrize("share", [0, 0.003, 0.05, 0.5])
def test_differences_equal_except_all(spark, monkeypatch, share):
    """From no difference to half of all rows; the last ones outgrow the sketches."""
    monkeypatch.setattr(reconcile, "MOST", 2048)
    rng = random.Random(int(share * 1000))
    before = table(1500)
    after = [r if rng.random() >= share else (r[0], "changed", r[2], r[3]) for r in before if rng.random() >= share / 3]
    after += rng.sample(before, int(share * 200))
    rng.shuffle(after)
    one, two = (spark.createDataFrame(rows, SCHEMA) for rows in (before, after))
    got = reconcile.lost_and_added(one, two.select("x", "n", "label", "entity_id"), cells=256)
    assert sorted(map(tuple, got.collect()), key=str) == want(before, after)
    exact = reconcile.counted(one, two)
    assert sorted(map(tuple, exact.collect()), key=str) == want(before, after)


def test_sketches_peel_to_what_differs_or_stall(spark):
    before = spark.createDataFrame([(f"e{i}",) for i in range(3000)] + [("twice",)] * 5, "entity_id string")
    after = before.where("entity_id NOT IN ('e1', 'e77')").union(spark.createDataFrame([("new",), ("new",)], "entity_id string"))
    found = reconcile.peel(reconcile._difference(before, after, 256), 256)
    assert sorted(found.values()) == [-2, 1, 1]
    assert reconcile.peel(reconcile._difference(before, before.where("entity_id = 'x'"), 256), 256) is None
    assert reconcile.peel(reconcile._difference(before, before, 256), 256) == {}


def test_nothing_but_cells_is_shuffled(spark):
    df = spark.createDataFrame(table(50), SCHEMA)
    plan = reconcile.sketch(df, 256)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame(table(5), SCHEMA)
    assert reconcile.lost_and_added(none, none).count() == 0
    assert {r.change for r in reconcile.lost_and_added(none, one).collect()} == {"added"}
    with pytest.raises(ValueError, match="other columns"):
        reconcile.lost_and_added(none, one.drop("x"))
