"""Alias groups whose entities share an external id: light and heavy entities against brute force."""

import random
from collections import defaultdict

import pytest

from ledgerloom.operators import aliases
from tests.conftest import rows


def want(named, held):
    ids = defaultdict(set)
    for entity, provider, external in held:
        if external is not None and entity is not None:
            ids[entity].add((provider or "", external))
    groups = defaultdict(set)
    for entity, alias in named:
        groups[alias].add(entity)
    return sorted(
        (a, True) for a, es in groups.items() if len(es) > 1 and any(ids[x] & ids[y] for x in es for y in es if x is not y and x != y)
    )


@pytest.mark.parametrize("light, heavy", [(1024, 1024), (0, 1024), (0, 2), (40, 70), (0, 70)])
def test_heavy_entities_are_bits(spark, monkeypatch, light, heavy):
    monkeypatch.setattr(aliases, "LIGHT", light)
    monkeypatch.setattr(aliases, "HEAVY", heavy)
    rng = random.Random(light + heavy)
    entities = [f"e{i}" for i in range(90)]
    pick = lambda: "e0" if rng.random() < 0.4 else "e1" if rng.random() < 0.3 else rng.choice(entities)
    named = sorted({(pick(), f"a{rng.randrange(120)}") for _ in range(420)})
    held = sorted({(pick(), rng.choice(["p", "q", ""]), f"x{rng.randrange(90)}") for _ in range(300)}) + [(None, "p", "x1"), ("e2", "p", None)]
    members = spark.createDataFrame(named, "entity_id string, normalized_alias string")
    xids = spark.createDataFrame(held, "entity_id string, provider string, external_id string")
    got = rows(aliases._held_in_common(members, xids))
    assert got == want(named, held) and got
