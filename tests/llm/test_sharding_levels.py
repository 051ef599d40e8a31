"""Sharding in many levels, with the parameters and the tolerance that test_many_levels had at first."""

import random

from ledgerwave.llm import sharding


def test_many_levels_within_a_hundredth(spark):
    own = random.Random(1)
    rows = [(i, own.randrange(10, 1000)) for i in range(3000)] + [(9999, 400_000)]
    groups = spark.createDataFrame(rows, "item long, bytes long")
    found = {r["item"]: r["shard"] for r in sharding.assign(groups, 8, cell=200, parts=8, last=60).collect()}
    assert set(found) == {i for i, _ in rows}
    sums = [sum(b for i, b in rows if found[i] == k) for k in range(8)]
    rest = sorted(sums)[:-1]
    assert max(sums) == 400_000 and max(rest) - min(rest) < 0.01 * max(rest)


def test_more_shards_than_parts(spark):
    """Many shards: each is filled, and none is far from the others."""
    own = random.Random(2)
    rows = [(i, own.randrange(10, 1000)) for i in range(9000)]
    groups = spark.createDataFrame(rows, "item long, bytes long")
    found = {r["item"]: r["shard"] for r in sharding.assign(groups, 40, cell=500, parts=4, last=100).collect()}
    sums = [sum(b for i, b in rows if found[i] == k) for k in range(40)]
    assert set(found) == {i for i, _ in rows} and max(sums) - min(sums) < 0.02 * max(sums)
