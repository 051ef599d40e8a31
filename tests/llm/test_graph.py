"""Links and components against brute force."""

import random

import pytest
from helpers import grouped
from pyspark.sql import functions as F

from ledgerwave.llm import graph


def test_components(spark):
    own = random.Random(3)
    edges = [(own.randrange(300), own.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long"))
    truth = grouped(edges, {x for e in edges for x in e})
    tied = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["id"]: r["component"] for r in found.collect()} == {i: truth[i] for i in tied}


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("spread", [4.0, 40.0])
def test_links_tie_what_all_pairs_would(spark, spread):
    """Points on a line under their distance, in one large bucket and several small ones."""
    own = random.Random(int(spread))
    at = {i: own.random() * spread for i in range(120)}
    buckets = [(0, i) for i in range(90)] + [(b, own.randrange(120)) for b in range(1, 30) for _ in range(4)]
    points = spark.createDataFrame(list(at.items()), "id long, x double")
    asked = []

    def measure(pairs):
        asked.append(pairs.count())
        a, b = points.withColumnsRenamed({"id": "a", "x": "xa"}), points.withColumnsRenamed({"id": "b", "x": "xb"})
        return pairs.join(a, "a").join(b, "b").select("a", "b", F.abs(F.col("xa") - F.col("xb")).alias("d")).filter("d <= 2")

    members = spark.createDataFrame(buckets, "bucket long, id long").distinct()
    found = [(r["a"], r["b"]) for r in graph.links(members, measure).collect()]
    assert all(abs(at[a] - at[b]) <= 1 for a, b in found)
    of = {}
    for bucket, i in buckets:
        of.setdefault(bucket, set()).add(i)
    every = {(a, b) for s in of.values() for a in s for b in s if a < b and abs(at[a] - at[b]) <= 1}
    # A link outside the buckets is true as well, and may tie more.
    truth, tied = grouped(every, at), grouped(found, at)
    assert all(tied[a] == tied[b] for a, b in every)
    assert all(truth[a] == truth[b] or (a, b) not in every for a, b in found)


def test_one_group_of_copies_costs_one_distance_each(spark):
    members = spark.range(3000).select(F.lit(1).cast("long").alias("bucket"), "id")
    asked = []

    def measure(pairs):
        asked.append(pairs.count())
        return pairs.withColumn("d", F.lit(0.1))

    assert graph.links(members, measure).count() == 2999
    assert asked == [2999]


@pytest.mark.parametrize("spread", [4.0, 40.0])
def test_tied_is_what_all_pairs_of_buckets_tie(spark, spread):
    """Points on a line, a large bucket and several small ones; the marks tell half of the truth, ``verify`` the rest."""
    own = random.Random(int(spread))
    at = {i: own.random() * spread for i in range(150)}
    buckets = {(0, i) for i in range(110)} | {(b, own.randrange(150)) for b in range(1, 30) for _ in range(4)}
    members = spark.createDataFrame([(b, i, at[i]) for b, i in buckets], "bucket long, id long, mark double")
    linked = lambda a, b: abs(at[a] - at[b]) <= 0.3 and (a + b) % 3 > 0
    found = graph.tied(members, lambda a, b: F.abs(a - b) <= 0.3, lambda pairs: pairs.filter((F.col("a") + F.col("b")) % 3 > 0))
    of = {}
    for bucket, i in buckets:
        of.setdefault(bucket, set()).add(i)
    every = {(a, b) for s in of.values() for a in s for b in s if a < b and linked(a, b)}
    truth = grouped(every, {x for pair in every for x in pair})
    assert {r["id"]: r["component"] for r in found.collect()} == truth


def test_tied_makes_few_pairs_of_a_group_of_copies(spark):
    members = spark.range(3000).select(F.lit(1).cast("long").alias("bucket"), "id", F.lit(0).alias("mark"))
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs

    found = graph.tied(members, lambda a, b: a == b, verify)
    assert found.count() == 3000 and found.select("component").distinct().count() == 1
    assert asked == [sum(3000 - i - 1 for i in range(graph.LEADERS))]


def test_one_leader_at_first_asks_one_pair_of_each_copy(spark):
    members = spark.range(3000).select(F.lit(1).cast("long").alias("bucket"), "id", F.lit(0).alias("mark"))
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs

    found = graph.tied(members, lambda a, b: a == b, verify, (1, 16))
    assert found.count() == 3000 and found.select("component").distinct().count() == 1
    assert asked == [2999]


@pytest.mark.parametrize("rounds", [(1, 4), (2, 2, 2)])
def test_tied_in_rounds_is_what_all_pairs_tie(spark, rounds):
    own = random.Random(17)
    at = {i: own.random() * 30 for i in range(120)}
    buckets = {(0, i) for i in range(90)} | {(b, own.randrange(120)) for b in range(1, 20) for _ in range(6)}
    members = spark.createDataFrame([(b, i, at[i]) for b, i in buckets], "bucket long, id long, mark double")
    found = graph.tied(members, lambda a, b: F.abs(a - b) <= 0.3, lambda pairs: pairs, rounds)
    of = {}
    for bucket, i in buckets:
        of.setdefault(bucket, set()).add(i)
    every = {(a, b) for s in of.values() for a in s for b in s if a < b and abs(at[a] - at[b]) <= 0.3}
    assert {r["id"]: r["component"] for r in found.collect()} == grouped(every, {x for pair in every for x in pair})
