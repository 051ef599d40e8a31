"""Stored upserts: what is replaced, what readers of an older version see, and what a broken-off upsert leaves."""

import pytest
from pyspark.sql import functions as F

from ledgerwave.sources import versions

SCHEMA = "account string, place string, n long"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return versions.StoredTable(spark, str(tmp_path / "stored"), ["account"], buckets=4)


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_two_upserts(spark, table):
    with pytest.raises(LookupError):
        table.read()
    assert table.upsert(frame(spark, ("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "z", 4)), "first") == 1
    assert table.upsert(frame(spark, ("a", "x", 10), ("c", "x", 5), (None, "z", 6)), "second") == 2
    assert table.upsert(frame(spark, ("c", "y", 7)), "third") == 3
    assert rows(table.read()) == sorted(
        [("a", "x", 10, 2), ("b", "x", 3, 1), ("c", "y", 7, 3), (None, "z", 4, 1), (None, "z", 6, 2)], key=str
    )
    assert rows(table.read(1).drop("version")) == rows(
        frame(spark, ("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "z", 4))
    )


def test_the_same_batch_again_changes_nothing(spark, table):
    table.upsert(frame(spark, ("a", "x", 1)), "first")
    before = rows(table.read())
    assert table.upsert(frame(spark, ("a", "x", 99)), "first") == 1
    assert rows(table.read()) == before and len(table.log()) == 1


def test_a_reader_keeps_its_version(spark, table):
    table.upsert(frame(spark, ("a", "x", 1), ("b", "x", 2)), "first")
    reading = table.read()
    table.upsert(frame(spark, ("a", "x", 3)), "second")
    assert rows(reading) == [("a", "x", 1, 1), ("b", "x", 2, 1)]


def test_stopped_between_write_and_switch(spark, table, monkeypatch):
    table.upsert(frame(spark, ("a", "x", 1)), "first")
    with monkeypatch.context() as broken:
        broken.setattr(table, "_switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.upsert(frame(spark, ("a", "x", 2)), "second")
    assert rows(table.read()) == [("a", "x", 1, 1)]
    assert len(table.unused()) == 1
    assert table.upsert(frame(spark, ("a", "x", 2)), "second") == 2
    assert rows(table.read()) == [("a", "x", 2, 2)]


def test_of_two_writers_one_is_seen(spark, table):
    table.upsert(frame(spark, ("a", "x", 1)), "first")
    other = versions.StoredTable(spark, table.folder, ["account"], buckets=4)
    first = table._switch

    def late(*entry):
        other.upsert(frame(spark, ("a", "x", 5)), "other")
        first(*entry)

    table._switch = late
    with pytest.raises(versions.Conflict):
        table.upsert(frame(spark, ("a", "x", 2)), "second")
    assert rows(table.read()) == [("a", "x", 5, 2)]
    assert [v.batch for v in table.log()] == ["first", "other"]


def test_only_buckets_with_incoming_keys_are_written(spark, table):
    table.upsert(frame(spark, *[(f"k{i}", "x", i) for i in range(40)]), "first")
    table.upsert(frame(spark, ("k1", "y", 0)), "second")
    first, second = table.log()
    assert sum(first.buckets[b] != second.buckets[b] for b in first.buckets) == 1
    assert table.read().count() == 40


def test_a_hot_key_and_no_rows(spark, table):
    table.upsert(frame(spark).limit(0), "nothing")
    assert table.read().count() == 0
    table.upsert(spark.range(500).select(F.lit("hot").alias("account"), F.lit("x").alias("place"), F.col("id").alias("n")), "hot")
    table.upsert(frame(spark, ("cold", "x", 1)), "cold")
    assert table.read().groupBy("account").count().filter("account = 'hot'").first()["count"] == 500
    table.upsert(frame(spark, ("hot", "y", 1)), "replaced")
    assert rows(table.read()) == [("cold", "x", 1, 3), ("hot", "y", 1, 4)]
