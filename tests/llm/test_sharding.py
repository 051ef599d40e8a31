"""Sharding: whole groups, near equal bytes, gapless slots."""

import itertools
import random
import zlib

import pytest
from helpers import documents, with_clashes
from pyspark.sql import functions as F

from ledgerwave.llm import sharding


def best(sizes, parts):
    return min(max(sum(s for s, p in zip(sizes, ps) if p == k) for k in range(parts)) for ps in itertools.product(range(parts), repeat=len(sizes)))


@pytest.mark.parametrize("seed", range(6))
def test_differencing_is_near_the_best(seed):
    own = random.Random(seed)
    sizes = [own.randrange(1, 100) for _ in range(9)]
    parts = sharding.differencing(sizes, 3)
    largest = max(sum(s for s, p in zip(sizes, parts) if p == k) for k in range(3))
    assert largest <= best(sizes, 3) * 1.12


def test_differencing_of_a_known_case():
    # Differencing leaves 4, 5, 6, 7, 8 apart by 2.
    parts = sharding.differencing([8, 7, 6, 5, 4], 2)
    sums = [sum(s for s, p in zip([8, 7, 6, 5, 4], parts) if p == k) for k in (0, 1)]
    assert abs(sums[0] - sums[1]) == 2
    assert sharding.differencing([], 8) == [] and len(sharding.differencing([5], 8)) == 1


def test_many_levels(spark):
    """Cells and bundles; a group as large as two shards is left alone."""
    own = random.Random(1)
    rows = [(i, own.randrange(10, 1000)) for i in range(3000)] + [(9999, 400_000)]
    groups = spark.createDataFrame(rows, "item long, bytes long")
    found = {r["item"]: r["shard"] for r in sharding.assign(groups, 8, cell=100, parts=40, last=600).collect()}
    assert set(found) == {i for i, _ in rows}
    sums = [sum(b for i, b in rows if found[i] == k) for k in range(8)]
    rest = sorted(sums)[:-1]
    assert max(sums) == 400_000 and max(rest) - min(rest) < 0.03 * max(rest)


def check(rows, found):
    texts = {}
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text_crc32"]) for r in found)) == sorted(
        ((d is None, d or 0, zlib.crc32((t or "").encode())) for d, t in rows)
    )
    for r in found:
        texts.setdefault(r["text_crc32"], set()).add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in texts.values())
    for k in range(8):
        slots = sorted(r["slot"] for r in found if r["shard"] == k)
        assert slots == list(range(len(slots)))


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    found = sharding.shard_documents(docs).collect()
    check([(r["doc_id"], r["text"]) for r in docs.collect()], found)
    sums = [sum(r["size"] for r in found if r["shard"] == k) for k in range(8)]
    assert max(sums) - min(sums) <= 0.01 * max(sums)
    assert all(r["size"] >= 1 for r in found)


def test_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "a"), (4, "é" * 1000), (5, "é" * 1000)]
    docs = with_clashes(documents(spark, rows), "size", "shard", "item", "bytes", "file", "block", "row", "slot")
    found = sharding.shard_documents(docs).collect()
    check(rows, found)
    assert {r["size"] for r in found if r["doc_id"] in (4, 5)} == {2001}
    assert {r["size"] for r in found if r["doc_id"] in (2, 3)} == {1}


def test_empty_and_one_text(spark):
    assert sharding.shard_documents(documents(spark, [])).count() == 0
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    found = sharding.shard_documents(same).collect()
    check([(i, "same") for i in range(500)], found)
