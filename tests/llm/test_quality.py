"""Quality scores: held-out accuracy, odd texts, and that labels are never inputs."""

import zlib

import numpy as np
import pytest
from helpers import documents, with_clashes
from pyspark.sql import functions as F

from ledgerwave.llm import quality


@pytest.fixture(scope="module")
def scored():
    def area(rows):
        order = np.argsort([s for s, _ in rows], kind="stable")
        rank = np.empty(len(rows))
        rank[order] = np.arange(1, len(rows) + 1)
        good = np.array([q for _, q in rows]) == 1
        return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())

    return area


def test_held_out(spark, scored):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, quality.learnable(labels))
    found = quality.scored(docs, model).select("row.doc_id", "score", quality.held_out("row.doc_id").alias("out"))
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [(r["score"], known[r["doc_id"]]) for r in found.collect() if r["out"] and r["doc_id"] in known]
    assert scored(rows) > 0.95
    assert np.mean([s >= 0.7 for s, q in rows if q == 1]) > 0.97
    assert np.mean([s < 0.7 for s, q in rows if q == 0]) > 0.7


def test_held_out_labels_teach_nothing(spark):
    frame = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    kept = {r["doc_id"] for r in quality.learnable(frame).collect()}
    assert kept == {i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2}


def prose(i):
    return " ".join(f"{'the of and house garden river stone'.split()[(i * 7 + k * k) % 7]}" for k in range(60))


def junk(i):
    return " ".join(f"{'%%% ### QQ XZ &&& 19 $$$'.split()[(i * 5 + k * 3) % 7]}{k % 9}" for k in range(60))


def test_odd_rows(spark):
    rows = [(i, prose(i) if i % 3 else junk(i)) for i in range(300)]
    odd = [(1000, None), (1001, ""), (None, prose(1)), (1, prose(1)), (1002, prose(2) * 2000)]
    docs = with_clashes(documents(spark, rows + odd), "score", "row", "label", "id", "features", "quality")
    labels = spark.createDataFrame(
        [(i, 1 if i % 3 else 0) for i in range(300)] + [(None, 1), (5, None), (5, 7), (6, 1), (7777, 0)], "doc_id long, quality int"
    )
    model = quality.fit(docs, quality.learnable(labels))
    found = quality.scored(docs, model)
    assert found.select("row.*").columns == docs.columns
    of = {}
    for r in found.collect():
        of.setdefault(r["row"]["doc_id"], []).append(r["score"])
        assert 0 <= r["score"] <= 1
    assert sum(map(len, of.values())) == len(rows + odd)
    assert of[1000] == of[1001] and len(set(of[1] + of[None])) == 1
    assert np.mean([of[i][0] for i in range(300) if i % 3]) > np.mean([of[i][0] for i in range(0, 300, 3)]) + 0.3


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.scored(docs, quality.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(r["score"] > 0.9 for r in quality.scored(docs, quality.fit(docs, one)).select("score", "row.text").filter("text is not null").collect())
    assert quality.scored(documents(spark, []), quality.fit(documents(spark, []), none)).count() == 0
