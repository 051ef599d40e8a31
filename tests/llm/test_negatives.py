"""Hard negatives against inner products of Python's own integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwave.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, keep=10, shares=(30, 90)):
    fit = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        fit.append((key, [math.floor(256 * float(x)) for x in vector], label))

    def order(found):
        return sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))

    result = []
    for key, vector, label in fit:
        if key is None or key % every:
            continue
        scores = [(sum(a * b for a, b in zip(vector, v)), k, c) for k, v, c in fit]
        for score, positive, _ in order([s for s in scores if s[2] == label and s[1] != key])[:positives]:
            near = [s for s in scores if s[2] != label and shares[0] * score <= 100 * s[0] <= shares[1] * score]
            result += [(key, positive, i + 1, n, score, s) for i, (s, n, _) in enumerate(order(near)[:keep])]
    return ordered(result)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def vectors(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_whole_table(spark, sample_dir):
    frame = spark.read.parquet(f"{sample_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    want = brute(rows, 20)
    assert len(want) > 100
    assert ordered(negatives.mine(frame, every=20).collect()) == want
    # Several broadcasts give what one gives.
    assert ordered(negatives.mine(frame, every=20, chunk=3).collect()) == want


def test_hot_label_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        vector = [float(x) for x in np.round(rng.random(11) * 2, 1)]
        rows.append((i, vector, 0 if i % 2 else int(rng.integers(0, 4))))
    assert ordered(negatives.mine(vectors(spark, rows), every=50).collect()) == brute(rows, 50)
    assert ordered(negatives.mine(vectors(spark, rows), every=3, positives=2, negatives=3, shares=(50, 100)).collect()) == brute(
        rows, 3, 2, 3, (50, 100)
    )


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5, 0.25], 1), (0, [1.0, 0.5, 0.25], 1), (1, [1.0, 0.5, 0.25], 1), (2, [0.5, 0.5, 0.5], 2),
        (3, [0.5, 0.5, 0.5], 2), (3, [0.5, 0.5, 0.5], 2), (4, None, 1), (5, [1.0, None, 1.0], 1), (6, [nan, 1.0, 1.0], 2),
        (8, [1.0, inf, 1.0], 1), (9, [1.0, 1.0, 1.0], None), (None, [0.5, 0.5, 0.5], 2), (None, [0.9, 0.5, 0.5], 1),
        (10, [0.5, 0.5], 2), (11, [0.5] * 20, 2), (12, [], 2), (13, [0.9, -0.001, 0.3], 1), (100, [-1.0, -0.5, 0.1], 2),
        (200, [300.0, -2000.5, 0.1], 3), (14, [2000.0, 2.5, 0.1], 3), (300, [], 4), (15, [], 4), (400, [7.0], 99),
    ]
    frame = vectors(spark, rows)
    for name in ("list", "id", "score", "place", "planes", "anchor_id", "rank", "vector"):
        frame = frame.withColumn(name, F.lit(f"own {name}"))
    found = negatives.mine(frame)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert ordered(found.collect()) == brute(rows)


def test_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=9) * 10.0 ** (i % 7)], i % 3) for i in range(120)]
    schema = SCHEMA.replace("float", "double")
    assert ordered(negatives.mine(vectors(spark, rows, schema), every=10).collect()) == brute(rows, 10)
    with pytest.raises(Exception, match="64 bits"):
        negatives.mine(vectors(spark, [(0, [1e9], 1)], schema)).collect()


def test_empty(spark):
    assert negatives.mine(vectors(spark, [])).count() == 0
    assert negatives.mine(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0


def test_planes_hold_the_integers():
    rng = np.random.default_rng(7)
    for bits in (1, 2, 9, 20, 40):
        whole = rng.integers(-(1 << bits), 1 << bits, (50, 13))
        back = negatives.from_planes(negatives.to_planes(whole))
        assert (back[:, :13] == whole).all() and not back[:, 13:].any()
        left, right = whole[:20], whole[20:]
        scores = negatives.Tables(left).scores(negatives.to_planes(right))
        assert (scores.T == left.astype(object) @ right.T.astype(object)).all() or bits == 40
