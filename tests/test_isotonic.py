"""The isotonic fit, pooled over ranges, against pooling in one go and against the minimax formula."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import isotonic


def by_formula(points):
    """For each point: the greatest over all starts of the least over all ends of the mean between them."""
    values = []
    for i in range(len(points)):
        def mean(a, b):
            return sum(w * y for _, w, y in points[a : b + 1]) / sum(w for _, w, _ in points[a : b + 1])

        values.append(max(min(mean(a, b) for b in range(i, len(points))) for a in range(i + 1)))
    return values


def fitted(spark, points, most):
    frame = spark.createDataFrame([(x, w, w * y) for x, w, y in points], "score double, weight double, total double")
    blocks = isotonic.pooled_blocks(frame, most).orderBy("low").collect()
    return [b["total"] / b["weight"] for x, _, _ in points for b in blocks if b["low"] <= x <= b["high"]], blocks


SHAPES = {
    "noise": lambda i, r: float(r.random() < i / 60),
    "rising": lambda i, r: float(i),
    "falling": lambda i, r: float(-i),
    "level": lambda i, r: 0.5,
    "saw": lambda i, r: float(i % 7),
    "two hills": lambda i, r: float(abs(30 - i)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_ranges_give_what_one_range_gives(spark, shape):
    rng = random.Random(4)
    points = [(i / 10, rng.choice([1.0, 2.0, 5.0]), SHAPES[shape](i, rng)) for i in range(60)]
    want = by_formula(points)
    for most in (1000, 25, 4):
        values, blocks = fitted(spark, points, most)
        assert values == pytest.approx(want)
        assert sum(b["weight"] for b in blocks) == pytest.approx(sum(w for _, w, _ in points))


def test_map_pools_equal_scores_and_draws_lines(spark):
    rows = [(0.1, 0), (0.1, 0), (0.2, 1), (0.3, 0), (0.3, 0), (0.7, 1), (0.7, 1), (None, 1), (0.4, None)]
    frame = spark.createDataFrame(rows, "score double, label int")
    model = isotonic.isotonic_map(frame)
    asked = spark.createDataFrame([(s,) for s in (0.0, 0.1, 0.15, 0.2, 0.3, 0.5, 0.7, 1.0)], "score double")
    got = [r["calibrated"] for r in model.transform(asked).orderBy("score").collect()]
    third = 1 / 3
    assert got == pytest.approx([0, 0, third / 2, third, third, (third + 1) / 2, 1, 1])


def test_map_is_that_of_mllib(spark):
    from pyspark.ml.regression import IsotonicRegression

    rng = np.random.default_rng(8)
    rows = [(float(s), int(rng.random() < s)) for s in np.round(rng.random(3000), 3)]
    frame = spark.createDataFrame(rows, "score double, label int")
    weighted = IsotonicRegression(featuresCol="score", labelCol="label", weightCol="n", predictionCol="plain").fit(
        frame.groupBy("score").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("n"))
    )
    ours = isotonic.isotonic_map(frame, most=100)
    both = weighted.transform(ours.transform(frame))
    assert both.filter("abs(plain - calibrated) > 1e-9").count() == 0


def test_no_points(spark):
    empty = spark.createDataFrame([], "score double, weight double, total double")
    assert isotonic.pooled_blocks(empty).count() == 0
