"""The rising step function nearest to scored outcomes, pooled over ranges of scores."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.session import fresh_path

# What a task runs travels to it with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Blocks that one task pools at most, as a rule: a range is cut where it would have more.
MOST = 100_000

BLOCK = "part int, low double, high double, weight double, total double"


def _falls(before, after) -> bool:
    """Whether a (total, weight) has no higher mean than the one before."""
    return before[0] * after[1] >= after[0] * before[1]


def pooled_neighbours(low: np.ndarray, high: np.ndarray, weight: np.ndarray, total: np.ndarray) -> list[np.ndarray]:
    """Blocks in the order of their scores, neighbours pooled until their means rise from block to block."""
    kept: list[list[float]] = []
    for block in zip(low.tolist(), high.tolist(), weight.tolist(), total.tolist()):
        current = list(block)
        # A block with no higher mean than the one before it becomes a part of that.
        while kept and _falls((kept[-1][3], kept[-1][2]), (current[3], current[2])):
            before = kept.pop()
            current = [before[0], current[1], before[2] + current[2], before[3] + current[3]]
        kept.append(current)
    return [np.array(column) for column in zip(*kept)]


def _pool(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("low")
    columns = [rows.column(c).to_numpy() for c in ("low", "high", "weight", "total")]
    part = rows.column("part")[0].as_py()
    pooled = pooled_neighbours(*columns)
    named = dict(zip(("low", "high", "weight", "total"), map(pa.array, pooled)))
    return pa.table({"part": pa.array([part] * len(pooled[0]), pa.int32()), **named})


def _written(frame: DataFrame) -> DataFrame:
    spark = frame.sparkSession
    path = fresh_path(spark, "blocks")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _dealt(blocks: DataFrame, bounds: list[float]) -> DataFrame:
    """``blocks`` with the number of their range; a bound belongs to the range above it."""
    if not bounds:
        return blocks.withColumn("part", F.lit(0))
    known = F.array(*map(F.lit, sorted(bounds)))
    return blocks.withColumn("part", F.size(F.filter(known, lambda b: b <= F.col("low"))).cast("int"))


def pooled_blocks(points: DataFrame, most: int = MOST) -> DataFrame:
    """(part, low, high, weight, total): the blocks of equal value of the isotonic fit, by weighted least squares.

    ``points`` has (score, weight, total), a row per distinct score, ``total`` being weight times mean outcome. Pooling
    neighbours gives the same blocks in whatever order they are pooled, so ranges of scores are pooled side by side,
    then ranges that reach from the middle of each to the middle of the next, until no range begins below the end of
    the one before. Only the ranges' ends reach the driver.
    """
    low, high = F.col("score").alias("low"), F.col("score").alias("high")
    blocks = _written(points.select(F.lit(0).alias("part"), low, high, "weight", "total"))
    n = blocks.count()
    if n == 0:
        return blocks
    parts = -(-n // most)
    bounds: list[float] = []
    if parts > 1:
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        bounds = sorted(set(blocks.agg(F.percentile_approx("low", shares, F.lit(100 * parts))).first()[0]))
    while True:
        blocks = _written(_dealt(blocks.drop("part"), bounds).groupBy("part").applyInArrow(_pool, BLOCK))
        ends = F.struct("total", "weight")
        ranges = (
            blocks.groupBy("part")
            .agg(
                F.min_by(ends, "low").alias("first"),
                F.max_by(ends, "low").alias("last"),
                F.count("*").alias("blocks"),
                F.percentile_approx("low", 0.5).alias("middle"),
                F.min("low").alias("low"),
            )
            .orderBy("part")
            .collect()  # a row for each range
        )
        if not any(_falls(a["last"], b["first"]) for a, b in zip(ranges, ranges[1:])):
            return blocks
        # A range of one block has no middle to cut at, so whatever borders on it comes together.
        bounds = sorted({r["middle"] for r in ranges if r["blocks"] > 1 and r["middle"] > r["low"]})


def isotonic_map(
    scored: DataFrame, score: str = "score", label: str = "label", weight: Column | None = None, most: int = MOST
) -> IsotonicRegressionModel:
    """The map from score to probability, with straight lines between its blocks and level ends.

    Rows of equal score are summed first. What MLlib is given are the two ends of every block, which rise already.
    """
    weight = F.lit(1.0) if weight is None else weight
    outcome = F.col(label).cast("double")
    points = (
        scored.filter(F.col(score).isNotNull() & outcome.isNotNull())
        .select((F.col(score).cast("double") + 0.0).alias("score"), weight.alias("weight"), (weight * outcome).alias("total"))
        .groupBy("score")
        .agg(F.sum("weight").alias("weight"), F.sum("total").alias("total"))
        .filter("weight > 0")
    )
    blocks = pooled_blocks(points, most)
    ends = F.array_distinct(F.array("low", "high"))
    rising = blocks.select(
        F.explode(ends).alias("score"), (F.col("total") / F.col("weight")).alias("label"), F.col("weight").alias("rows")
    )
    return IsotonicRegression(
        featuresCol="score", labelCol="label", weightCol="rows", predictionCol="calibrated"
    ).fit(rising)
