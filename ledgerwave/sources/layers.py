"""Writing layers, report files and keyed replacements."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot
from ledgerwave.session import free_shuffles

# Layers kept as views; every other layer is written.
VIEW_LAYERS = ("staging", "intermediate")


@dataclass(frozen=True)
class Dealt:
    """A table made of few narrow rows, which are dealt by column ``by`` and become many wide ones afterwards.

    All rows of a partition of the table must come from rows of one value of ``by``.
    """

    rows: DataFrame
    by: str
    finish: Callable[[DataFrame], DataFrame]


def materialize_layer(
    spark: SparkSession,
    layer: str,
    tables: dict[str, DataFrame | Dealt],
    folder: str,
    partition_by: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Views for staging and intermediate layers, Parquet under ``folder`` for the rest.

    A written table is read back, so that its users share it rather than the
    plan that made it. A partitioned table is rebalanced by its partition column
    first: few files per value, and a busy value is still split over tasks. A ``Dealt`` table is rebalanced as it is
    before it grows.
    """
    result = {}
    for name, table in tables.items():
        dealt = isinstance(table, Dealt)
        if dealt:
            table = table.finish(table.rows.hint("rebalance", F.col(table.by)))
        if layer in VIEW_LAYERS:
            table.createOrReplaceTempView(f"{layer}_{name}")
            result[name] = table
            continue
        path = f"{folder}/{layer}/{name}"
        column = (partition_by or {}).get(name)
        written = table.hint("rebalance", F.col(column)) if column and not dealt else table
        # Keys are hex digits, which zstd stores in half of the space and snappy does not.
        writer = written.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(column) if column else writer).parquet(path)
        free_shuffles(spark)
        result[name] = spark.read.schema(table.schema).parquet(path)
    return result


def write_artifact_json(df: DataFrame, folder: str, name: str, prefix: str = "") -> str:
    """One JSON folder per report."""
    path = f"{folder}/{prefix}{name}.json"
    df.write.mode("overwrite").json(path)
    return path


def upsert_by_key(existing: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """``incoming`` first, then the existing rows whose key it does not replace.

    Rows without a key are never replaced. ``batch`` orders the result, newest first.
    """
    replaced = incoming.select(*keys).distinct()
    kept = join_hot(existing, replaced, keys, "left_anti")
    return incoming.withColumn("batch", F.lit(0)).unionByName(kept.withColumn("batch", F.lit(1)))
