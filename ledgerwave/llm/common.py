"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.session import fresh_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written under the shared folder and read back: lineage ends here, and a lost executor loses nothing."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with null as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: Column) -> Column:
    """128 bits that name a text."""
    return F.unhex(F.md5(column.cast("binary")))


def by_batch(
    frame: DataFrame, work: Callable[..., list], schema: str, names: list[str], *state, start: Callable | None = None
) -> DataFrame:
    """``work(columns..., *state)`` on lists of the columns of every Arrow batch; it returns lists of the output columns.

    ``start`` makes what lives as long as a task (a cache, a compressor) and is passed as the last argument.
    """
    arrow = _arrow_schema(frame.sparkSession, schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = () if start is None else (start(),)
        for part in parts:
            columns = [part.column(n).to_pylist() for n in names]
            result = work(*columns, *state, *own)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(result, arrow.types)], schema=arrow)

    return frame.select(*names).mapInArrow(batches, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


#: Places of the bitmap that tells at once for most rows that they are not among some chosen ones.
PLACES = 1 << 20


def _place(column: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(column.cast("string"), F.lit(""))), F.lit(PLACES)).cast("int")


def _places(frame: DataFrame, column: str) -> DataFrame:
    """At most ``PLACES`` numbers, so small enough to be broadcast whatever the data."""
    return written(frame.select(_place(F.col(column)).alias("_place")).distinct(), "places")


def chosen_rows(rows: DataFrame, chosen: DataFrame, column: str) -> DataFrame:
    """Rows that may have one of the chosen values in ``column``: all that have, and by chance a few others."""
    return rows.join(F.broadcast(_places(chosen, column)), _place(rows[column]) == F.col("_place"), "left_semi")


def split_rows(rows: DataFrame, chosen: DataFrame, columns: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a chosen value, and those that have not: these need no shuffle to be let through."""
    places = F.broadcast(_places(chosen, columns[1]))
    hit = _place(rows[columns[0]]) == F.col("_place")
    return rows.join(places, hit, "left_semi"), rows.join(places, hit, "left_anti")
