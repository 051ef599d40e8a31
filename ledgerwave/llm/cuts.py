"""Texts without some of their parts, for the rows that lose any; all others pass without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwave.llm.common import split_rows, text_key, text_of


def cut_texts(
    docs: DataFrame,
    cuts: DataFrame,
    without: Callable[[str, list[int]], tuple[str, int]],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` as the struct ``row`` with ``text`` cut, and ``removed``, the number that ``without`` counts.

    ``cuts`` has (doc_id, text_key, parts), a written table with a row for each pair of id and text that loses some.
    """
    touched, whole = split_rows(docs.select(F.struct("*").alias("row"), F.col(id_column).alias("_id")), cuts, ("_id", "doc_id"))
    kind = dict(docs.dtypes)[text_column]
    named = touched.withColumn("_key", text_key(text_of(f"row.{text_column}")))
    joined = named.join(
        cuts, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")), "left"
    ).select("row", F.col(f"row.{text_column}").cast("string").alias("text"), "parts", F.lit(0).alias("removed"))
    same = joined.drop("parts")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, counts = [], []
            for text, gone in zip(part.column("text"), part.column("parts")):
                text, n = text.as_py(), 0
                if gone.is_valid:
                    text, n = without(text or "", gone.as_py())
                texts.append(text)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], ["row", "text", "removed"]
            )

    done = joined.select("row", "text", "parts").mapInArrow(cut, same.schema)
    rest = whole.select("row", F.col(f"row.{text_column}").cast("string").alias("text"), F.lit(0).alias("removed"))
    both = done.unionByName(rest)
    return both.select(F.col("row").withField(text_column, F.col("text").cast(kind)).alias("row"), "removed")
