"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column | str) -> Column:
    """K1: md5 over the parts as text, joined by '-', NULL as a fixed token."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(
        F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in columns])
    )
