"""Joining rows with hot keys to one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 8


def join_hot(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    null_safe: bool = False,
    slices: int = SLICES,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds at most one row per key.

    Rows of one key are dealt over ``slices`` by a hash of ``spread`` (all other
    columns by default), and each lookup row is repeated once per slice. An
    aggregated lookup is already partitioned by its key, and Spark would pull
    the rows to it without a shuffle it could split; the slice makes both sides
    shuffle, so a key is cut into slices and AQE can cut a slice further. The
    hash makes a retried task deal its rows as before.
    """
    dealt_by = list(spread or [c for c in rows.columns if c not in on])
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(*dealt_by), F.lit(slices)).cast("int"))
    repeated = lookup.withColumnsRenamed({c: f"_key_{c}" for c in on}).withColumn(
        "_lookup_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    )

    def equal(column: str) -> Column:
        own, other = F.col(column), F.col(f"_key_{column}")
        return own.eqNullSafe(other) if null_safe else own == other

    condition = reduce(lambda a, b: a & b, [*map(equal, on), F.col("_slice") == F.col("_lookup_slice")])
    return dealt.join(repeated, condition, how).drop("_slice", "_lookup_slice", *[f"_key_{c}" for c in on])


#: Rows up to which a lookup is sent to every task: a few MB of keys and short texts.
SMALL = 20_000


def join_sized(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Sequence[str] | None = None,
    small: int = SMALL,
) -> DataFrame:
    """Left join of ``rows`` to ``lookup`` by its true size: sent to every task if it has few rows, else in slices.

    Spark estimates an aggregated lookup from the table behind it, and would shuffle the rows on a handful of keys for
    twelve products. Counting reads the lookup's keys once and stops past ``small``.
    """
    if lookup.select(*on).limit(small + 1).count() <= small:
        return rows.join(F.broadcast(lookup), list(on), "left")
    return join_hot(rows, lookup, on, "left", spread)


def join_sides(
    rows: DataFrame,
    lookup: DataFrame,
    sides: Sequence[Sequence[str]],
    on: Sequence[str],
    name: str,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """``rows`` that have both their sides in ``lookup``, which ``name``1 and ``name``2 then hold.

    ``sides`` names the columns of each side that make the key ``on``. Both sides meet the lookup, which holds at most
    one row per key, in one join, and come together again by the row, of which there may be no second one alike. With
    ``spread`` the rows of a key are dealt over slices by these columns.
    """
    own = [f"_on_{c}" for c in on]
    keys = [F.struct(*[F.col(c).alias(k) for c, k in zip(side, own)]) for side in sides]
    fields = [c for c in lookup.columns if c not in on]
    each = rows.select(*rows.columns, F.posexplode(F.array(*keys)).alias("_side", "_key")).select(
        *rows.columns, "_side", "_key.*"
    )
    known = lookup.select(*[F.col(c).alias(o) for c, o in zip(on, own)], F.struct(*fields).alias("_known"))
    met = each.join(known, own) if spread is None else join_hot(each, known, own, "inner", spread)
    pairs = met.groupBy(*rows.columns).agg(F.sort_array(F.collect_list(F.struct("_side", "_known"))).alias("_met"))
    both = pairs.filter(F.size("_met") == len(sides))
    return both.select(*rows.columns, *[F.col("_met")[i]["_known"].alias(f"{name}{i + 1}") for i in range(len(sides))])
