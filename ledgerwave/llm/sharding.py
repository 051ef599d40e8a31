"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes out of indivisible groups of rows."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.llm.common import text_of, written

SHARDS = 8
#: Groups in a cell, parts a cell is cut into, items of the last differencing, and rows numbered together.
CELL, PARTS, LAST, BLOCK = 4096, 64, 65536, 65536
#: Bundles that each shard is filled with at least.
FILL = 128


def differencing(sizes: list[int], parts: int) -> list[int]:
    """The part of each item. The two partial partitions of the largest spread are put together, the largest part of
    the one with the smallest of the other, until one is left."""
    # A partial partition: its sums in ascending order, and how its places came from those of the two it was made of.
    nodes: list[tuple] = [(None, None, item) for item in range(len(sizes))]
    heap = [(-size, i, [0] * (parts - 1) + [size]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, sums_a = heapq.heappop(heap)
        _, b, sums_b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(sums_a, reversed(sums_b))]
        order = sorted(range(parts), key=sums.__getitem__)
        nodes.append((a, b, order))
        heapq.heappush(heap, (sums[order[0]] - sums[order[-1]], len(nodes) - 1, [sums[i] for i in order]))
    result = [0] * len(sizes)
    stack = [(len(nodes) - 1, list(range(parts)))] if nodes else []
    while stack:
        node, places = stack.pop()
        a, b, order = nodes[node]
        if a is None:
            result[order] = places[-1]
            continue
        own, other = [0] * parts, [0] * parts
        for place, i in zip(places, order):
            own[i], other[parts - 1 - i] = place, place
        stack += [(a, own), (b, other)]
    return result


def _difference(items: DataFrame, parts: int) -> DataFrame:
    """(cell, item, bytes) with the ``part`` of each item within its cell."""

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "item"], ascending=[False, True], kind="stable")
        return rows.assign(part=differencing(rows["bytes"].tolist(), parts))[["cell", "item", "bytes", "part"]]

    return items.groupBy("cell").applyInPandas(cell, "cell long, item long, bytes long, part int")


def assign(groups: DataFrame, shards: int = SHARDS, cell: int = CELL, parts: int = PARTS, last: int = LAST) -> DataFrame:
    """(item, bytes), one row per group, to (item, shard).

    Cells of about ``cell`` groups are differenced into ``parts`` bundles each, and the bundles into shards; with more
    than ``last`` bundles they are bundled again. Groups of more than two ``last``-ths of all bytes, of which there can
    be no more than half of ``last``, are kept out of the cells and meet the bundles as they are, so the rest fills up
    around them. There are at least ``FILL`` bundles for each shard, whatever the other numbers, so the last
    differencing has small ones to even shards out with.
    """
    last = max(last, 2 * FILL * shards)
    total, count = groups.agg(F.sum("bytes"), F.count("*")).first()
    heavy = 2 * (total or 0) // last
    # An item is named by the level it was made at and its number there; groups are of level 0.
    items, bundles, level = groups.select(F.lit(0).alias("level"), "item", "bytes"), [], 0
    while count > last:
        cells = -(-count // cell)
        cut = max(parts, -(-FILL * shards // cells))
        light = items.filter(F.col("bytes") <= heavy)
        dealt = light.withColumn("cell", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(cells)))
        bundled = written(
            _difference(dealt, cut).select("item", "bytes", (F.col("cell") * cut + F.col("part")).alias("bundle")),
            "bundles",
        )
        bundles.append(bundled)
        level += 1
        made = bundled.groupBy(F.col("bundle").alias("item")).agg(F.sum("bytes").alias("bytes"))
        items = written(
            made.select(F.lit(level).alias("level"), "item", "bytes").unionByName(items.filter(F.col("bytes") > heavy)),
            "items",
        )
        count = items.count()
    placed = written(_last(items, shards), "placed")
    result = placed.filter(F.col("level") == level).select("item", "shard")
    for step in reversed(range(level)):
        inside = bundles[step].join(result.withColumnRenamed("item", "bundle"), "bundle").select("item", "shard")
        result = inside.unionByName(placed.filter(F.col("level") == step).select("item", "shard"))
    return result


def _last(items: DataFrame, shards: int) -> DataFrame:
    """The last differencing, over a bounded number of items."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "level", "item"], ascending=[False, True, True], kind="stable")
        return rows.assign(shard=differencing(rows["bytes"].tolist(), shards))[["level", "item", "shard"]]

    return items.groupBy().applyInPandas(run, "level int, item long, shard int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with its shard and its place there.

    A row weighs the UTF-8 bytes of its text plus one. Rows of equal text stay together; a null text counts as empty
    and weighs one. Null and repeated ids are rows like others. An empty table gives no rows. Other columns of ``docs``
    are not read, so their names do not matter. Returns id, size, text_crc32, law, shard, slot, grown_shard.

    Groups are summed before the shuffle, so a text of a third of all rows is one item. Two texts of one 64-bit hash
    would only be kept together. Slots are numbered by blocks of a written table, never by a shard as a whole.
    """
    text = text_of(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("item"),
    )
    groups = written(rows.groupBy("item").agg(F.sum("size").alias("bytes")), "groups")
    shard_of = written(assign(groups, shards), "shards")
    placed = written(rows.join(shard_of, "item").select("doc_id", "size", "text_crc32", "shard"), "rows").select(
        "*",
        F.col("_metadata.file_name").alias("file"),
        F.floor(F.col("_metadata.row_index") / BLOCK).alias("block"),
        F.col("_metadata.row_index").alias("row"),
    )
    place = ["shard", "file", "block"]
    before = Window.partitionBy("shard").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*place).agg(F.count("*").alias("n")).select(
        *place, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    return (
        placed.withColumn("nth", F.row_number().over(Window.partitionBy(*place).orderBy("row")) - 1)
        .join(starts, place)
        .select(
            F.col("doc_id").alias(id_column),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
