"""Hard negatives by exact scores: anchor tables of subset sums, indexed with the candidates' packed bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.llm.common import written
from ledgerwave.session import fresh_path

#: Whole steps of a component, every how-many-th id is an anchor, positives of an anchor, negatives of a positive, and
#: the least and greatest share of a positive's score that a negative has, in hundredths.
SCALE, EVERY, POSITIVES, NEGATIVES, SHARES = 256, 100, 5, 10, (30, 90)
#: Anchors of one broadcast (8 MB of 64 components), anchors that share tables, candidates scored at once.
CHUNK, BLOCK, ROWS = 32_768, 128, 1024

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def to_planes(whole: np.ndarray) -> np.ndarray:
    """Integers (rows, dimensions) as bit planes (rows, planes, bytes): two's complement, eight dimensions to a byte."""
    largest = np.where(whole < 0, ~whole, whole).max(initial=0)
    return np.stack(
        [np.packbits((whole >> k & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(int(largest).bit_length() + 1)],
        axis=1,
    )


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The integers again, with zeros up to a whole byte of dimensions."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    last = planes.shape[1] - 1
    return sum((-bits[:, k] if k == last else bits[:, k]) << k for k in range(last + 1))


def unpacked(packed: list[bytes], n_planes: np.ndarray) -> np.ndarray:
    """The planes of several rows in one array: the sign plane is repeated and zero bytes are added where rows differ."""
    n_bytes = np.array([len(p) for p in packed], np.int64) // n_planes
    found = np.zeros((len(packed), int(n_planes.max(initial=1)), int(n_bytes.max(initial=0))), np.uint8)
    for planes, width in {*zip(n_planes.tolist(), n_bytes.tolist())}:
        at = np.flatnonzero((n_planes == planes) & (n_bytes == width))
        some = np.frombuffer(b"".join(packed[i] for i in at), np.uint8).reshape(len(at), planes, width)
        found[at, :planes, :width] = some
        found[at, planes:, :width] = some[:, -1:, :]
    return found


def _quantised(part: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a batch that take part, and their whole components; rows of one length together."""
    vectors = part.column("vector")
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (odd[ends] == odd[ends - lengths]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    good &= part.column("label").is_valid().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == length))
        whole = np.floor(scale * values[(ends[rows] - length)[:, None] + np.arange(length)])
        if (np.square(whole).sum(axis=1) >= 2.0**62).any():
            raise OverflowError("the inner products of such vectors do not fit in 64 bits")
        yield rows, whole.astype(np.int64)


def packed_vectors(vectors: DataFrame, key: Column, label: Column, vector: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, planes, n_planes) of the rows that take part."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rows, whole in _quantised(part, scale):
                planes = to_planes(whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(rows)),
                        part.column("label").take(pa.array(rows)),
                        pa.array([p.tobytes() for p in planes], pa.binary()),
                        pa.array(np.full(len(rows), planes.shape[1], np.int32)),
                    ],
                    ["vec_id", "label", "planes", "n_planes"],
                )

    columns = (key.cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("vector"))
    return vectors.select(*columns).mapInArrow(pack, "vec_id long, label long, planes binary, n_planes int")


class Tables:
    """For a block of anchors, the sums of every subset of each eight of their components."""

    def __init__(self, whole: np.ndarray) -> None:
        self.reach = int(np.abs(whole).sum(axis=1).max(initial=0))  # no subset sums to more
        small = np.int16 if self.reach < 1 << 15 else np.int32 if self.reach < 1 << 31 else np.int64
        self.sums = []
        for first in range(0, whole.shape[1], 8):
            table = np.zeros((1, len(whole)), small)
            for component in whole[:, first : first + 8].T.astype(small):
                table = np.concatenate([table, table + component])
            self.sums.append(table)
        self.anchors = len(whole)

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """The inner products (candidates, anchors): a lookup for each byte of a plane, planes added by shifting.

        Bytes that one side alone has meet zeros.
        """
        n, last = len(planes), planes.shape[1] - 1
        small = self.sums[0].dtype if self.sums else np.int16
        total = np.zeros((n, self.anchors), np.int32 if self.reach << (last + 1) < 1 << 31 else np.int64)
        plane, one = np.empty((n, self.anchors), small), np.empty((n, self.anchors), small)
        for k in range(last, -1, -1):
            plane[:] = 0
            for table, byte in zip(self.sums, planes[:, k].T):
                np.take(table, byte, axis=0, out=one, mode="clip")
                plane += one
            total <<= 1
            if k == last:  # the sign plane
                total -= plane
            else:
                total += plane
        return total


class Best:
    """The first ``keep`` candidates of each of some lists, by score downwards, then by id, null ids last."""

    def __init__(self, lists: int, keep: int, least: np.ndarray) -> None:
        self.keep, self.least = keep, least.copy()
        self.at, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, at: np.ndarray, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        if not len(at):
            return
        at, score = np.concatenate([self.at, at]), np.concatenate([self.score, score.astype(np.int64)])
        key, null = np.concatenate([self.id, key]), np.concatenate([self.null, null])
        order = np.lexsort((key, null, -score, at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        first = place < self.keep
        order, self.at = order[first], at[first]
        self.score, self.id, self.null = score[order], key[order], null[order]
        last = place[first] == self.keep - 1  # whoever comes behind a full list does not reach it
        self.least[self.at[last]] = np.maximum(self.least[self.at[last]], self.score[last])


@dataclass
class Anchors:
    """Anchors of one broadcast, in the order of their labels."""

    ids: np.ndarray
    labels: np.ndarray
    whole: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Anchors:
        rows = sorted(rows, key=lambda r: (r["label"], r["vec_id"]))
        planes = unpacked([bytes(r["planes"]) for r in rows], np.array([r["n_planes"] for r in rows]))
        ids, labels = (np.array([r[c] for r in rows], np.int64) for c in ("vec_id", "label"))
        return cls(ids, labels, from_planes(planes).astype(np.int32 if planes.shape[1] < 32 else np.int64))

    def blocks(self) -> list[slice]:
        return [slice(i, i + BLOCK) for i in range(0, len(self.ids), BLOCK)]


@dataclass
class Candidates:
    """Rows of a batch, some columns of which are compared with a block of anchors."""

    ids: np.ndarray
    null: np.ndarray
    labels: np.ndarray
    planes: np.ndarray

    @classmethod
    def of(cls, part: pa.RecordBatch) -> Candidates:
        key = part.column("vec_id")
        planes = unpacked(part.column("planes").to_pylist(), part.column("n_planes").to_numpy())
        return cls(
            pc.fill_null(key, 0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), part.column("label").to_numpy(), planes
        )

    def scored(self, tables: Tables, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some of the rows with their scores against a block, ``ROWS`` at a time."""
        for first in range(0, len(rows), ROWS):
            some = rows[first : first + ROWS]
            yield some, tables.scores(self.planes[some])


def first_positives(packed: DataFrame, anchors: Anchors, keep: int) -> DataFrame:
    """(anchor, id, score): the first rows of its label for each anchor, those of every task merged."""

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = anchors.blocks()
        best = [Best(BLOCK, keep, np.full(BLOCK, np.iinfo(np.int64).min)) for _ in blocks]
        for part in parts:
            rows = Candidates.of(part)
            for block, found in zip(blocks, best):
                labels, ids = anchors.labels[block], anchors.ids[block]
                here = np.flatnonzero(np.isin(rows.labels, labels))
                if not len(here):
                    continue
                for some, scores in rows.scored(Tables(anchors.whole[block]), here):
                    good = (scores >= found.least[: len(ids)]) & (rows.labels[some][:, None] == labels)
                    row, anchor = np.nonzero(good)
                    other = rows.null[some[row]] | (rows.ids[some[row]] != ids[anchor])
                    row, anchor = row[other], anchor[other]
                    found.add(anchor, scores[row, anchor], rows.ids[some[row]], rows.null[some[row]])
        for block, found in zip(blocks, best):
            yield _answer(found, found.at + block.start)

    found = packed.mapInArrow(search, "list long, id long, score long")
    return _merged(found, keep).withColumnRenamed("list", "anchor")


def first_negatives(
    packed: DataFrame, anchors: Anchors, low: np.ndarray, high: np.ndarray, keep: int
) -> DataFrame:
    """(list, id, score, place): the first rows of other labels with scores in the bounds of each list.

    ``low`` and ``high`` are (anchors, lists of an anchor); list ``j`` of anchor ``i`` is number ``i * lists + j``.
    """
    lists = low.shape[1]

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = anchors.blocks()
        best = [Best(BLOCK * lists, keep, low[block].ravel()) for block in blocks]
        for part in parts:
            rows = Candidates.of(part)
            for block, found in zip(blocks, best):
                labels, n = anchors.labels[block], len(anchors.ids[block])
                one = labels[0] == labels[-1]
                here = np.flatnonzero(rows.labels != labels[0]) if one else np.arange(len(rows.labels))
                if not len(here) or (low[block] > high[block]).all():
                    continue
                for some, scores in rows.scored(Tables(anchors.whole[block]), here):
                    least = found.least.reshape(-1, lists)[:n]
                    row, anchor = np.nonzero((scores >= least.min(axis=1)) & (scores <= high[block].max(axis=1)))
                    other = rows.labels[some[row]] != labels[anchor]
                    row, anchor = row[other], anchor[other]
                    score = scores[row, anchor]
                    hits, which = np.nonzero((score[:, None] >= least[anchor]) & (score[:, None] <= high[block][anchor]))
                    row, anchor, score = row[hits], anchor[hits], score[hits]
                    found.add(anchor * lists + which, score, rows.ids[some[row]], rows.null[some[row]])
        for block, found in zip(blocks, best):
            yield _answer(found, found.at + block.start * lists)

    return _merged(packed.mapInArrow(search, "list long, id long, score long"), keep)


def _answer(found: Best, lists: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(lists), pa.array(found.id, mask=found.null), pa.array(found.score)], ["list", "id", "score"]
    )


def _merged(found: DataFrame, keep: int) -> DataFrame:
    """The first rows of each list over all tasks, each of which has sent ``keep`` at most."""
    order = Window.partitionBy("list").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)


def mine(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | None = None,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shares: tuple[int, int] = SHARES,
    scale: int = SCALE,
    chunk: int = CHUNK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor.

    Anchors are the rows whose id is divisible by ``every``; they meet all rows, ``chunk`` of them at a time, sent to
    every task (so many rows of whole components, whatever the data). A task keeps, for each list, only its first
    ``positives`` or ``negatives`` rows; those of all tasks are merged by a window over these few. Scores are inner
    products of ``floor(scale * x)``, exact; each pair is scored once, as one of equal or one of different labels.

    - Rows with a null label or vector, or any null or non-finite component, take no part. Labels are whole numbers.
    - Higher scores come first, then smaller ids, null ids last. A row with a null id is no anchor but may be found.
    - Every row stands for itself: a repeated anchor has its results repeated, repeated rows may all be found. Rows
      with the anchor's own id are none of its positives.
    - Of vectors of different lengths the shorter counts as ended with zeros; an empty one has score 0 with all.
    - Vectors so long that scores might not fit in 64 bits (squares that sum to 2^62 or more) raise an error.
    - Empty tables, and tables without anchors, give no rows. Other columns play no part, whatever their names.
    """
    spark = vectors.sparkSession
    label = F.col("label") if label is None else label
    packed = written(packed_vectors(vectors, F.col(id_column), label, F.col(vector_column), scale), "vectors")
    path = fresh_path(spark, "negatives")
    empty = spark.createDataFrame([], RESULT)
    empty.write.parquet(path)
    held: list = []
    for row in packed.filter(F.col("vec_id") % every == 0).toLocalIterator():
        held.append(row)
        if len(held) == chunk:
            _mined(packed, Anchors.of(held), positives, negatives, shares).write.mode("append").parquet(path)
            held = []
    if held:
        _mined(packed, Anchors.of(held), positives, negatives, shares).write.mode("append").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)


def _mined(packed: DataFrame, anchors: Anchors, positives: int, negatives: int, shares: tuple[int, int]) -> DataFrame:
    """The result for the anchors of one chunk."""
    spark, n = packed.sparkSession, len(anchors.ids)
    found = first_positives(packed, anchors, positives).collect()  # at most ``positives`` for each anchor of the chunk
    low, high = np.full((n, positives), 1, np.int64), np.zeros((n, positives), np.int64)  # empty bounds
    lists = []
    for r in found:
        i, j, score = r["anchor"], r["place"] - 1, r["score"]
        low[i, j], high[i, j] = -(-shares[0] * score // 100), shares[1] * score // 100
        lists.append((i * positives + j, int(anchors.ids[i]), r["id"], score))
    known = spark.createDataFrame(lists, "list long, anchor_id long, positive_id long, positive_score long")
    best = first_negatives(packed, anchors, low, high, negatives).join(F.broadcast(known), "list")
    return best.select(
        "anchor_id",
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
