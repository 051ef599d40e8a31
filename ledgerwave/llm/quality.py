"""Quality by compression: how much better a dictionary of good texts compresses a text than one of bad texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled texts per class for the dictionaries, and for the calibration; bytes of a sampled text that train a
#: dictionary; bytes of a dictionary; bytes compressed at once; the level.
SAMPLE, TRAIN_BYTES, DICTIONARY, PIECE, LEVEL = 1500, 8192, 112_640, 1024, 9
#: Numbers that the score is made of.
WIDTH = 10
THRESHOLD = 0.7


@dataclass
class QualityModel:
    """Two dictionaries and the logistic map from compressed sizes to the chance that a text is good."""

    good: bytes
    bad: bytes
    weights: list[float]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model with its compressors, which cannot travel."""

    def __init__(self, model: QualityModel) -> None:
        self.weights = np.array(model.weights)
        self.sides = []
        for raw in (model.good, model.bad):
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.sides.append(
                zstandard.ZstdCompressor(
                    dict_data=dictionary, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )

    def features(self, text: str) -> np.ndarray:
        """What the score is made of, over the whole text.

        The difference of the two compressed sizes over their sum, and the share of the text that is left, with bends
        where a text repeats itself or hardly shrinks: a text of one repeated word is as small with either dictionary.
        """
        raw = text.encode()
        good = bad = 0
        for at in range(0, len(raw), PIECE):
            piece = raw[at : at + PIECE]
            good += len(self.sides[0].compress(piece))
            bad += len(self.sides[1].compress(piece))
        if not raw:
            return np.zeros(WIDTH)
        difference, left = 10 * (bad - good) / (bad + good), min(good, bad) / len(raw)
        bends = [max(0.0, bend - left) for bend in (0.1, 0.2, 0.3)] + [max(0.0, left - 0.6)]
        return np.array([1.0, difference, min(difference, 0.5), left, difference * left, np.log1p(len(raw)) / 10, *bends])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def sampled(docs: DataFrame, labels: DataFrame, sample: int, id_column: str, text_column: str, label: str) -> list:
    """At most ``sample`` labelled texts of each class, chosen by a hash of the id; a text is cut to what can train."""
    known = (
        labels.select(F.col(id_column).alias("id"), F.col(label).alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = known.filter(F.col("label") == 0).orderBy(order, "id").limit(sample)
    chosen = chosen.unionByName(known.filter(F.col("label") == 1).orderBy(order, "id").limit(sample))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = (
        texts.filter(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "id")  # at most two samples of ids
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
        .select("id", "label", "text")
    )
    return rows


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    label: str = "quality",
) -> QualityModel:
    """Dictionaries and calibration from at most ``2 * sample`` labelled texts of each class.

    Half of the sample fills the dictionaries, the other half, whose texts the dictionaries have not seen, gives the
    logistic map its sizes. Classes weigh as they do among all labelled rows. Labels for ids that no document has,
    labels other than 0 and 1, and null ids or texts teach nothing; of several labels of an id the lowest counts.
    Without labels of both kinds every text scores the share of good labels, or one half without any.
    """
    labelled = labels.filter(F.col(label).isin(0, 1))
    share = labelled.agg(F.avg(F.col(label).cast("double"))).first()[0]
    share = 0.5 if share is None else float(share)
    constant = [float(np.log((share + 1e-6) / (1 - share + 1e-6)))] + [0.0] * (WIDTH - 1)
    rows = sampled(docs, labels, 2 * sample, id_column, text_column, label)
    teaches = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(7)), F.lit(2)) == 0
    parts = rows.withColumn("teaches", teaches)
    first = parts.filter("teaches").select("id", "label", F.substring("text", 1, TRAIN_BYTES).alias("text"))
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for row in first.orderBy(F.xxhash64("id"), "id").collect():  # bounded: 2 * sample texts of TRAIN_BYTES characters
        texts[row["label"]].append(row["text"].encode())
    if not texts[0] or not texts[1]:
        return QualityModel(b"", b"", constant)
    model = QualityModel(_dictionary(texts[1]), _dictionary(texts[0]), constant)
    sizes = parts.filter(~F.col("teaches"))
    points = measured(sizes, model).select("label", "features").collect()  # bounded: numbers of 2 * sample texts
    if len({p["label"] for p in points}) == 2:
        model.weights = _logistic(
            np.array([p["features"] for p in points]), np.array([p["label"] for p in points], float), share
        )
    return model


def _dictionary(texts: list[bytes]) -> bytes:
    """Equal shares of the texts, so that all of them are in it."""
    share = max(64, DICTIONARY // len(texts))
    return b"\n".join(t[:share] for t in texts)[:DICTIONARY]


def _logistic(x: np.ndarray, y: np.ndarray, share: float, penalty: float = 1e-3) -> list[float]:
    """Newton's method on the weighted likelihood; rows weigh as their class does among all labels."""
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    w = np.zeros(x.shape[1])
    ridge = penalty * len(y) * np.eye(x.shape[1])
    ridge[0, 0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def measured(rows: DataFrame, model: QualityModel) -> DataFrame:
    """(label, text) to (label, features)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for part in parts:
            values = [scorer.features(t.as_py()).tolist() for t in part.column("text")]
            yield pa.RecordBatch.from_arrays(
                [part.column("label").cast(pa.int32()), pa.array(values, pa.list_(pa.float64()))], ["label", "features"]
            )

    return rows.select(F.col("label").cast("int"), "text").mapInArrow(run, "label int, features array<double>")


def scored(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """``docs`` as the struct ``row``, with ``score``: the chance that the text is good.

    Only the text is looked at. Empty and null texts have the score of no evidence, one half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.lit(0.0).alias("score"),
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for part in parts:
            values = pa.array([scorer.score(t.as_py()) for t in part.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("row"), values], ["row", "score"])

    from pyspark.sql.types import StructType

    schema = StructType([f for f in given.schema.fields if f.name != "text"])
    return given.mapInArrow(run, schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows whose labels nothing is learnt from: a quarter, by a checksum of the id; a null id is one."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learnable(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return labels.filter(~held_out(id_column))
