"""Importance resampling towards a target: weights scored from arrays of bucket gains, winners by distributed quickselect."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.llm.common import text_of, written

#: Buckets of features, least words and percentage of a draw, seed, pivots of a round, bytes of text looked at together.
BUCKETS, LEAST_WORDS, PERCENT, SEED, PIVOTS, CHUNK = 10_000, 20, 25, 7, 31, 1 << 20

#: What is no ASCII letter or digit parts words, and A-Z become a-z; bytes of other characters stay.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``CHUNK`` bytes that end with a word."""
    at = 0
    while len(raw) - at > CHUNK:
        end = raw.find(b" ", at + CHUNK)
        if end < 0:
            break
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw


@lru_cache(maxsize=4096)
def _behind(n: int) -> np.ndarray:
    """What ``n`` further bytes make of each byte of an earlier checksum: four tables of 256 entries.

    A CRC is linear, so the checksum of a text and ``n`` bytes more is that of the bytes, xor-ed with the four lookups.
    """
    if n == 1:
        bits = [_one_more(1 << i) for i in range(32)]
    else:
        half = _behind(n // 2)
        bits = [int(_looked_up(half, _looked_up(half, np.array([1 << i], np.uint32)))[0]) for i in range(32)]
        if n % 2:
            bits = [_one_more(b) for b in bits]
    tables = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            tables[byte, np.arange(256) >> bit & 1 == 1] ^= np.uint32(bits[8 * byte + bit])
    return tables


def _one_more(state: int) -> int:
    """The checksum register after a zero byte."""
    return zlib.crc32(b"\0", state) ^ zlib.crc32(b"\0")


def _looked_up(tables: np.ndarray, checksums: np.ndarray) -> np.ndarray:
    return (
        tables[0][checksums & 255]
        ^ tables[1][checksums >> 8 & 255]
        ^ tables[2][checksums >> 16 & 255]
        ^ tables[3][checksums >> 24]
    )


def features_of(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: the bucket of every feature, to which text it belongs, and how many words each text has."""
    words: list[bytes] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        for piece in _pieces(text.encode().translate(_PLAIN)):
            words += piece.split()
        ends[i + 1] = len(words)
    coded = pa.array(words, pa.binary()).dictionary_encode()
    known, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    alone = np.array([zlib.crc32(w) for w in known], np.uint32)
    after = np.array([zlib.crc32(b" " + w) for w in known], np.uint32)
    size = np.array([len(w) + 1 for w in known], np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    single = alone[code] % np.uint32(buckets)
    second = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    joined = after[code[second]]
    lengths = size[code[second]]
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        joined[at] ^= _looked_up(_behind(int(n)), alone[code[second[at] - 1]])
    found = np.concatenate([single, joined % np.uint32(buckets)]).astype(np.int64)
    return found, np.concatenate([owner, owner[second]]), np.diff(ends)


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """Texts of an Arrow column in groups of about ``CHUNK`` characters, so that memory is that of a group."""
    group, held = [], 0
    for text in texts:
        group.append(text.as_py())
        held += len(group[-1])
        if held >= CHUNK:
            yield group
            group, held = [], 0
    if group:
        yield group


def bucket_counts(rows: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket: an array as long as there are buckets, whatever the data."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in parts:
            for group in _groups(part.column("text")):
                total += np.bincount(features_of(group, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    texts = rows.select(text_of(text_column).alias("text"))
    sums = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets, np.int64)
    for bucket, n in sums:
        total[bucket] = n
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, for B buckets."""
    b = len(corpus)
    all_corpus, all_target = float(corpus.sum() + b), float(target.sum() + b)
    return np.floor(1000 * np.log((target + 1.0) * all_corpus / ((corpus + 1.0) * all_target))).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of a document's features, 0 without any."""
    buckets = len(gains)

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            weights, counts, features = [], [], []
            for group in _groups(part.column("text")):
                found, owner, words = features_of(group, buckets)
                n = words + np.maximum(words - 1, 0)
                total = np.zeros(len(group), np.int64)
                np.add.at(total, owner, gains[found])
                weights.append(total // np.maximum(n, 1))
                counts.append(words)
                features.append(n)
            columns = [pa.array(np.concatenate([*c, np.zeros(0, np.int64)])) for c in (counts, features, weights)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"]
            )

    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(seed: int = SEED, id_column: str = "doc_id") -> Column:
    """floor(-1000 ln(-ln u)) for the u that the seed and the id decide; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296))).cast("long")


#: Composite key of a draw, best first: score, then id, then what tells rows of one id apart.
_KEY = ("down", "no_id", "id", "n_features", "place")


def _below(pivot: tuple) -> Column:
    """Whether a row comes before a pivot."""
    later = F.lit(False)
    for name, value in reversed(list(zip(_KEY, pivot))):
        column = F.col(name)
        later = (column < F.lit(value)) | ((column == F.lit(value)) & later)
    return later


def _equal(pivot: tuple) -> Column:
    return reduce(lambda a, b: a & b, (F.col(n) == F.lit(v) for n, v in zip(_KEY, pivot)))


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS) -> tuple:
    """The k-th key (from 1) of a table of keys, by quickselect.

    A round draws random pivots from the keys that are still open and counts, exactly, the rows before, at and after
    each. The two pivots on either side of place ``k`` bound the next round, so a round leaves about one part in
    ``pivots``; with no more keys than pivots all are pivots and the key is among them.
    """
    low = high = None
    for turn in range(200):
        still = keys
        if low is not None:
            still = still.filter(~(_below(low) | _equal(low)))
        if high is not None:
            still = still.filter(_below(high))
        chance = F.xxhash64(F.lit(turn), *_KEY)
        drawn = sorted(tuple(r) for r in still.orderBy(chance, *_KEY).limit(pivots).select(*_KEY).collect())
        if not drawn:
            break
        counts = keys.agg(
            *(F.count_if(_below(p)).alias(f"b{i}") for i, p in enumerate(drawn)),
            *(F.count_if(_equal(p)).alias(f"e{i}") for i, p in enumerate(drawn)),
        ).first()
        for i, pivot in enumerate(drawn):
            before, same = counts[f"b{i}"], counts[f"e{i}"]
            if before < k <= before + same:
                return pivot
            if before + same < k:
                low = pivot
            elif high is None or pivot < high:
                high = pivot
    raise ValueError(f"there is no key {k}")


def ranked(winners: DataFrame) -> DataFrame:
    """The winners with ``rank`` from 1 in the order of their keys: sorted in ranges, numbered within them."""
    spark = winners.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = winners.repartitionByRange(n, *_KEY).withColumn("part", F.spark_partition_id())
    ranges = written(ranges, "winners")
    sizes = sorted((r["part"], r["n"]) for r in ranges.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, size in sizes:
        starts.append((part, before))
        before += size
    starts = F.broadcast(spark.createDataFrame(starts, "part int, before long"))  # a row for each range
    place = F.row_number().over(Window.partitionBy("part").orderBy(*_KEY))
    return ranges.withColumn("at", place).join(starts, "part").withColumn("rank", F.col("before") + F.col("at"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    pivots: int = PIVOTS,
) -> DataFrame:
    """Every row of ``docs`` as (doc_id, n_features, weight, score, rank); ``rank`` is null for those not drawn.

    Two passes over the texts: the first sums bucket counts (an array of fixed length), the second scores each text
    from the array of gains. The draw needs the keys alone: a written table of some 40 bytes a document, narrowed by
    quickselect to the last key that wins; only winners are sorted.

    - A null or empty text, or one without words, has no features, weight 0, and takes no part in the draw.
    - A long text is cut into words a piece at a time; whole texts count.
    - Every row is drawn for itself. Rows with one id share their random number; ties of score and id go to the row
      with fewer features, equal rows in the order they are stored in. A null id counts as an empty one in the random
      number and comes last in ties.
    - Empty tables: no documents give no rows, an empty target gives every bucket the gain of no target.
    - Other columns of ``docs`` and ``target`` play no part, whatever their names.
    """
    corpus = bucket_counts(docs, text_column, buckets)
    gains = bucket_gains(corpus, bucket_counts(target, target_column, buckets))
    scored = weighed(docs, gains, id_column, text_column).select(
        "*",
        (F.col("weight") + gumbel(seed)).alias("score"),
        F.monotonically_increasing_id().alias("place"),
    )
    scored = written(scored, "scored")
    fit = scored.filter(F.col("n_words") >= least_words)
    kind = dict(docs.dtypes)[id_column]
    nothing = "" if kind == "string" else 0
    keyed = fit.select(
        "*",
        (-F.col("score")).alias("down"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(nothing).cast(kind)).alias("id"),
    )
    columns = ("doc_id", "n_features", "weight", "score")
    k = fit.count() * percent // 100
    if k == 0:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = kth_key(keyed.select(*_KEY), k, pivots)
    won = _below(last) | _equal(last)
    drawn = ranked(keyed.filter(won)).select(*columns, F.col("rank").cast("long"))
    wins = keyed.select("*", won.alias("won")).filter(~F.col("won"))
    rest = wins.select(*columns).unionByName(scored.filter(F.col("n_words") < least_words).select(*columns))
    return drawn.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
