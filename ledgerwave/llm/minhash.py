"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.llm import graph
from ledgerwave.llm.common import chosen_rows, text_key, text_of, written
from ledgerwave.llm.words import shingles, word_hashes

#: Words of a shingle, similarity of a link, samples in a band, bands. A pair at the threshold shares a band with
#: probability 1 - (1 - 0.8 ** 3) ** 10 = 0.9992, one at 0.9 with 0.999998.
SHINGLE, SIMILARITY, ROWS, BANDS = 5, 0.8, 3, 10
#: Samples are drawn with frequencies of hashed features: a table of fixed size. Pairs are verified with those of the
#: shingles themselves. Both come from the same count, see ``Frequencies``.
FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
#: Members of a bucket that are held against all of it, by round; see ``graph.tied``. What one leaves goes to the tiles.
ROUNDS = (1,)
#: Parts of the shingles' hashes whose weights bound a similarity, and members of a bucket, and their shingles, in a block.
PARTS, BLOCK, BLOCK_SHINGLES = 64, 512, 1 << 21
#: Rows of the table of random variates.
VARIATES = 1 << 16
#: Variates that are looked up at once.
AT_ONCE = 1 << 14
#: Shingles that a task packs before it hands them on, bytes of text for each range of shingles, and rows of a batch.
COUNTED, RANGE_BYTES, BATCH = 1 << 21, 1 << 22, 1 << 17


class Sampler:
    """Improved consistent weighted sampling.

    For each sample j and shingle k there are r and c from Gamma(2, 1) and beta from (0, 1). With the weight S,
    t = floor(ln S / r + beta) and ln a = ln c - r (t - beta + 1); the sample is (k, t) of the least a. Two documents
    share it with the probability of their weighted Jaccard similarity. The variates come from a table in the place
    that a hash of k under j names, so they are the same in every task.
    """

    def __init__(self, samples: int) -> None:
        own = np.random.default_rng(20_240_229)
        self.r = own.gamma(2.0, 1.0, VARIATES).astype(np.float32) + np.float32(1e-6)
        self.beta = own.random(VARIATES, np.float32)
        self.log_c = np.log(own.gamma(2.0, 1.0, VARIATES) + 1e-12).astype(np.float32)
        self.odd = own.integers(1 << 62, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        log_weight = np.log(weights).astype(np.float32)
        result = np.empty(len(self.odd), np.uint64)
        step = max(1, AT_ONCE // max(1, len(keys)))
        with np.errstate(over="ignore"):
            for first in range(0, len(self.odd), step):
                odd = self.odd[first : first + step]
                place = (np.multiply.outer(odd, keys) >> np.uint64(64 - 16)).view(np.int64)
                r, beta = self.r.take(place), self.beta.take(place)
                t = np.floor(log_weight / r + beta)
                at = np.argmin(self.log_c.take(place) - r * (t - beta + 1), axis=1)
                level = t[np.arange(len(odd)), at].astype(np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF)
                result[first : first + step] = (keys[at] + level * self.odd[0]) * odd
        return result


def _feature(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def packed(keys: np.ndarray) -> bytes:
    """Ascending numbers as the first one and steps, each in as many bytes as the longest step needs."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + keys[:1].tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width, first = data[0], np.frombuffer(data, np.uint64, 1, 1)
    steps = np.zeros(((len(data) - 9) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, -1, 9).reshape(-1, width)
    return np.cumsum(np.concatenate([first, steps.view(np.uint64).ravel()]), dtype=np.uint64)


class Frequencies:
    """In how many rows of (text) each shingle occurs. Every row counts.

    A task packs its shingles by ranges of their hashes, and a range is counted at once: no shingle is a row. ``rows``
    are all rows, ``of_features`` what a feature's shingles occur together.
    """

    def __init__(self, docs: DataFrame, size: int) -> None:
        own = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
        self.rows = own["rows"]
        bits = min(FEATURE_BITS, max(3, ((own["bytes"] or 0) // RANGE_BYTES).bit_length()))
        shift, width = np.uint64(64 - bits), FEATURES >> bits

        def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, total = [], 0
            for part in parts:
                for text in part.column("text"):
                    held.append(np.unique(shingles(word_hashes(text.as_py()), size)))
                    total += len(held[-1])
                    if total >= COUNTED:
                        yield cut(np.concatenate(held))
                        held, total = [], 0
            if total:
                yield cut(np.concatenate(held))

        def cut(keys: np.ndarray) -> pa.RecordBatch:
            keys.sort()
            of = keys >> shift
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            rows = [packed(own) for own in np.split(keys, starts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(of[starts].astype(np.int32)), pa.array(rows, pa.binary())], ["piece", "keys"]
            )

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            keys, n = np.unique(np.concatenate([unpacked(own) for own in rows["keys"]]), return_counts=True)
            of = _feature(keys) & (width - 1)
            several = n > 1
            return pd.DataFrame(
                {
                    "piece": rows["piece"].iloc[:1].to_numpy(),
                    "features": [np.bincount(of, n, width).astype(np.int64).tobytes()],
                    "keys": [keys[several].tobytes()],
                    "counts": [n[several].astype(np.int64).tobytes()],
                }
            )

        each = docs.mapInArrow(count, "piece int, keys binary")
        found = each.groupBy("piece").applyInPandas(add, "piece int, features binary, keys binary, counts binary")
        self.made = written(found, "frequencies")
        self.of_features = np.zeros(FEATURES, np.int64)
        for row in self.made.select("piece", "features").toLocalIterator():  # 2 MB in all
            self.of_features[row["piece"] * width : (row["piece"] + 1) * width] = np.frombuffer(row["features"], np.int64)

    def several(self) -> DataFrame:
        """(shingle, n) of those that occur in several rows."""

        def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for packs in zip(part.column("keys"), part.column("counts")):
                    keys, n = (np.frombuffer(own.as_py(), np.int64) for own in packs)
                    for at in range(0, len(keys), BATCH):
                        own = slice(at, at + BATCH)
                        yield pa.RecordBatch.from_arrays([pa.array(keys[own]), pa.array(n[own])], ["shingle", "n"])

        return self.made.select("keys", "counts").mapInArrow(rows, "shingle long, n long")


def inverse_frequencies(frequencies: np.ndarray, rows: int) -> np.ndarray:
    return np.log((rows + 1) / (frequencies + 1)) + 1


class Weigher:
    """A text's shingles in order of their hash, with term frequency times inverse document frequency."""

    def __init__(self, inverse: np.ndarray, size: int) -> None:
        self.inverse, self.size = inverse, size

    def weighted(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, times = np.unique(shingles(words, self.size), return_counts=True)
        return keys, times * self.inverse[_feature(keys)]


def word_key(words: np.ndarray, text: str) -> bytes:
    """Names the sequence of words of a text, or the text itself if it has none."""
    return xxhash.xxh3_128_digest(words.tobytes() if len(words) else b"\0" + text.encode())


def similarity(keys_a, weights_a, keys_b, weights_b) -> float:
    """Weighted Jaccard: the sum of lesser weights over the sum of greater ones."""
    _, a, b = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    both = np.minimum(weights_a[a], weights_b[b]).sum()
    return float(both / (weights_a.sum() + weights_b.sum() - both))


def linked(keys_a, weights_a, keys_b, weights_b, similar: float) -> bool:
    return (1 - similarity(keys_a, weights_a, keys_b, weights_b) - 1e-9) / (1 - similar) <= 1


def possible_pairs(ids: np.ndarray, of: np.ndarray, sums: np.ndarray, sides: np.ndarray, similar: float) -> Iterator[np.ndarray]:
    """(a, b) of the members of a tile that are in different components and may be so similar, a being the lesser id.

    ``sums`` are the weights of their shingles by parts: what two have in common is at most the sum of the lesser ones.
    If the tile is of two blocks, whom ``sides`` tells, only pairs between them are made.
    """
    total = sums.sum(axis=1)
    two = sides.any() and not sides.all()
    for i in range(len(ids)):
        others = (np.flatnonzero(sides) if not sides[i] else np.zeros(0, np.int64)) if two else np.arange(i + 1, len(ids))
        others = others[of[others] != of[i]]
        if len(others):
            both = np.minimum(sums[i], sums[others]).sum(axis=1)
            others = others[both >= (similar - 1e-6) * (total[i] + total[others] - both)]
            yield np.stack([np.minimum(ids[i], ids[others]), np.maximum(ids[i], ids[others])], axis=1)


def near_duplicates(
    docs: DataFrame,
    similar: float = SIMILARITY,
    size: int = SHINGLE,
    rows: int = ROWS,
    bands: int = BANDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, ``text_key``, ``class_id``, ``class_size``, ``keep``, ``twins``.

    A class is a connected group of rows whose words agree or whose five-word shingles, weighted by TF-IDF over all
    rows, have a weighted Jaccard similarity of 0.8 or more. Where rows of several classes then share a band, each class
    counts as one row for the frequencies and the classes are held against each other anew, until nothing more is
    linked: copies are not taken for strangers because there are many of them. Its id is the least doc_id in it, and ``keep`` marks the
    row that has it (the least text key of those that share it). ``twins`` counts the rows that agree in id and text:
    they cannot be told apart, and are all marked. Words are lower-cased letters and digits. A null text is an empty
    one; texts without words are in a class only with equal texts. A text of fewer than five words is one shingle. A
    null id is less than none: it names a class only where all ids are null. An empty table gives no rows. Other
    columns are not read.

    Rows of equal words are one member, so a text of a third of all rows is sampled per row but compared once.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    spark = docs.sparkSession
    frequencies = Frequencies(texts.select("text"), size)
    inverse = spark.sparkContext.broadcast(inverse_frequencies(frequencies.of_features, frequencies.rows))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher, sampler = Weigher(inverse.value, size), Sampler(rows * bands)
        for part in parts:
            keys, all_bands = [], []
            for text in part.column("text"):
                text = text.as_py()
                words = word_hashes(text)
                keys.append(word_key(words, text))
                if len(words):
                    samples = sampler(*weigher.weighted(words)).reshape(bands, rows)
                    all_bands.append([xxhash.xxh3_64_intdigest(bytes([i % 256]) + b.tobytes()) >> 1 for i, b in enumerate(samples)])
                else:
                    all_bands.append([])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(keys, pa.binary()), pa.array(all_bands, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "key", "bands"],
            )

    sketches = written(
        texts.withColumn("text_key", text_key(F.col("text")))
        .select("doc_id", "text_key", "text")
        .mapInArrow(sketch, f"doc_id {kind}, text_key binary, key binary, bands array<long>"),
        "sketches",
    )
    distinct = written(
        sketches.groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.first("bands").alias("bands"))
        .withColumn("id", F.monotonically_increasing_id()),
        "distinct",
    )
    members = distinct.select(F.explode("bands").alias("bucket"), "id")
    vectors = _Vectors(texts, distinct, frequencies, size, similar)
    members = members.withColumn("mark", F.lit(0))
    tied = written(graph.tied(members, lambda a, b: F.lit(True), vectors.near, ROUNDS, vectors.possible), "components")
    tied = vectors.regrouped(tied)
    # Members that nothing is tied to are classes of their own.
    classes = distinct.select("id", "key", "first", "n").join(tied, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    named = classes.groupBy("component").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    of_key = written(classes.join(named, "component").select("key", "class_id", "class_size", "component"), "classes")
    placed = written(
        sketches.select("doc_id", "text_key", "key").join(of_key, "key").select(
            "doc_id", "text_key", "class_id", "class_size", "component"
        ),
        "placed",
    )
    mine = placed.filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = written(
        mine.groupBy("component")
        .agg(F.min("text_key").alias("kept_key"))
        .withColumnRenamed("component", "kept_component"),
        "kept",
    )
    twins = (
        mine.join(kept, (F.col("component") == F.col("kept_component")) & (F.col("text_key") == F.col("kept_key")))
        .groupBy("component")
        .agg(F.count("*").alias("twins"), F.first("kept_key").alias("kept_key"))
    )
    twins = written(twins, "twins")
    keep = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("kept_key"))
    return placed.join(twins, "component").select(
        F.col("doc_id").alias(id_column),
        "text_key",
        "class_id",
        "class_size",
        keep.alias("keep"),
        F.when(keep, F.col("twins")).otherwise(F.lit(None)).alias("twins"),
    )


class _Vectors:
    """The weighted shingles of members, made when a pair first asks for them."""

    def __init__(self, texts: DataFrame, distinct: DataFrame, frequencies: Frequencies, size: int, similar: float) -> None:
        self.texts, self.distinct, self.frequencies, self.size, self.similar = texts, distinct, frequencies, size, similar
        self.made: DataFrame | None = None

    def _make(self, asked: DataFrame) -> DataFrame:
        size = self.size

        def vector(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                names, keys, times = [], [], []
                for text in part.column("text"):
                    text = text.as_py()
                    words = word_hashes(text)
                    own, n = np.unique(shingles(words, size), return_counts=True)
                    names.append(word_key(words, text))
                    keys.append(own.view(np.int64))
                    times.append(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                    ["key", "keys", "times"],
                )

        wanted = written(asked.join(self.distinct, "id").select("id", "key", "first"), "wanted")
        rows = chosen_rows(self.texts, wanted.select(F.col("first").alias("doc_id")), "doc_id")
        counts = written(
            rows.select("text")
            .mapInArrow(vector, "key binary, keys array<long>, times array<int>")
            .join(wanted.select("id", "key"), "key")
            .groupBy("id")
            .agg(F.first(F.struct("keys", "times")).alias("own")),  # all rows of an id have the same words
            "counts",
        )
        each = counts.select("id", F.explode(F.arrays_zip("own.keys", "own.times")).alias("z")).select(
            "id", F.col("z.keys").alias("shingle"), F.col("z.times").alias("times")
        )
        # A shingle without a row is of one document.
        n = F.coalesce("n", F.lit(1)).alias("n")
        counted = each.join(self.frequencies.several(), "shingle", "left").select("id", "shingle", "times", n)
        return self._weighted(counted, self._inverse(F.col("n")), F.col("n"))

    def _inverse(self, n: Column) -> Column:
        return F.log((F.lit(self.frequencies.rows) + 1) / (n + 1)) + 1

    def _weighted(self, counted: DataFrame, inverse: Column, *more: Column) -> DataFrame:
        """(id, keys, weights, ...) of rows (id, shingle, times, ...): the shingles of a member."""
        weight = (F.col("times") * inverse).cast("float").alias("weight")
        vectors = counted.select("id", F.struct("shingle", weight, *more).alias("z")).groupBy("id").agg(
            F.collect_list("z").alias("z")  # the shingles of one text
        )
        names = {"shingle": "keys", "weight": "weights", "n": "rows"}
        found = [f for f in vectors.schema["z"].dataType.elementType.names]
        return written(vectors.select("id", *[F.col(f"z.{f}").alias(names[f]) for f in found]), "vectors")

    def regrouped(self, of: DataFrame) -> DataFrame:
        """(id, component): the components ``of``, and what links them once a class counts as one row.

        A frequency counts the rows of a class of copies one by one, so the more copies there are, the less weighs what
        they have in common. Here it loses, for each class that shares a bucket with another, all rows but one of those
        that have the shingle. Only members of such buckets are weighed again. The links found make larger classes, and what
        meets them is held against them again, until there are none.
        """
        met: DataFrame | None = None
        while True:
            component = F.coalesce("component", "id").alias("of")
            if met is None:
                copies = (F.col("component").isNotNull() | (F.col("n") > 1)).alias("grown")
                members = self.distinct.join(of, "id", "left").select(F.explode("bands").alias("bucket"), "id", component, copies)
            else:
                now = of.join(asked, "id").select("id", "component", (F.col("component") != F.col("of")).alias("other"))
                grown = now.groupBy("component").agg(F.max("other").alias("grown")).filter("grown")
                members = met.select("bucket", "id").join(now.drop("other").join(grown, "component", "left"), "id", "left").select(
                    "bucket", "id", component, F.coalesce("grown", F.lit(False)).alias("grown")
                )
            sides = members.groupBy("bucket").agg(F.min("of").alias("x"), F.max("of").alias("y"), F.max("grown").alias("grown"))
            mixed = sides.filter("x <> y and grown").select("bucket")
            met = written(members.join(mixed, "bucket", "left_semi").select("bucket", "id", "of"), "met")
            if graph.is_empty(met):
                return of
            asked = written(met.select("id", "of").distinct(), "asked")
            classes = self.distinct.select("id", "n").join(of, "id", "left").select("id", "n", component)
            inside = written(classes.join(asked.select("of").distinct(), "of", "left_semi"), "classes")
            each = self.made.join(inside, "id").select("of", "n", F.explode(F.arrays_zip("keys", "rows")).alias("z"))
            of_class = each.groupBy("of", F.col("z.keys").alias("shingle")).agg(F.sum("n").alias("n"), F.first("z.rows").alias("rows"))
            less = written(
                of_class.filter("n > 1").groupBy("shingle").agg((F.first("rows") - F.sum(F.col("n") - 1)).alias("fewer")),
                "fewer",
            )
            zipped = F.explode(F.arrays_zip("keys", "weights", "rows")).alias("z")
            own = self.made.join(asked, "id").select("id", zipped).select(
                "id", F.col("z.keys").alias("shingle"), F.col("z.weights").alias("weight"), F.col("z.rows").alias("n")
            )
            counted = own.join(less, "shingle", "left").select(
                "id", "shingle", (F.col("weight") / self._inverse(F.col("n"))).alias("times"), F.coalesce("fewer", "n").alias("n")
            )
            again = _Vectors(self.texts, self.distinct, self.frequencies, self.size, self.similar)
            again.made = self._weighted(counted, self._inverse(F.col("n")))
            found = written(again.possible(met.select("bucket", "id", "of")).distinct(), "links")
            if graph.is_empty(found):
                return of
            of = graph.more(of, found)

    def possible(self, left: DataFrame) -> DataFrame:
        """Links (a, b) that tie together what all pairs of members (bucket, id, of) of different components would.

        A bucket is cut into blocks, and every two of them, or one with itself, are a tile: a member is a row for each
        block of its bucket, not for each other member. Pairs of a tile that the weights by parts leave possible are
        measured there; one that is a link makes one component of two, so a tile hands on fewer links than it has
        members. Members without a link to their leader have been measured, so their weights are known.
        """
        similar = self.similar
        sized = left.join(self.made.select("id", F.size("keys").alias("n")), "id")
        blocks = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)))
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        dealt = left.join(sized.groupBy("bucket").agg(blocks.cast("int").alias("blocks")), "bucket").withColumn("own", own)
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tiles = dealt.join(self.made, "id").select(
            "bucket",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "id",
            "of",
            "keys",
            "weights",
            (F.col("own") > F.col("other")).alias("side"),
        )

        def links(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: pa.Table | None = None
            for part in parts:
                rows = pa.Table.from_batches([part])
                held = rows if held is None else pa.concat_tables([held, rows])
                ends = starts_of(held)
                yield from met(held.slice(0, ends[-1]), ends)
                held = held.slice(ends[-1])
            if held is not None and held.num_rows:
                yield from met(held, np.append(starts_of(held), held.num_rows))

        def starts_of(rows: pa.Table) -> np.ndarray:
            keys = np.stack([rows.column(n).to_numpy().astype(np.int64) for n in ("bucket", "i", "j")])
            return np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])

        def met(rows: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in zip(edges, edges[1:]):
                found = tied_in_tile(rows.slice(a, b - a))
                if found:
                    made = np.array(found, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], ["a", "b"])

        def tied_in_tile(tile: pa.Table) -> list[tuple[int, int]]:
            ids, sides = (tile.column(n).to_numpy() for n in ("id", "side"))
            of = tile.column("of").to_numpy().copy()
            keys = [own.values.to_numpy() for own in tile.column("keys")]
            weights = [own.values.to_numpy().astype(float) for own in tile.column("weights")]
            sums = np.stack([np.bincount(k & (PARTS - 1), w, PARTS) for k, w in zip(keys, weights)])
            at = {own: row for row, own in enumerate(ids.tolist())}
            found = []
            for pairs in possible_pairs(ids, of, sums, sides, similar):
                for x, y in pairs.tolist():
                    a, b = at[x], at[y]
                    if of[a] != of[b] and linked(keys[a], weights[a], keys[b], weights[b], similar):
                        found.append((x, y))
                        of[of == of[b]] = of[a]
            return found

        dealt = tiles.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        return dealt.mapInArrow(links, "a long, b long")

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of a similarity that makes a link."""
        asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        if self.made is None:
            self.made = self._make(asked)
        else:
            new = written(asked.join(self.made.select("id"), "id", "left_anti"), "asked")
            if new.take(1):
                self.made = self.made.unionByName(self._make(new))
        similar = self.similar

        def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                sides = [part.column(n) for n in ("keys_a", "weights_a", "keys_b", "weights_b")]
                near = []
                for row in zip(*sides):
                    ka, wa, kb, wb = (side.values.to_numpy() for side in row)
                    near.append(linked(ka, wa.astype(float), kb, wb.astype(float), similar))
                yield part.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

        def side(n: str) -> DataFrame:
            return self.made.select(F.col("id").alias(n), F.col("keys").alias(f"keys_{n}"), F.col("weights").alias(f"weights_{n}"))

        both = pairs.join(side("b"), "b").join(side("a"), "a")
        return both.select("a", "b", "keys_a", "weights_a", "keys_b", "weights_b").mapInArrow(compare, "a long, b long")
