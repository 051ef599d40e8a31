"""Token counts: pieces are counted once per distinct pre-token and summed over each document's pre-token counts."""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwave.llm.common import text_of, written

LIMIT = 2048
#: The most frequent pre-tokens that are broadcast, and the bytes such a one may have: at most 32 MB together.
FREQUENT, FREQUENT_BYTES = 500_000, 64
#: Pre-tokens whose pieces are counted in one call.
CALL = 4096

#: Unicode white space, fixed values. str.split() would also cut at U+001C to U+001F, which are none.
_SPLIT = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def pre_tokens(text: str) -> list[str]:
    """The runs of a text without white space.

    A tokenizer that drops white space, and whose normaliser and added tokens do not reach over it, makes of a text
    what it makes of these one by one.
    """
    return _SPLIT.findall(text) if _SEPARATORS.search(text) else text.split()


class Pieces:
    """The tokenizer of one task."""

    def __init__(self, content: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def count(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def vocabulary(docs: DataFrame, tokenizer) -> DataFrame:
    """(token, n, pieces): every distinct pre-token of the corpus, how often it occurs and how many pieces it makes.

    Counts are added up per task before they are shuffled, so a word that is a tenth of all words is a row per task.
    """

    def counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for part in parts:
            for text in part.column("text"):
                seen.update(pre_tokens(text.as_py()))
                if len(seen) > 400_000:  # bounds the memory of a task
                    yield from _emit(seen)
                    seen = Counter()
        yield from _emit(seen)

    def _emit(seen: Counter[str]) -> Iterator[pa.RecordBatch]:
        words, n = list(seen), list(seen.values())
        for at in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[at : at + 50_000], pa.string()), pa.array(n[at : at + 50_000], pa.int64())],
                ["token", "n"],
            )

    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(tokenizer.value)
        for part in parts:
            words = part.column("token").to_pylist()
            made = [n for at in range(0, len(words), CALL) for n in own.count(words[at : at + CALL])]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.int32())], ["token", "n", "pieces"])

    distinct = (
        docs.select(text_of().alias("text"))
        .mapInArrow(counts, "token string, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )
    return written(distinct.mapInArrow(pieces, "token string, n long, pieces int"), "vocabulary")


def _least_count(known: DataFrame, frequent: int) -> int:
    """The count from which on there are at most ``frequent`` pre-tokens, from how many there are of each magnitude."""
    steps = 16  # a doubling
    magnitude = F.floor(F.log2("n") * steps)
    held, least = 0, None
    rows = known.groupBy(magnitude.alias("m")).agg(F.count("*").alias("tokens"), F.min("n").alias("least")).collect()
    for row in sorted(rows, key=lambda r: -r["m"]):  # at most 64 * steps rows
        held += row["tokens"]
        if held > frequent:
            break
        least = row["least"]
    return (1 << 62) if least is None else least


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    limit: int = LIMIT,
    frequent: int = FREQUENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_tokens, over_limit, for a tokenizer that drops white space.

    At most ``frequent`` pre-tokens, the most frequent of the corpus, reach every task; a document's other pre-tokens are joined
    to the vocabulary by a shuffle, and are few for each. No ids are made, only counts. A null text is an empty one and
    has no tokens; null and repeated ids are kept as they are; rows that repeat both id and text are all returned. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    known = vocabulary(rows, content)
    top = (
        known.filter(F.octet_length("token") <= FREQUENT_BYTES)
        .filter(F.col("n") >= _least_count(known, frequent))
        .select("token", "pieces")
        .toArrow()
    )
    lookup = dict(zip(top.column("token").to_pylist(), top.column("pieces").to_pylist()))
    hot = spark.sparkContext.broadcast(lookup)

    def per_document(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = hot.value
        find = pieces.get
        for part in parts:
            keys, sizes, sums, rest, times = [], [], [], [], []
            for text in part.column("text"):
                text = text.as_py()
                raw = text.encode()
                words = pre_tokens(text)
                found = list(map(find, words))
                keys.append(xxhash.xxh3_128_digest(raw))
                sizes.append(len(raw))
                if None in found:
                    missing = Counter(w for w, n in zip(words, found) if n is None)
                    rest.append(list(missing))
                    times.append(list(missing.values()))
                    sums.append(sum(n for n in found if n is not None))
                else:
                    rest.append([])
                    times.append([])
                    sums.append(sum(found))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(rest, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                ["doc_id", "key", "n_bytes", "n_hot", "rest", "times"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = written(
        rows.select("doc_id", text_of().alias("text")).mapInArrow(
            per_document,
            f"doc_id {kind}, key binary, n_bytes long, n_hot long, rest array<string>, times array<long>",
        ),
        "counted",
    )
    own = counted.select("doc_id", "key", "n_bytes", F.col("n_hot").alias("n"), F.lit(1).alias("copies"))
    tail = (
        counted.filter(F.size("rest") > 0)
        .select("doc_id", "key", "n_bytes", F.explode(F.arrays_zip("rest", "times")).alias("z"))
        .select("doc_id", "key", "n_bytes", F.col("z.rest").alias("token"), F.col("z.times").alias("times"))
        .join(known.select("token", "pieces"), "token")
        .select("doc_id", "key", "n_bytes", (F.col("times") * F.col("pieces")).alias("n"), F.lit(0).alias("copies"))
    )
    # Rows of one id and text have the same counts: their sum is shared out again.
    summed = (
        own.unionByName(tail).groupBy("doc_id", "key", "n_bytes").agg(F.sum("n").alias("n"), F.sum("copies").alias("copies"))
    )
    each = F.expr("cast(n div copies as bigint)")
    return summed.select(
        F.col("doc_id").alias(id_column),
        "n_bytes",
        each.alias("n_tokens"),
        (each > limit).alias("over_limit"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
