"""Substring dedup by sliding sentence spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwave.llm.common import text_key, text_of, written
from ledgerwave.llm.cuts import cut_texts

#: A span has at least so many sentences and words; a span of LONG words may have fewer sentences.
SENTENCES, WORDS, LONG = 5, 30, 35
#: Sentences with so many blanks are cut in parts, after commas and colons, words of ten letters and words with a k in front.
PART = 12

#: A sentence: up to closing marks before white space, to the end of the line, or to the end of the text.
_SENTENCE = re.compile(r"[^\n]+?(?:[.!?]+(?=\s)|(?=\n)|\Z)\s*|\n+")
#: Where a long sentence is cut: what stands there decides, so a passage is cut alike wherever it stands.
_CUT = re.compile(r"[,;:]\s+|(?<!\S)(?:\S{10}|[kK]\S*)\s+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Where the sentences of a text, or the parts of long ones, begin and end, white space that follows included.

    Together they are the text. What begins or ends in mid-sentence still has whole parts.
    """
    found = []
    for m in _SENTENCE.finditer(text):
        start, end = m.span()
        if text.count(" ", start, end) >= PART:
            for cut in _CUT.finditer(text, start, end):
                if cut.end() < end:
                    found.append((start, cut.end()))
                    start = cut.end()
        found.append((start, end))
    return found


class Spans:
    """How spans are taken."""

    def __init__(self, at_least: int = SENTENCES, words: int = WORDS, long: int = LONG) -> None:
        self.at_least, self.words, self.long = at_least, words, long

    def of(self, text: str) -> list[tuple[int, int, bytes]]:
        """First sentence, sentence after the last, and hash of the shortest spans from and up to every sentence.

        A longer run is covered by those that begin in it and those that end in it: if it has occurred, they have.
        Sentences are compared in lower case with one blank for white space. Stretches without a word count for nothing.
        """
        places, counts, digests = [], [0], []
        for i, (start, end) in enumerate(sentences(text)):
            words = text[start:end].lower().split()
            if words:
                places.append(i)
                counts.append(counts[-1] + len(words))
                digests.append(xxhash.xxh3_64_digest(" ".join(words).encode()))
        packed, found, end = b"".join(digests), set(), 0
        for i in range(len(places)):
            end = max(end, i + 1)
            while end <= len(places) and not self._enough(end - i, counts[end] - counts[i]):
                end += 1
            if end > len(places):
                break
            found.add((i, end))
        start = 0
        for end in range(1, len(places) + 1):
            while start < end and self._enough(end - start, counts[end] - counts[start]):
                start += 1
            if start:
                found.add((start - 1, end))
        return [(places[i], places[j - 1] + 1, xxhash.xxh3_128_digest(packed[8 * i : 8 * j])) for i, j in sorted(found)]

    def _enough(self, sentences_: int, words: int) -> bool:
        return (sentences_ >= self.at_least and words >= self.words) or words >= self.long

    def without(self, text: str, numbers: list[int]) -> tuple[str, int]:
        """The text without the sentences of the spans of these numbers in ``of``, and how many those are."""
        gone, wanted = set(), set(numbers)
        for number, (start, end, _) in enumerate(self.of(text)):
            if number in wanted:
                gone.update(range(start, end))
        places = sentences(text)
        kept = "".join(text[a:b] for i, (a, b) in enumerate(places) if i not in gone)
        return kept, len(gone)


def repeated_spans(docs: DataFrame, spans: Spans | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, parts): the numbers of the spans that have occurred before, for rows with any.

    The first of equal spans is the one of the least doc_id, then text, then place. A null id is less than none. Rows
    that agree in id and text are one document. Spans are joined by a 128-bit hash; occurrences of one are counted
    before the shuffle, and the rows of a frequent one can be split, as it is a plain join key.
    """
    spans = spans or Spans()
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            numbers, hashes = [], []
            for text in part.column("text"):
                own = spans.of(text.as_py())
                numbers.append(range(len(own)))
                hashes.append([h for _, _, h in own])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array(numbers, pa.list_(pa.int32())),
                    pa.array(hashes, pa.list_(pa.binary())),
                ],
                ["doc_id", "text_key", "numbers", "hashes"],
            )

    rows = written(
        texts.withColumn("text_key", text_key(F.col("text")))
        .select("doc_id", "text_key", "text")
        .mapInArrow(hashed, f"doc_id {kind}, text_key binary, numbers array<int>, hashes array<binary>")
        .withColumn("row", F.monotonically_increasing_id()),
        "spans",
    )
    # A number for each pair of id and text, in their order as far as it decides which occurrence is first.
    names = written(rows.groupBy("doc_id", "text_key").agg(F.min("row").alias("row")), "names")
    own = rows.join(names.select("row"), "row", "left_semi") if _repeated(rows, names) else rows
    each = own.select(
        "doc_id", "row", F.explode(F.arrays_zip("numbers", "hashes")).alias("z")
    ).select("doc_id", "row", F.col("z.numbers").alias("nth"), F.col("z.hashes").alias("hash"))
    again = written(
        each.groupBy("hash")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "nth")).alias("first"))
        .filter("n > 1")
        .select("hash", F.col("first.row").alias("first_row"), F.col("first.nth").alias("first_nth")),
        "repeated",
    )
    later = (
        each.select("row", "nth", "hash")
        .join(again, "hash")
        .filter((F.col("row") != F.col("first_row")) | (F.col("nth") != F.col("first_nth")))
        .groupBy("row")
        .agg(F.collect_set("nth").alias("parts"))  # at most two for each sentence of one text
    )
    return written(later.join(names, "row").select("doc_id", "text_key", "parts"), "cuts")


def _repeated(rows: DataFrame, names: DataFrame) -> bool:
    return rows.count() > names.count()


def dedup_spans(docs: DataFrame, spans: Spans | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` as the struct ``row``, its text without repeated sentences, and ``removed``, how many have gone.

    Every sentence goes that is in a run which has occurred before, in this document or one of a lower id. A run is
    made of consecutive whole sentences, or parts of those with more than twelve words, at least five with thirty
    words or any with thirty-five words. The shortest ones from each sentence on and up to each sentence cover all
    longer ones. A null text has no sentence and stays null; a text may become empty, its row stays. Whole texts count,
    however long. Rows that agree in id and text are one document and stay alike. An empty table gives no rows. As the
    row travels in a struct, no name of it can clash.
    """
    spans = spans or Spans()
    cuts = repeated_spans(docs, spans, id_column, text_column)
    return cut_texts(docs, cuts, spans.without, id_column, text_column)
