"""Benchmark decontamination: token windows of documents against a broadcast hash set of benchmark n-grams."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window; benchmark bytes that one broadcast may hold; bytes of text looked at together.
WINDOW, BLOCK_BYTES, CHUNK = 10, 16 << 20, 1 << 20
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: what is not ASCII, and letters and digits
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, a piece of it at a time."""
    raw = text.encode().lower()  # of bytes: A-Z only
    at = 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        if end < len(raw):  # on to the end of the word
            rest = WORD.match(raw, end)
            end = rest.end() if rest else end
        yield WORD.findall(raw, at, end)
        at = end


class Windows:
    """The windows of some benchmark items: words numbered, windows hashed, and the items that have each."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int) -> None:
        self.number: dict[bytes, int] = {}
        self.has: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for part in words_of(text or "") for w in part]
            for i in range(max(1, len(ids) - n + 1) if ids else 0):
                found = self.has[tuple(ids[i : i + n])]
                if item_id is not None:
                    found.add(item_id)
        by_length = defaultdict(list)
        for window in self.has:
            by_length[len(window)].append(window)
        self.hashes = {
            size: np.unique(np.concatenate([rolled(np.array(w, np.uint64), size) for w in windows]))
            for size, windows in by_length.items()
        }

    def scan(self, text: str) -> tuple[int, np.ndarray, set[str]]:
        """How many words a text has, which of them are hit, and the items whose windows occur."""
        get = self.number.get
        parts = [np.fromiter((get(w, 0) for w in part), np.uint64, len(part)) for part in words_of(text)]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        hit, items = np.zeros(len(ids), bool), set()
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            # Only windows all of whose words the benchmark knows can be in the set.
            known = np.cumsum(np.concatenate([[0], ids != 0]))
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            keys = rolled(ids, size)[at]
            place = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
            for i in at[hashes[place] == keys]:
                found = self.has.get(tuple(ids[i : i + size].tolist()))  # the hit is verified word by word
                if found is not None:
                    hit[i : i + size] = True
                    items |= found
        return len(ids), hit, items


def rolled(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of ``size`` numbers."""
    n = len(ids) - size + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for i in range(size):
            total = total * BASE + ids[i : i + n]
        return total ^ (total >> np.uint64(31))


def benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> Iterator[list]:
    """The benchmark in blocks of bounded size, fetched one at a time."""
    block, held = [], 0
    rows = benchmark.select(F.col(id_column).cast("string"), F.col(text_column).cast("string")).toLocalIterator()
    for item_id, text in rows:
        block.append((item_id, text))
        held += len((text or "").encode())
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def scan_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    text_column: str = "text",
    item_columns: tuple[str, str] = ("item_id", "text"),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with n_words, n_hit, item_ids and ``hit``, a bit per word.

    A window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window. Words are
    lower-cased over A-Z. A null text has no words. Windows of an item without an id hit words and name no item; items
    that share an id are one item. Repeated rows and null ids are rows like others. Without documents there are no
    rows, without benchmark no hits. As the row travels in a struct, no name of it can clash.

    Every document is scanned against a broadcast set of at most ``block_bytes`` of benchmark text. A larger benchmark
    is taken in blocks, one scan after the other, and each adds its hits to those that the row carries.
    """
    context = docs.sparkSession.sparkContext
    found = docs.select(
        F.struct("*").alias("row"),
        F.col(text_column).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("item_ids"),
        F.lit(None).cast("binary").alias("hit"),
    )
    scanned = None
    for block in benchmark_blocks(benchmark, *item_columns, block_bytes):
        scanned = _scan(found if scanned is None else scanned, context.broadcast(Windows(block, n)))
    return _scan(found, context.broadcast(Windows([], n))) if scanned is None else scanned


def _scan(found: DataFrame, windows) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words, counts, items, bits = [], [], [], []
            for text, hit, known in zip(part.column("text"), part.column("hit"), part.column("item_ids")):
                total, own, names = windows.value.scan(text.as_py() or "")
                if hit.is_valid:
                    own = own | np.unpackbits(np.frombuffer(hit.as_py(), np.uint8), count=total).astype(bool)
                words.append(total)
                counts.append(int(own.sum()))
                items.append(sorted(names.union(known.as_py())))
                bits.append(np.packbits(own).tobytes())
            new = {"n_words": words, "n_hit": counts, "item_ids": items, "hit": bits}
            columns = [
                pa.array(new[field.name], field.type) if field.name in new else part.column(i)
                for i, field in enumerate(part.schema)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return found.mapInArrow(run, found.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, item_ids, contaminated. Cases as in ``scan_documents``."""
    found = scan_documents(docs.select(id_column, options.get("text_column", "text")), benchmark, **options)
    return found.select(
        F.col(f"row.{id_column}"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents, or, with ``remove="spans"``, without the words that are hit.

    A span goes from the first to the last of consecutive words that are hit. Cases as in ``scan_documents``; a row
    with a null text stays as it is.
    """
    found = scan_documents(docs, benchmark, **options)
    if remove == "documents":
        return found.filter(F.col("n_hit") == 0).select("row.*")
    if remove != "spans":
        raise ValueError("remove is documents or spans")
    column = options.get("text_column", "text")
    cut = found.mapInArrow(_cut, found.schema)
    clean = F.when(F.col("n_hit") > 0, F.col("text")).otherwise(F.col(f"row.{column}"))
    return cut.select(F.col("row").withField(column, clean).alias("row")).select("row.*")


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts = []
        for text, hit, n in zip(part.column("text"), part.column("hit"), part.column("n_hit")):
            text = text.as_py()
            if n.as_py():
                text = without(text, np.unpackbits(np.frombuffer(hit.as_py(), np.uint8)))
            texts.append(text)
        place = part.schema.get_field_index("text")
        columns = [pa.array(texts, f.type) if i == place else part.column(i) for i, f in enumerate(part.schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=part.schema)


def without(text: str, hit: np.ndarray) -> str:
    """The text without its runs of words that are hit."""
    raw = text.encode()
    kept, at, start, last = [], 0, None, 0
    for i, word in enumerate(WORD.finditer(raw.lower())):
        if hit[i]:
            start = word.start() if start is None else start
            last = word.end()
        elif start is not None:
            kept.append(raw[at:start])
            at, start = last, None
    if start is not None:
        kept.append(raw[at:start])
        at = last
    return b"".join([*kept, raw[at:]]).decode()


def items_digest(items: str = "item_ids") -> Column:
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)
