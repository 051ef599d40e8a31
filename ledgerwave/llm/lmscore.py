"""Language-model scores: smoothed n-grams of the corpus as a weighted backoff automaton, walked once along each text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.llm.common import text_of, written
from ledgerwave.llm.words import mixed

#: Words of the longest n-gram; bytes of text looked at together; tokens of a text walked at a time.
ORDER, BATCH_BYTES, STRETCH = 3, 8 << 20, 1 << 16
#: How many occurrences the next shorter context counts for, in contexts of one word, of two, and so on.
STRENGTH = (100.0, 10.0, 5.0, 5.0)
#: Bits of a name beyond those that number the bytes of all texts: so rare (2^-24) is a name shared by chance.
SPARE_BITS, MOST_BITS = 24, 63
#: Characters cut into words at a time.
PIECE = 1 << 20
#: Names of what is no word: a word has no space.
BEGIN, END = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" begin", b" end"))
_ODD, _EVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFFFFFFFFFE)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: the bytes of equal weight next to each other, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(width, -1)
    values = np.zeros((raw.shape[1], 8), np.uint8)
    values[:, :width] = raw.T
    return values.view("<u8").ravel()


def named(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(MOST_BITS - bits) & _EVEN


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the differences between neighbours."""
    return np.diff(keys, prepend=np.uint64(0))


def _names(words: list[bytes]) -> np.ndarray:
    coded = pa.array(words, pa.binary()).dictionary_encode()
    known = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    return np.array(known, np.uint64)[coded.indices.to_numpy()]


@dataclass
class Texts:
    """The documents of a batch as numbers, each with a mark before and after its words.

    ``starts`` are the places of the marks before, and one more for the end.
    """

    names: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Texts:
        starts, names, words = np.zeros(len(texts) + 1, np.int64), [], []
        held = 0
        for i, text in enumerate(texts):
            words.append(b" begin")
            words += text.encode().lower().split()  # of bytes: A-Z only, ASCII white space only
            words.append(b" end")
            starts[i + 1] = len(words) + sum(map(len, names))
            held += len(text)
            if held >= PIECE or i == len(texts) - 1:
                names.append(_names(words))
                held, words = 0, []
        return cls(np.concatenate([np.zeros(0, np.uint64), *names]), starts)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def grams(self, order: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For n of 1 to ``order``, the places where an n-gram ends and its name, made of its first words' and its last.

        A name has ``bits`` bits and a zero after them.
        """
        within = np.arange(len(self.names)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        keys = mixed(self.names)
        for n in range(1, order + 1):
            if n > 1:
                with np.errstate(over="ignore"):
                    keys = np.concatenate([keys[:1], mixed(keys[:-1] * _ODD + self.names[1:])])
            at = np.flatnonzero(within >= n - 1)
            yield at, named(keys[at], bits)


def packed_documents(docs: DataFrame, held_out: Column, id_column: str, text_column: str, batch_bytes: int) -> DataFrame:
    """(batch, docs): documents as compressed Arrow streams of about ``batch_bytes`` of text, a written table."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for rows in _batches(parts, batch_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(rows)
            blob = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + n]), blob], ["batch", "docs"])
            n += 1

    rows = docs.select(F.col(id_column).alias("doc_id"), held_out.alias("held_out"), text_of(text_column).alias("text"))
    return written(rows.mapInArrow(pack, "batch long, docs binary"), "batches")


def _batches(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for part in parts:
        sizes = np.cumsum(pc.binary_length(part.column("text")).to_numpy())
        first = 0
        while first < part.num_rows:
            done = int(sizes[first - 1]) if first else 0
            last = min(int(np.searchsorted(sizes, done + most - size)) + 1, part.num_rows)
            held.append(part.slice(first, last - first))
            size += int(sizes[last - 1]) - done
            first = last
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _opened(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all()


def asked(batches: DataFrame, order: int, spans: int, bits: int) -> DataFrame:
    """(span, n, batch, keys, counts): the n-grams of every batch, each once, with their number in what is learnt from.

    A span is one of equal parts of all names, so n-grams are dealt evenly whatever words are frequent.
    """
    edges = np.array([(i << bits + 1) // spans for i in range(1, spans)], np.uint64)

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch, blob in zip(part.column("batch"), part.column("docs")):
                rows = _opened(blob.as_py())
                texts = Texts.of(rows.column("text").to_pylist())
                learnt = ~rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                learnt = learnt[texts.owner()].astype(np.uint64)
                found = []
                for n, (at, keys) in enumerate(texts.grams(order, bits), 1):
                    marked = np.sort(keys | learnt[at])
                    keys = marked & _EVEN
                    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
                    counts = np.add.reduceat(marked & np.uint64(1), first) if len(first) else keys
                    keys = keys[first]
                    cuts = [0, *np.searchsorted(keys, edges), len(keys)]
                    for span, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if a < b:
                            found.append((span, n, batch.as_py(), squeezed(_steps(keys[a:b])), squeezed(counts[a:b])))
                types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                yield pa.RecordBatch.from_arrays(columns, ["span", "n", "batch", "keys", "counts"])

    return batches.mapInArrow(ask, "span int, n int, batch long, keys binary, counts binary")


def answered(questions: DataFrame, bits: int) -> DataFrame:
    """(batch, span, n, counts, distinct, tokens): the corpus' counts in the order of each batch's own n-grams.

    A row without batch sums the words of a span up. A span holds about ``BATCH_BYTES`` of names of one length.
    """
    begin = int(named(mixed(np.array([BEGIN])), bits)[0])

    def answer(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(unsqueezed(k.as_py()), dtype=np.uint64) for k in rows.column("keys")]
        ends = np.cumsum([len(k) for k in keys])
        keys = np.concatenate(keys)
        counts = np.concatenate([unsqueezed(c.as_py()) for c in rows.column("counts")])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.diff(keys, prepend=~keys[:1]) != 0
        first = np.flatnonzero(new)
        totals = np.add.reduceat(counts[order], first)
        everywhere = np.empty(len(keys), np.uint64)
        everywhere[order] = totals[np.cumsum(new) - 1]
        replies = [squeezed(everywhere[a:b]) for a, b in zip([0, *ends], ends)]
        word = (totals > 0) & (keys[first] != begin)
        span, n = rows.column("span")[0].as_py(), rows.column("n")[0].as_py()
        m = len(replies)
        return pa.table(
            {
                "batch": pa.array([*rows.column("batch").to_pylist(), None], pa.int64()),
                "span": pa.array([span] * (m + 1), pa.int32()),
                "n": pa.array([n] * (m + 1), pa.int32()),
                "counts": pa.array([*replies, None], pa.binary()),
                "distinct": pa.array([None] * m + [int(word.sum())], pa.int64()),
                "tokens": pa.array([None] * m + [int(totals[word].sum())], pa.int64()),
            }
        )

    schema = "batch long, span int, n int, counts binary, distinct long, tokens long"
    return questions.groupBy("span", "n").applyInArrow(answer, schema)


class Automaton:
    """The part of the backoff automaton that a batch of texts can reach.

    States are the contexts that the corpus has, up to ``order`` - 1 words. A state has an arc for every word that
    follows it in the corpus, weighted with the smoothed log10 probability, to the longest context that the words then
    make; and a failure arc, weighted with what the state leaves to shorter contexts, to the context without its first
    word. The root has an arc for every word, the unknown ones too, which lead back to it. An arc is numbered like the
    n-gram of the state's words and its own.
    """

    def __init__(
        self, texts: Texts, bits: int, counts: list[np.ndarray], strength: tuple[float, ...], distinct: int, tokens: int
    ) -> None:
        size = len(texts.names)
        self.texts, self.order = texts, len(counts)
        self.arc, self.weight, self.leave = [], [], []
        below = None
        for n, (at, keys) in enumerate(texts.grams(self.order, bits), 1):
            order = np.argsort(keys, kind="stable")
            new = np.diff(keys[order], prepend=~keys[order][:1]) != 0
            number = np.empty(len(keys), np.int32)
            number[order] = np.cumsum(new) - 1
            first = at[order[new]]  # a place where each n-gram ends
            own = counts[n - 1].astype(np.float64)
            if len(own) != len(first):
                raise ValueError("a batch has not got all its counts")
            arc = np.full(size, -1, np.int32)
            arc[at] = number
            if n == 1:
                chance = (own + 1) / (tokens + distinct + 1)
            else:
                few = strength[n - 2]
                context = below[0][self.arc[-1][first - 1]]
                chance = (own + few * below[1][self.arc[-1][first]]) / (context + few)
                leave = np.log10(few / (below[0] + few))
                self.leave.append(leave)
                arc[at[own[number] == 0]] = -1
            self.arc.append(arc)
            self.weight.append(np.log10(chance))
            below = own, chance
            if n == 1:
                self.seen = own > 0

    def walk(self, first: int, last: int) -> float:
        """The log10 probability of the words at places ``first`` + 1 to ``last`` - 1, from the state of the mark before.

        The words of a state are the last ones read, so its depth says which it is.
        """
        total, deepest = 0.0, self.order - 1
        depth = min(deepest, int(self.seen[self.arc[0][first]]))
        for begin in range(first + 1, last, STRETCH):
            end = min(begin + STRETCH, last)
            known = self.seen[self.arc[0][begin:end]].tolist()
            arcs = [np.where(a[begin:end] < 0, np.nan, w[a[begin:end]]).tolist() for a, w in zip(self.arc, self.weight)]
            leaves = [[0.0] * (end - begin), *(v[a[begin - 1 : end - 1]].tolist() for a, v in zip(self.arc, self.leave))]
            for i, word in enumerate(known):
                weight = arcs[depth][i]
                while weight != weight:  # no such arc: fail to the context without its first word
                    total += leaves[depth][i]
                    depth -= 1
                    weight = arcs[depth][i]
                total += weight
                if depth < deepest:
                    depth = depth + 1 if word else 0
        return total


def scores(
    docs: DataFrame,
    held_out: Column,
    order: int = ORDER,
    strength: tuple[float, ...] = STRENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end. The model is learnt from all rows
    that are not held out: an n-gram's probability is (c + s p) / (C + s), where c and C count it and its context,
    p is the probability in the context without its first word, and s is ``strength``; a word's is (c + 1) / (N + V + 1)
    for N tokens of which V are distinct, which makes ``base_score``. These sum to 1 over all words and an unknown one.

    Texts are packed into batches. A batch sends each of its n-grams once to the span of names it belongs to and gets
    the corpus' count back, so the model is never in one place, no word or context gathers in one task, and the walk
    needs the batch's own part of the automaton only. N-grams go by names of 24 bits more than number the bytes of
    all texts (63 at most), so that less than one count in 2^24 is wrong by an n-gram of the same name.

    - A null or empty text is its end alone. A null ``held_out`` counts as not held out.
    - Memory is that of a batch: ``batch_bytes`` of text or one longer text. A long text is walked a piece at a time.
    - Every row is learnt from and scored for itself, repeated ones and those with null ids too.
    - Without rows to learn from, every token has probability 1; an empty table gives no rows.
    - Other columns play no part, whatever their names.
    """
    held_out = F.coalesce(held_out, F.lit(False))
    batches = packed_documents(docs, held_out, id_column, text_column, batch_bytes)
    size = docs.agg(F.sum(F.octet_length(text_of(text_column)))).first()[0] or 0
    spans = max(8, -(-size // batch_bytes))
    bits = min(MOST_BITS, SPARE_BITS + size.bit_length())
    replies = written(answered(asked(batches, order, spans, bits), bits), "counts")
    learnt = replies.filter(F.col("batch").isNull() & (F.col("n") == 1)).agg(F.sum("distinct"), F.sum("tokens")).first()
    distinct, tokens = (int(n or 0) for n in learnt)
    kind = dict(docs.dtypes)[id_column]

    def score(batch: pa.Table, counts: pa.Table) -> pa.Table:
        rows = _opened(batch.column("docs")[0].as_py())
        texts = Texts.of(rows.column("text").to_pylist())
        parts = sorted(zip(*(counts.column(c).to_pylist() for c in ("n", "span", "counts"))), key=lambda r: r[:2])
        none = np.zeros(0, np.uint64)
        own = [np.concatenate([none, *(unsqueezed(c) for m, _, c in parts if m == n)]) for n in range(1, order + 1)]
        automaton = Automaton(texts, bits, own, strength, distinct, tokens)
        word, starts = automaton.arc[0], texts.starts
        base, seen = automaton.weight[0][word], automaton.seen[word]
        n = len(starts) - 1
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "held_out": rows.column("held_out"),
                "n_tokens": pa.array(np.diff(starts) - 1),
                "n_known": pa.array([int(seen[a + 1 : b].sum()) for a, b in zip(starts, starts[1:])], pa.int64()),
                "train_tokens": pa.array([tokens] * n, pa.int64()),
                "base_score": pa.array([float(base[a + 1 : b].sum()) for a, b in zip(starts, starts[1:])], pa.float64()),
                "score": pa.array([automaton.walk(a, b) for a, b in zip(starts.tolist(), starts[1:].tolist())], pa.float64()),
            }
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    asks = replies.filter(F.col("batch").isNotNull()).select("batch", "n", "span", "counts")
    return batches.groupBy("batch").cogroup(asks.groupBy("batch")).applyInArrow(score, schema)


def left_out(id_column: str = "doc_id") -> Column:
    """A seventh of the rows, by a checksum of the id; rows without one are learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 7 == 2, F.lit(False))
