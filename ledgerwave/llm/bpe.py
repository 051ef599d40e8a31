"""BPE as a streaming transducer with bounded lookahead, and decoding as a byte-to-text state machine."""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerwave.llm.common import text_of

#: Characters normalised and cut into words together, words and symbols remembered by a task, ids decoded together.
BLOCK, REMEMBERED, MEMO_BYTES, DECODE = 1 << 16, 400_000, 64, 1 << 14

#: Unicode white space, fixed values; what the tokenizer's pattern calls white space.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS = re.compile(f"[^{_SPACE}]+")
_NEXT_SPACE = re.compile(f"[{_SPACE}]")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_LATIN = re.compile("[\x00-\u024f]*")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Merges:
    """A merge list: the rank of every pair, the symbols, and how far to look ahead."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("a BPE model without prefixes and byte fallback is needed")
        if model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("merges must be applied, and always")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs]
        self.rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(ids)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens must stand for themselves")
        if any(_NEXT_SPACE.search(t) for t in self.special):
            raise ValueError("added tokens may hold no white space")
        self.decoder = spec.get("decoder")
        self.spec = spec
        self.lookahead = sufficient_lookahead(ids, self._lengths(ids))

    @staticmethod
    def _lengths(ids: list[tuple[int, int, int]]) -> dict[int, int]:
        lengths: dict[int, int] = {}
        for a, b, c in ids:
            lengths.setdefault(a, 1)
            lengths.setdefault(b, 1)
            lengths[c] = lengths[a] + lengths[b]
        return lengths


def sufficient_lookahead(merges: list[tuple[int, int, int]], lengths: dict[int, int]) -> int:
    """Symbols after which what follows can no longer change a token.

    Apply the merges in order of rank to two words that begin alike. At first they agree up to where the words part.
    The border of agreement moves left only when a merge takes the last token they agree on together with what begins
    at the border in one word and not in the other. That right part begins with the token that was last taken over the
    border, as it was or with more merged to it, and ranks rise. So the longest way is a chain of merges of rising rank
    in each of which the leftmost parts of the right side hold the left side of the one before; it is added up here
    merge by merge. Only then is a token of the longest kind added, which may lie across the border itself.
    """
    first: dict[int, int] = {}  # the left part of what a merge makes
    reach: dict[int, int] = {}  # the longest chain so far whose last merge has this left side
    made: set[int] = set()
    parts = {x for a, b, _ in merges for x in (a, b)}
    made_later = {c for _, _, c in merges}
    for a, b, c in merges:
        if (a in made_later and a not in made) or (b in made_later and b not in made):
            raise ValueError("a merge uses what only a later one makes")
        longest, at = 0, b
        while at is not None:
            longest = max(longest, reach.get(at, 0))
            at = first.get(at)
        reach[a] = max(reach.get(a, 0), lengths[a] + longest)
        first.setdefault(c, a)
        made.add(c)
    return max(reach.values(), default=0) + max((lengths[x] for x in parts | made), default=1)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_NO_MERGE = (1 << 31, 0)


def merge(symbols: list[int], rank: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The merges applied to some symbols, the lowest rank first and the leftmost of equal ones."""
    find = rank.get
    pairs = [find(pair, _NO_MERGE) for pair in zip(symbols, symbols[1:])]
    while pairs:
        best = min(pairs)
        if best is _NO_MERGE:
            break
        at, new = pairs.index(best), best[1]
        symbols[at : at + 2] = [new]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = find((new, symbols[at + 1]), _NO_MERGE)
        if at:
            pairs[at - 1] = find((symbols[at - 1], new), _NO_MERGE)
    return symbols


class Transducer:
    """The tokens of one word, symbol by symbol. It never holds more than a window of a few lookaheads."""

    def __init__(self, merges: Merges) -> None:
        self.rank, self.lookahead = merges.rank, merges.lookahead
        self.lengths = merges.token_lengths
        self.window: list[int] = []

    def feed(self, symbols: list[int]) -> Iterator[int]:
        """Takes symbols, emits the tokens that no further symbol can change."""
        if len(self.window) + len(symbols) < 3 * self.lookahead:
            self.window += symbols
            return
        for at in range(0, len(symbols), self.lookahead):
            self.window += symbols[at : at + self.lookahead]
            if len(self.window) >= 3 * self.lookahead:
                stable = len(self.window) - self.lookahead
                end = 0
                for token in merge(self.window[:], self.rank):
                    if end + self.lengths[token] > stable:
                        break
                    end += self.lengths[token]
                    yield token
                del self.window[:end]

    def finish(self) -> list[int]:
        window, self.window = self.window, []
        return merge(window, self.rank)


class Encoder:
    """Text to ids. Memory does not grow with the text: blocks of it, a window, and a bounded memo of short words."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        vocab, suffix = merges.vocab, merges.suffix
        self.letters = [vocab.get(c) for c in byte_letters()]
        self.last = [vocab.get(c + suffix) for c in byte_letters()]
        merges.token_lengths = {x: 1 for x in [*self.letters, *self.last] if x is not None}
        for (a, b), (_, c) in merges.rank.items():
            merges.token_lengths[c] = merges.token_lengths[a] + merges.token_lengths[b]
        split = merges.spec["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in merges.spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in split] != ["Split", "ByteLevel"]:
            raise ValueError("a tokenizer of another make")
        if split[0]["behavior"] != "Removed" or not split[0]["invert"] or split[1]["add_prefix_space"]:
            raise ValueError("a tokenizer of another make")
        self.pattern = regex.compile(split[0]["pattern"]["Regex"])
        self.special = (
            re.compile("|".join(re.escape(t) for t in sorted(merges.special, key=len, reverse=True)))
            if merges.special
            else None
        )
        self.library = Tokenizer.from_str(json.dumps({**merges.spec, "model": {**merges.spec["model"], "merges": [], "vocab": {}}}))
        self.byte = {c: i for i, c in enumerate(byte_letters())}
        self.runs: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.transducer = Transducer(merges)

    def word(self, raw: bytes) -> bytes:
        """The ids of one pre-token, packed."""
        known = self.words.get(raw)
        if known is not None:
            return known
        symbols = list(map(self.letters.__getitem__, raw))
        symbols[-1] = self.last[raw[-1]]
        if None in symbols:
            symbols = [s for s in symbols if s is not None]
        ids = packed([*self.transducer.feed(symbols), *self.transducer.finish()])
        if len(raw) <= MEMO_BYTES:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[raw] = ids
        return ids

    def plain(self, text: str) -> Iterator[bytes]:
        """The ids of the words of a stretch without white space and special tokens."""
        if _LATIN.fullmatch(text):  # letters of which no version of Unicode thinks otherwise; nothing to compose
            return map(self.word, [w.encode() for w in self.pattern.findall(text.lower())])
        # What is a letter, and its lower case, depends on the library's tables.
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return map(self.word, [bytes(map(self.byte.__getitem__, w)) for w, _ in words])

    def run(self, run: str) -> bytes:
        """The ids of a stretch without white space, packed. Special tokens are cut out first."""
        known = self.runs.get(run)
        if known is not None:
            return known
        if self.special is not None and self.special.search(run):
            parts, at = [], 0
            for found in self.special.finditer(run):
                parts += self.plain(run[at : found.start()])
                parts.append(packed([self.merges.special[found[0]]]))
                at = found.end()
            parts += self.plain(run[at:])
        else:
            parts = self.plain(run)
        ids = b"".join(parts)
        if len(run) <= MEMO_BYTES:
            if len(self.runs) >= REMEMBERED:
                self.runs.clear()
            self.runs[run] = ids
        return ids

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, packed as little-endian 32-bit numbers, a block of text at a time.

        Blocks end at white space, over which neither normaliser nor words nor special tokens reach.
        """
        at, get = 0, self.runs.get
        while at < len(text):
            end = len(text)
            if at + BLOCK < end:
                space = _NEXT_SPACE.search(text, at + BLOCK)
                end = space.start() if space else end
            block = text[at:end]
            runs = _RUNS.findall(block) if _SEPARATORS.search(block) else block.split()
            known = list(map(get, runs))
            if None in known:
                known = [self.run(run) if ids is None else ids for run, ids in zip(runs, known)]
            yield b"".join(known)
            at = end


class Decoder:
    """Ids to text. The bytes of the tokens run through a UTF-8 machine that keeps an unfinished letter for later.

    Without a decoder of its own a tokenizer's text is its tokens as they are written, with a blank between two. With a
    byte-level one the letters stand for bytes, and a wrong byte becomes U+FFFD.
    """

    def __init__(self, merges: Merges) -> None:
        if merges.decoder is None:
            self.separator, name = b" ", str.encode
        elif merges.decoder["type"] == "ByteLevel":
            byte = {c: i for i, c in enumerate(byte_letters())}
            self.separator = b""

            def name(token: str) -> bytes:
                return bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

        else:
            raise ValueError("a decoder of another make")
        self.pieces = {i: name(t) for t, i in {**merges.vocab, **merges.special}.items()}
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def decode(self, blocks: Iterable[bytes]) -> Iterator[str]:
        """The text of some packed ids, a piece at a time."""
        self.machine.reset()
        begun = False
        for block in blocks:
            ids = np.frombuffer(block, "<u4")
            for at in range(0, len(ids), DECODE):
                raw = self.separator.join(map(self.pieces.__getitem__, ids[at : at + DECODE].tolist()))
                yield self.machine.decode(self.separator + raw if begun else raw)
                begun = True
        yield self.machine.decode(b"", final=True)


def round_trip(
    docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text_column: str = "text", keep: bool = False
) -> DataFrame:
    """Every row's text to ids and back: id, n_tokens, ids_sha256, decoded_sha256; with ``keep`` also ids and decoded.

    Special strings inside a text are their tokens. A null text is an empty one, without tokens and with an empty text.
    Null and repeated ids and repeated rows are rows like others; an empty table gives no rows. Other columns are not
    read. Rows are worked on one by one where they lie; nothing is shuffled.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(content.value)
        encoder, decoder = Encoder(merges), Decoder(merges)
        for part in parts:
            counts, digests, back, ids, texts = [], [], [], [], []
            for text in part.column("text"):
                made, n, blocks = hashlib.sha256(), 0, []
                for block in encoder.encode(text.as_py()):
                    made.update(block)
                    n += len(block) // 4
                    blocks.append(block)
                whole = hashlib.sha256()
                pieces = []
                for piece in decoder.decode(blocks):
                    whole.update(piece.encode())
                    if keep:
                        pieces.append(piece)
                counts.append(n)
                digests.append(made.hexdigest())
                back.append(whole.hexdigest())
                if keep:
                    ids.append(np.frombuffer(b"".join(blocks), "<u4").astype(np.int32).tolist())
                    texts.append("".join(pieces))
            columns = [part.column("doc_id"), pa.array(counts, pa.int64())]
            columns += [pa.array(digests, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    made = rows.mapInArrow(run, schema + (", ids array<int>, decoded string" if keep else ""))
    return made.withColumnRenamed("doc_id", id_column)
