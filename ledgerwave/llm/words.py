"""Words of texts as numbers, for shingles and line signatures."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

_NO_LETTER = re.compile(r"[\W_]+")
_DIGITS = re.compile(r"\d")
REMEMBERED = 500_000


class WordHashes(dict):
    """The 64-bit hash of a lower-cased stretch without white space, of its letters and digits alone; 0 without any.

    What is known is remembered, up to ``REMEMBERED`` stretches.
    """

    def __init__(self, digits: bool = True) -> None:
        super().__init__()
        self.digits = digits

    def __missing__(self, stretch: str) -> int:
        word = _NO_LETTER.sub("", stretch)
        if not self.digits:
            word = _DIGITS.sub("0", word)
        value = (xxhash.xxh3_64_intdigest(word.encode()) or 1) if word else 0
        if len(self) >= REMEMBERED:
            self.clear()
        self[stretch] = value
        return value

    def of(self, text: str) -> np.ndarray:
        """The hashes of the words of a lower-cased text."""
        stretches = text.split()
        found = np.fromiter(map(self.__getitem__, stretches), np.uint64, len(stretches))
        return found[found != 0]

    def of_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words of several lower-cased texts in a row, and where each text's end."""
        stretches, ends = [], []
        for text in texts:
            stretches += text.split()
            ends.append(len(stretches))
        coded = pa.array(stretches, pa.string()).dictionary_encode()
        known = np.fromiter(map(self.__getitem__, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        found = known[coded.indices.to_numpy()]
        real = found != 0
        return found[real], np.concatenate([[0], np.cumsum(real)])[np.array(ends, np.int64)]


_ODD = np.uint64(0x9E3779B97F4A7C15)
_NO_WORD = re.compile(r"(?:[^\w\s]|_)+")
#: What is neither ASCII nor in a word; bytes tell all else apart.
_STRANGE = re.compile(r"[^\x00-\x7f\w]")
#: Of every byte: whether it stands in a word or between words, whether between, and its number within a word.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_HELD = _BETWEEN | np.array([b > 127 or chr(b).isalnum() for b in range(256)])
_NUMBERS = np.random.default_rng(20_240_301).integers(1, 1 << 63, 256, np.uint64)
_NUMBERS[ord("A") : ord("Z") + 1] = _NUMBERS[ord("a") : ord("z") + 1]


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(n, _ODD))


_POWERS = _powers(256)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words of a text, of their letters and digits alone; the same words in every task.

    Bytes are taken all at once, as terms of a polynomial for each word; nothing is remembered from one text to the next.
    """
    if not text.isascii():
        text = text.lower()
        if _STRANGE.search(text):
            text = " ".join(_NO_WORD.sub("", text).split())
    data = np.frombuffer(text.encode(), np.uint8)
    data = data[_HELD[data]]
    at = np.flatnonzero(~_BETWEEN[data])
    if not len(at):
        return np.zeros(0, np.uint64)
    new = np.empty(len(at), bool)
    new[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=new[1:])
    starts = np.flatnonzero(new)
    lengths = np.diff(starts, append=len(at))
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    terms = _NUMBERS[data[at]] * powers[np.arange(len(at)) - np.repeat(starts, lengths)]
    return mixed(np.add.reduceat(terms, starts))


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over all 64 bits."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words; a shorter text, but not an empty one, is one shingle."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for i in range(min(size, len(words))):
            total = total * _ODD + words[i : i + n]
    return mixed(total)
