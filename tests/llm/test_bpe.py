"""BPE against the library; the lookahead against merge lists of all kinds."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerwave.llm import bpe

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)
MERGES = bpe.Merges(open(FILE, "rb").read())
ENCODER, DECODER = bpe.Encoder(MERGES), bpe.Decoder(MERGES)


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    blocks = list(ENCODER.encode(text))
    assert np.frombuffer(b"".join(blocks), "<u4").tolist() == ids
    assert "".join(DECODER.decode(blocks)) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["the", "The ", "'s", "'LL", "12", " ", "\n", "\x1c", "\x85", " ", "<|endoftext|>", "<|", "é", "Σ", "!?", "_", "\U0001f642"]), max_size=30))
def test_mixtures(parts):
    same("".join(parts))


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 4000, "!" * 3000, "á" * 1500, "thein" * 2000 + " end", "x" * 70_000 + " y"])
def test_words_longer_than_the_window(text):
    same(text)


def test_random_letters_in_a_long_word():
    own = random.Random(2)
    same("".join(own.choice("theinaorsu") for _ in range(15_000)))


def merges_of(own, letters, count):
    """A merge list learnt from random text, as they are made."""
    words = [[own.randrange(letters) for _ in range(40)] for _ in range(40)]
    merges, new = [], letters
    while len(merges) < count:
        pairs = {}
        for w in words:
            for p in zip(w, w[1:]):
                pairs[p] = pairs.get(p, 0) + 1
        if not pairs:
            break
        best = max(pairs, key=lambda p: (pairs[p], p)) if own.random() < 0.6 else own.choice(sorted(pairs))
        merges.append((*best, new))
        for w in words:
            i = 0
            while i < len(w) - 1:
                if (w[i], w[i + 1]) == best:
                    w[i : i + 2] = [new]
                i += 1
        new += 1
    return merges


@pytest.mark.parametrize("seed", range(12))
def test_streaming_gives_what_the_whole_word_does(seed):
    """With small merge lists windows are short, and a lookahead that is too small would show."""
    own = random.Random(seed)
    letters = own.choice([2, 3, 5])
    merges = merges_of(own, letters, own.choice([4, 12, 30]))
    lengths = bpe.Merges._lengths(merges)
    fake = type("M", (), {})()
    fake.rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(merges)}
    fake.lookahead = bpe.sufficient_lookahead(merges, lengths)
    fake.token_lengths = {**{i: 1 for i in range(letters)}, **lengths}
    for _ in range(60):
        word = [own.randrange(letters) for _ in range(own.randrange(1, 1500))]
        stream, out, at = bpe.Transducer(fake), [], 0
        while at < len(word):
            step = own.randrange(1, 400)
            out += stream.feed(word[at : at + step])
            assert len(stream.window) <= 4 * fake.lookahead
            at += step
        assert out + stream.finish() == bpe.merge(word[:], fake.rank)


def test_a_merge_list_out_of_order_is_refused():
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(0, 9, 10), (1, 2, 9)], {0: 1, 1: 1, 2: 1, 9: 2, 10: 3})


def test_byte_to_text_machine_keeps_unfinished_letters():
    spec = MERGES.spec
    other = bpe.Merges.__new__(bpe.Merges)
    other.decoder, other.special = {"type": "ByteLevel"}, {}
    other.vocab = {c: i for i, c in enumerate(bpe.byte_letters())}
    text = "café \U0001f642!"
    blocks = [np.array([b], "<u4").tobytes() for b in text.encode()]
    assert "".join(bpe.Decoder(other).decode(blocks)) == text
    assert "".join(bpe.Decoder(other).decode(blocks[:4])) == "caf�"
    assert spec["decoder"] is None


def row(doc_id, text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    raw = np.array(ids, "<u4").tobytes()
    back = LIBRARY.decode(ids, skip_special_tokens=False).encode()
    return (doc_id is None, doc_id or 0, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest())


def test_whole_table_and_odd_rows(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (None, "x y"), (-3, "a b"), (-3, "a b"), (-4, " " * 200_000), (-5, "<|endoftext|>")]
    both = with_clashes(docs.unionByName(documents(spark, odd)), "n_tokens", "ids", "decoded")
    found = bpe.round_trip(both, FILE).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found)
    assert got == sorted(row(r["doc_id"], r["text"]) for r in both.collect())


def test_outputs_and_empty(spark):
    r = bpe.round_trip(documents(spark, [(1, "Hello there")]), FILE, keep=True).first()
    assert r["ids"] == LIBRARY.encode("Hello there", add_special_tokens=False).ids
    assert r["decoded"] == LIBRARY.decode(r["ids"], skip_special_tokens=False)
    assert bpe.round_trip(documents(spark, []), FILE).count() == 0
