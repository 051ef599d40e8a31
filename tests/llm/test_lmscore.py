"""Scores of the automaton against the recursive definition of the model over whole texts."""

import math
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, with_clashes

from ledgerwave.llm import lmscore

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Plain:
    """The model as a recursion over counts of tuples; the mark before a text is 0."""

    def __init__(self, texts, order, strength):
        self.order, self.strength, self.counts = order, strength, Counter()
        for text in texts:
            read = [0, *tokens(text)]
            for n in range(1, order + 1):
                self.counts.update(tuple(read[i : i + n]) for i in range(len(read) - n + 1))
        words = {g: c for g, c in self.counts.items() if len(g) == 1 and g != (0,)}
        self.n, self.v = sum(words.values()), len(words)

    def chance(self, context, word):
        if not context:
            return (self.counts[(word,)] + 1) / (self.n + self.v + 1)
        shorter = self.chance(context[1:], word)
        if not self.counts[context]:
            return shorter
        few = self.strength[len(context) - 1]
        return (self.counts[(*context, word)] + few * shorter) / (self.counts[context] + few)

    def score(self, text):
        read = [0, *tokens(text)]
        return sum(
            math.log10(self.chance(tuple(read[max(0, i - self.order + 1) : i]), read[i])) for i in range(1, len(read))
        )


def check(spark, rows, docs=None, order=3, strength=lmscore.STRENGTH, **more):
    model = Plain([t for d, t in rows if not held(d)], order, strength)
    docs = documents(spark, rows) if docs is None else docs
    found = lmscore.scores(docs, lmscore.left_out(), order, strength, **more)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def key(row):
        return (row[0] is None, row[0] or 0, row[2], row[3], round(row[5], 6), round(row[6], 6))

    got = sorted((tuple(r) for r in found.collect()), key=key)
    want = []
    for doc, text in rows:
        read = tokens(text)
        known = sum(model.counts[(w,)] > 0 for w in read)
        base = sum(math.log10((model.counts[(w,)] + 1) / (model.n + model.v + 1)) for w in read)
        want.append((doc, held(doc), len(read), known, model.n, base, model.score(text)))
    want.sort(key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return model, got


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _, got = check(spark, rows, docs)
    # Rows it has not learnt from are likelier under the model than under its words alone.
    held_out = [r for r in got if r[1]]
    assert len(held_out) > 10
    assert sum(r[6] for r in held_out) > 0.95 * sum(r[5] for r in held_out)
    check(spark, rows, docs, batch_bytes=2000)  # many batches and spans, the same scores


ODD = [
    (1, "the cat sat on the mat"), (2, "The Cat sat on a hat"), (3, None), (4, ""), (5, " \t\n\x0b "), (6, "a\x1cb\xa0c É é"),
    (7, "again " * 3000), (8, "again and again the cat"), (8, "again and again the cat"), (None, "no id the cat"),
    (9, "the cat sat on the mat"), (None, None), (10, "unknown things only here"), (11, "x" * 40_000), (12, "begin end"),
    (13, "  begin  end the cat"),
]
ODD += [(i, f"the cat number {i % 5} sat on mat {i}") for i in range(20, 60)]


@pytest.mark.parametrize("order", [1, 2, 4])
def test_odd_rows(spark, order):
    assert any(held(d) for d, _ in ODD)
    docs = with_clashes(documents(spark, ODD), "batch", "docs", "n", "keys", "counts", "score", "tokens")
    check(spark, ODD, docs, order, (2.0, 0.5, 1.5), batch_bytes=500)


def test_probabilities_sum_to_one(spark):
    model, _ = check(spark, ODD)
    words = {g[0] for g in model.counts if len(g) == 1 and g != (0,)} | {"never seen"}
    for context in ((), ("the",), ("the", "cat"), (0, "the"), ("never", "seen"), ("sat", "on")):
        assert sum(model.chance(context, w) for w in words) == pytest.approx(1)


def test_a_long_text_is_walked_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "STRETCH", 7)
    check(spark, ODD)


def test_one_text_with_most_rows(spark):
    check(spark, [(i, "the same text in many rows") for i in range(300)] + ODD, batch_bytes=1000)


def test_nothing_to_learn_from(spark):
    rows = [(d, "some text") for d in range(200) if held(d)]
    _, got = check(spark, rows)
    assert {r[4:] for r in got} == {(0, 0.0, 0.0)}
    assert lmscore.scores(documents(spark, []), lmscore.left_out()).count() == 0


def test_numbers_survive_packing():
    import numpy as np

    rng = np.random.default_rng(3)
    for bits in (0, 1, 8, 17, 64):
        values = rng.integers(0, 1 << bits, 1000, np.uint64, endpoint=False) if bits else np.zeros(5, np.uint64)
        assert (lmscore.unsqueezed(lmscore.squeezed(values)) == values).all()
    assert len(lmscore.unsqueezed(lmscore.squeezed(np.zeros(0, np.uint64)))) == 0
