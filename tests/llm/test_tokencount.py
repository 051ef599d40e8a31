"""Token counts against the library on whole texts."""

import public_tokenizers
import pytest
from helpers import documents, with_clashes
from tokenizers import Tokenizer

from ledgerwave.llm import tokencount

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def got(frame):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in frame.collect())


def want(rows, library, limit=2048):
    return sorted((d is None, d or 0, len((t or "").encode()), library(t), library(t) > limit) for d, t in rows)


def test_whole_table(spark, sample_dir, library):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(tokencount.token_counts(docs, FILE)) == want(rows, library)
    # Hardly any word reaches the tasks: the rest is joined.
    assert got(tokencount.token_counts(docs, FILE, frequent=3)) == want(rows, library)


def test_odd_rows(spark, library):
    rows = [
        (1, "Hello <|endoftext|> it's<|startoftext|>x"), (2, None), (3, ""), (4, " \n\t "), (5, "a\x1cb\x1fc d\x85e f"),
        (6, "word " * 3000), (6, "word " * 3000), (None, "café café ΣΑΣ İx"), (7, "中" * 500), (8, "x" * 30_000),
        (9, "́leading mark"), (9, "other text under one id"),
    ]
    docs = with_clashes(documents(spark, rows), "token", "key", "n", "copies", "rest", "pieces", "n_bytes")
    for frequent in (0, 5, 1000):
        found = tokencount.token_counts(docs, FILE, frequent=frequent)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert got(found) == want(rows, library)


def test_empty(spark):
    assert tokencount.token_counts(documents(spark, []), FILE).count() == 0
