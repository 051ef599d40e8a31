"""Near-duplicates against all pairs."""

import itertools

import numpy as np
from helpers import documents, grouped, with_clashes

from ledgerwave.llm import minhash


def truth(texts):
    """Classes by every pair of texts."""
    words = [[w for w in ("".join(c for c in x if c.isalnum()) for x in (t or "").lower().split()) if w] for t in texts]
    shingles = [
        [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else [("", t or "")] for w, t in zip(words, texts)
    ]
    n = len(texts)
    frequency = {}
    for s in shingles:
        for x in set(s):
            frequency[x] = frequency.get(x, 0) + 1
    weights = []
    for s in shingles:
        own = {}
        for x in s:
            own[x] = own.get(x, 0) + np.log((n + 1) / (frequency[x] + 1)) + 1
        weights.append(own)
    pairs = []
    for a, b in itertools.combinations(range(n), 2):
        both = sum(min(weights[a][x], weights[b][x]) for x in weights[a].keys() & weights[b].keys())
        if both / (sum(weights[a].values()) + sum(weights[b].values()) - both) >= 0.8:
            pairs.append((a, b))
    return grouped(pairs, range(n))


def classes(frame):
    return {r["doc_id"]: r["class_id"] for r in frame.collect()}


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    place = truth([r["text"] for r in rows])
    expected = {rows[i]["doc_id"]: rows[j]["doc_id"] for i, j in place.items()}
    found = minhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == expected
    assert all(r["keep"] == (r["doc_id"] == r["class_id"]) for r in found)
    sizes = {c: list(expected.values()).count(c) for c in expected.values()}
    assert all(r["class_size"] == sizes[r["class_id"]] for r in found)


def test_odd_rows(spark):
    base = " ".join(f"word{i}" for i in range(200))
    near = base.replace("word100", "other")
    rows = [
        (1, base), (2, near), (3, base.upper() + "!"), (4, None), (5, ""), (6, "..."), (7, "..."), (8, "!!!"),
        (9, "two words"), (10, "two words"), (11, "other words"), (None, base), (2, near), (12, "x " * 50_000),
    ]
    docs = with_clashes(documents(spark, rows), "key", "bands", "id", "class_id", "text_key", "component", "first")
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    of = {r["doc_id"]: r["class_id"] for r in found}
    assert of[1] == of[2] == of[3] == of[None] == 1
    assert of[4] == of[5] == 4 and of[6] == of[7] == 6 and of[8] == 8
    assert of[9] == of[10] == 9 and of[11] == 11 and of[12] == 12
    assert {r["doc_id"] for r in found if r["keep"]} == {1, 4, 6, 8, 9, 11, 12}


def test_twins_and_null_ids(spark):
    found = minhash.near_duplicates(documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "z y x"), (None, "z y x")]))
    assert sorted((r["keep"], r["twins"]) for r in found.collect()) == [(True, 2)] * 4


def test_empty(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_samples_agree_as_often_as_weights_do():
    own = np.random.default_rng(5)
    keys = np.unique(own.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2) + np.uint64(1))
    a, b = own.random(len(keys)) + 0.1, own.random(len(keys)) + 0.1
    a[:60], b[60:120] = 0, 0
    truth_ = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sampler = minhash.Sampler(4000)
    same = (sampler(keys[a > 0], a[a > 0]) == sampler(keys[b > 0], b[b > 0])).mean()
    assert abs(same - truth_) < 0.04
