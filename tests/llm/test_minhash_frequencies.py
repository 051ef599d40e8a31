"""Near-duplicates by the document frequencies of shingles themselves, where hashed ones differ much."""

import numpy as np
import pytest
from helpers import documents, grouped

from ledgerwave.llm import minhash, words


def test_shared_template_among_many_shingles(spark):
    own = np.random.default_rng(6)
    vocabulary = np.array([f"w{i}" for i in range(20_000)])
    prose = lambda n: " ".join(own.choice(vocabulary, n))
    template = prose(854)
    rows = [(i, (template + " " if i < 100 else "") + prose(20_000)) for i in range(300)]
    # 850 shingles of a third of the texts and 45 others each: 0.77 by their own frequencies, 0.83 by those of features.
    rows += [(1000 + i, template + " " + prose(45)) for i in range(2)]
    copy = prose(400)
    rows += [(2000, copy + " one end"), (2001, copy + " other end")]
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert found[1001] == 1001 and found[1000] == 1000
    assert found[2001] == 2000


def test_counts_are_those_of_every_shingle_and_travel_in_few_rows(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").selectExpr("coalesce(text, '') AS text")
    texts = [r["text"] for r in docs.collect()] + ["", "x", "x"]
    docs = docs.unionByName(spark.createDataFrame([("",), ("x",), ("x",)], "text string"))
    counted = {}
    for text in texts:
        for key in np.unique(words.shingles(words.word_hashes(text), 5)).tolist():
            counted[key] = counted.get(key, 0) + 1
    found = minhash.Frequencies(docs, 5)
    assert found.rows == len(texts)
    several = {r["shingle"] % (1 << 64): r["n"] for r in found.several().collect()}
    assert several == {k: n for k, n in counted.items() if n > 1} and several
    features = np.zeros(minhash.FEATURES, np.int64)
    for key, n in counted.items():
        features[key >> (64 - minhash.FEATURE_BITS)] += n
    assert (found.of_features == features).all()
    assert found.made.count() <= 8 < len(several)


def test_counts_of_nothing(spark):
    found = minhash.Frequencies(spark.createDataFrame([], "text string"), 5)
    assert found.rows == 0 and found.several().count() == 0 and not found.of_features.any()


def test_packed_numbers():
    own = np.random.default_rng(7)
    for n in (1, 2, 300):
        keys = np.sort(own.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1))
        for keys in (keys, np.repeat(keys, 3), keys >> np.uint64(50)):
            assert (minhash.unpacked(minhash.packed(keys)) == keys).all()


def test_words_taken_as_bytes():
    texts = [
        "Some words, some WORDS", "", " ... _ ", "l'été d'Été_2 Straße", "a\x1cb\x85c\xa0d e", "ΣΑΣ İx 中文 ½ ٣",
        "x" * 1000 + " " + "x" * 1001, "a-b ab a\tb", "aa a a",
    ]
    of = {}
    for text in texts:
        plain = [w for w in ("".join(c for c in x if c.isalnum()) for x in text.lower().split()) if w]
        found = words.word_hashes(text).tolist()
        assert len(found) == len(plain)
        for word, key in zip(plain, found):
            assert of.setdefault(word, key) == key
    assert len(set(of.values())) == len(of)


def test_far_copies_of_one_text_make_few_pairs(spark, monkeypatch):
    own = np.random.default_rng(11)
    vocabulary = np.array([f"w{i}" for i in range(20_000)])
    base = own.choice(vocabulary, 300)
    rows = []
    for i in range(140):
        text = base.copy()
        text[own.choice(300, 9, replace=False)] = own.choice(vocabulary, 9)
        rows.append((i, " ".join(text)))
    rows += [(200 + i, rows[i][1] + " more") for i in range(0, 140, 10)]
    asked = {}

    def classes(label):
        near = minhash._Vectors.near
        with monkeypatch.context() as patched:
            patched.setattr(minhash._Vectors, "near", lambda self, p: asked.setdefault(label, []).append(p.count()) or near(self, p))
            patched.setattr(minhash, "ROUNDS", (1,))
            patched.setattr(minhash, "BLOCK", 20)
            return {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(spark, rows)).collect()}

    found = classes("tiles")
    tied = minhash.graph.tied
    monkeypatch.setattr(minhash.graph, "tied", lambda members, may, verify, rounds, last: tied(members, may, verify, rounds))
    assert found == classes("join")
    assert len(asked["tiles"]) == len(asked["join"]) == 2 and len(set(found.values())) == 140
    assert asked["tiles"][1] < asked["join"][1] / 2


def test_possible_pairs_are_all_that_are_similar():
    own = np.random.default_rng(12)
    weights = own.random((40, 300)) * (own.random((40, 300)) < 0.7)
    weights[20:] = weights[:20] * (own.random((20, 300)) < 0.9)
    sums = np.stack([np.bincount(np.arange(300) % minhash.PARTS, w, minhash.PARTS) for w in weights])
    ids, of = own.permutation(40), np.arange(40) % 7
    similar = lambda i, j: np.minimum(weights[i], weights[j]).sum() / np.maximum(weights[i], weights[j]).sum()
    for sides in (np.zeros(40, bool), np.arange(40) < 20):
        pairs = [(i, j) for i in range(40) for j in range(i) if of[i] != of[j] and (sides[i] != sides[j] or not sides.any())]
        truth = {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in pairs if similar(i, j) >= 0.8}
        made = [tuple(p) for found in minhash.possible_pairs(ids, of, sums, sides, 0.8) for p in found.tolist()]
        assert truth and truth <= set(made) and len(set(made)) == len(made) < len(pairs)


@pytest.mark.parametrize("block", [30, 512])
def test_tiles_hand_on_links_of_different_components_alone(spark, monkeypatch, block):
    own = np.random.default_rng(13)
    groups = [np.sort(own.choice(1 << 40, 300, replace=False)) for _ in range(6)]
    kept = [(i, np.sort(own.choice(groups[i % 6], 290, replace=False))) for i in range(120)]
    vectors = minhash._Vectors(None, None, None, 5, 0.8)
    rows = [(i, k.tolist(), [1.0] * 290) for i, k in kept]
    vectors.made = spark.createDataFrame(rows, "id long, keys array<long>, weights array<float>")
    left = spark.createDataFrame([(b, i, i) for b in range(3) for i in range(120)], "bucket long, id long, of long")
    monkeypatch.setattr(minhash, "BLOCK", block)
    made = [(r["a"], r["b"]) for r in vectors.possible(left).collect()]
    root = grouped(made, range(120))
    assert all(root[i] == i % 6 for i in range(120)) and all(a < b for a, b in made)
    tiles = {30: 10, 512: 1}[block]  # all pairs of a group would be 1,140 for each bucket
    assert len(made) <= 3 * min(tiles * 114, 500)
    assert block == 30 or len(made) == 3 * 114
