"""Large groups of near copies, whose own number makes what they have in common frequent."""

import numpy as np
from helpers import documents

from ledgerwave.llm import minhash


def test_copies_of_a_large_group_are_no_strangers(spark):
    own = np.random.default_rng(21)
    vocabulary = np.array([f"w{i}" for i in range(20_000)])
    base = own.choice(vocabulary, 300)

    def copy(changes):
        text = base.copy()
        text[[30 + 60 * i for i in range(changes)]] = own.choice(vocabulary, changes)
        return " ".join(text)

    near, farther, strangers = range(110), range(120, 160), range(200, 250)
    rows = [(i, copy(1)) for i in near] + [(i, copy(3)) for i in farther]
    rows += [(i, " ".join(own.choice(vocabulary, 300))) for i in strangers]
    # 0.90 of the shingles of a farther copy and a near one are the same, 0.74 by the frequencies of all rows.
    found = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert all(found[i] == (0, 150) for i in [*near, *farther])
    assert all(found[i] == (i, 1) for i in strangers)


def test_rows_of_classes_that_meet_count_once(spark):
    """Weights after the second count, by hand: three copies and two strangers to them in a bucket, ten rows in all."""
    class Counted:
        rows = 10

    vectors = minhash._Vectors(None, None, Counted, 5, 0.8)
    vectors.distinct = spark.createDataFrame(
        [(0, 2, [7]), (1, 1, [7]), (2, 1, [7]), (3, 1, [8])], "id long, n long, bands array<long>"
    )
    inverse = lambda n: float(np.log(11 / (n + 1)) + 1)
    counts = {0: {10: 4, 11: 3}, 1: {10: 4, 11: 3}, 2: {10: 4, 12: 5}, 3: {12: 5}}
    vectors.made = spark.createDataFrame(
        [(i, list(own), [2 * inverse(n) for n in own.values()], list(own.values())) for i, own in counts.items()],
        "id long, keys array<long>, weights array<float>, rows array<long>",
    )
    seen = []
    possible = minhash._Vectors.possible

    def spy(self, left):
        seen.append({r["id"]: dict(zip(r["keys"], r["weights"])) for r in self.made.collect()})
        return possible(self, left)

    minhash._Vectors.possible = spy
    try:
        of = spark.createDataFrame([(0, 0), (1, 0)], "id long, component long")
        assert {tuple(r) for r in vectors.regrouped(of).collect()} == {(0, 0), (1, 0)}
    finally:
        minhash._Vectors.possible = possible
    (weights,) = seen
    assert weights.keys() == {0, 1, 2}  # the bucket of 3 has no other class
    # Shingle 10 is in three rows of the class, 11 in three, 12 in none.
    expected = {0: {10: 2, 11: 1}, 1: {10: 2, 11: 1}, 2: {10: 2, 12: 5}}
    for i, own in expected.items():
        assert weights[i].keys() == own.keys()
        assert all(abs(weights[i][k] - 2 * inverse(n)) < 1e-5 for k, n in own.items())
