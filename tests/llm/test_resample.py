"""Importance resampling against a plain computation of every step."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, with_clashes

from ledgerwave.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(rows, target, percent=25, least=20, buckets=10_000, seed=7):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])

    s, t = counts(x for _, x in rows), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    found = []
    for doc, text in rows:
        words, own = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((len(words), doc, len(own), weight, score))
    fit = sorted((f for f in found if f[0] >= least), key=lambda f: (-f[4], f[1] is None, f[1] or 0, f[2]))
    drawn = len(fit) * percent // 100
    ranked = [(*f[1:], i + 1 if i < drawn else None) for i, f in enumerate(fit)]
    return ordered(ranked + [(*f[1:], None) for f in found if f[0] < least])


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def targets(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    goal = spark.read.parquet(f"{sample_dir}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows, [r["text"] for r in goal.collect()])
    assert ordered(resample.resample(docs, goal).collect()) == want
    assert ordered(resample.resample(docs, goal, pivots=2).collect()) == want
    assert sum(r[4] is not None for r in want) > 10


def test_odd_rows(spark):
    long = "Wörter und mehr " * 5000
    rows = [
        (1, "A b-c d_e 1x " * 9), (2, None), (3, ""), (4, "...!"), (5, "é" * 30 + " İx ΣΑ " * 12), (6, long),
        (7, "same words here " * 8), (8, "same words here " * 8), (7, "same words here " * 8), (7, "other words " * 15),
        (None, "no id at all " * 10), (None, "no id at all " * 10), (9, "y" * 70_000 + " z" * 25), (10, "few words"),
    ]
    rows += [(20 + i, f"word{i} text " * 12) for i in range(30)]
    goal = ["same text of words", None, "", "Wörter HERE"]
    docs = with_clashes(documents(spark, rows), "n_words", "weight", "score", "rank", "place", "part", "down", "id")
    for percent in (25, 50, 100, 0, 1):
        found = resample.resample(docs, with_clashes(targets(spark, goal), "bucket", "n"), percent=percent, pivots=3)
        assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert ordered(found.collect()) == brute(rows, goal, percent)


def test_many_copies_of_one_row(spark):
    rows = [(5, "the very same words again " * 6)] * 300 + [(i, f"text {i} " * 12) for i in range(100)]
    found = resample.resample(documents(spark, rows), targets(spark, ["same words"]), percent=60, pivots=2)
    assert ordered(found.collect()) == brute(rows, ["same words"], 60)


def test_empty(spark):
    assert resample.resample(documents(spark, []), targets(spark, ["a"])).count() == 0
    rows = [(1, "a b c " * 10)] * 4
    assert ordered(resample.resample(documents(spark, rows), targets(spark, [])).collect()) == brute(rows, [])


@pytest.mark.parametrize("first", ["", "a", "ab" * 40, "é"])
def test_checksums_of_joined_words(first):
    for second in ("x", "y" * 300, "long" * 5000):
        words = f"{first} {second}"
        found, _, n = resample.features_of([words], 1 << 31)
        assert sorted(found) == sorted(zlib.crc32(f.encode()) % (1 << 31) for f in features(words)[1])
        assert n[0] == len(words.split())
