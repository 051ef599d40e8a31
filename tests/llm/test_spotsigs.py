"""SpotSigs against a plain reading of the definition, and that nothing runs in Python."""

import hashlib
import itertools
import re

from helpers import documents, grouped, with_clashes

from ledgerwave.llm import spotsigs

ANCHORS = set(spotsigs.ANCHORS.split())


def signatures(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    found = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            chain = list(itertools.takewhile(lambda x: x not in ANCHORS, words[i + 1 : i + 4]))
            if chain:
                found.add(" ".join([w, *chain]))
    found = found or {"=" + (text or "")}
    return sorted({hashlib.md5(c.encode()).hexdigest()[:12] for c in found})


def like(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


def truth(rows):
    rows = sorted(rows, key=lambda r: r[1] or "")
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    result = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, new, other = signatures(text), signatures(edited), signatures(after)
        result.append((doc_id is None, doc_id or 0, len(text), hashlib.sha256(edited.encode()).hexdigest(), " ".join(own), " ".join(new), round(like(own, new), 12), round(like(own, other), 12)))
    return sorted(result)


def got(frame):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in frame.collect())


def test_whole_table_in_blocks(spark, sample_dir, monkeypatch):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = truth(rows)
    assert got(spotsigs.fingerprints(docs)) == expected
    monkeypatch.setattr(spotsigs, "BLOCK_ROWS", 7)
    assert got(spotsigs.fingerprints(docs)) == expected


def test_odd_rows(spark, monkeypatch):
    rows = [
        (1, "the house of stone"), (2, None), (3, ""), (4, "\U0001f642" * 7), (5, "the house of stone"), (5, "a b"), (5, "a b"), (None, "the end of it"),
        (None, "zz"), (9, "the big black house and the small white one is here " * 3000), (10, "x"), (11, "...!"),
    ]
    docs = with_clashes(documents(spark, rows), "id", "block", "tail", "own", "next", "edited", "n_chars", "text_key")
    for size in (2, 3, 100):
        monkeypatch.setattr(spotsigs, "BLOCK_ROWS", size)
        assert got(spotsigs.fingerprints(docs)) == truth(rows)


def test_small_tables(spark):
    assert spotsigs.fingerprints(documents(spark, [])).count() == 0
    assert got(spotsigs.fingerprints(documents(spark, [(1, "the one text")]))) == truth([(1, "the one text")])
    assert got(spotsigs.fingerprints(documents(spark, [(None, "the b c"), (None, None)]))) == truth([(None, "the b c"), (None, None)])


def test_native(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    plan = spotsigs.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pruned_likeness(spark):
    frame = spark.createDataFrame([(["a", "b"], ["b", "c"]), (["a"], list("abcdef")), (["a"], ["a"])], "a array<string>, b array<string>")
    a, b = frame["a"], frame["b"]
    rows = frame.select(spotsigs.jaccard(a, b).alias("x"), spotsigs.jaccard(a, b, 0.8).alias("y")).collect()
    assert [(round(r["x"], 6), round(r["y"], 6)) for r in rows] == [(0.333333, 0.333333), (0.166667, 0.0), (1.0, 1.0)]


def test_near_duplicates(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    sets = [signatures(t) for _, t in rows]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if like(sets[a], sets[b]) >= 0.8]
    expected = {rows[i][0]: rows[j][0] for i, j in grouped(pairs, range(len(rows))).items()}
    assert {r["doc_id"]: r["class_id"] for r in spotsigs.near_duplicates(docs).collect()} == expected
    assert spotsigs.near_duplicates(documents(spark, [])).count() == 0
