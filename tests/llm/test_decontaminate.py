"""Decontamination against a search word by word."""

import hashlib
import random
import re

from helpers import documents, with_clashes

from ledgerwave.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def truth(docs, items, n=10):
    result = []
    for doc_id, text in docs:
        own = words(text)
        hit, names = set(), set()
        for item_id, body in items:
            w = words(body)
            windows = [w[i : i + n] for i in range(max(1, len(w) - n + 1))] if w else []
            for window in windows:
                for i in range(len(own) - len(window) + 1):
                    if own[i : i + len(window)] == window:
                        hit.update(range(i, i + len(window)))
                        if item_id is not None:
                            names.add(str(item_id))
        result.append((doc_id is None, doc_id or 0, len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return sorted(result)


def got(frame):
    digest = d.items_digest().alias("x")
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["x"]) for r in frame.select("*", digest).collect())


def case(seed):
    own = random.Random(seed)
    pool = ["A", "b", "Ünd", "c3", "d", "É"]
    items = [(i, " ".join(own.choice(pool) for _ in range(own.choice([0, 1, 2, 3, 12, 15])))) for i in range(12)]
    items += [(None, "zz yy xx"), (3, "q r s"), (20, None), (21, "...")]
    docs = [(i, ", ".join(own.choice(pool + ["q", "r", "s"]) for _ in range(own.randrange(0, 80)))) for i in range(25)]
    docs += [(50, None), (51, ""), (52, "zz yy xx " + "x " * 30), (None, items[5][1]), (1, docs[1][1]), (53, items[11][1] * 2)]
    return docs, items


def test_windows(spark):
    docs, items = case(3)
    frame = with_clashes(documents(spark, docs), "row", "n_words", "hit", "item_ids")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(d.contamination(frame, bench)) == truth(docs, items)
    assert got(d.contamination(frame, bench, block_bytes=20)) == truth(docs, items)  # many blocks, the same hits


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sample_dir}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()][:60]
    own = d.contamination(docs.filter(docs["doc_id"].isin([i for i, _ in rows])), bench)
    assert got(own) == truth(rows, [(r["item_id"], r["text"]) for r in bench.collect()])


def test_removal(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Before. {item.upper()}, after!"), (2, "clean text"), (3, None), (4, item), (5, f"x {item} y {item} z")]
    frame = with_clashes(documents(spark, docs), "row", "text_key", "hit")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = d.decontaminate(frame, bench)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {2, 3}
    cut = {r["doc_id"]: r["text"] for r in d.decontaminate(frame, bench, "spans").collect()}
    assert cut == {1: "Before. , after!", 2: "clean text", 3: None, 4: "", 5: "x  y  z"}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(documents(spark, []), bench).count() == 0
    assert got(d.contamination(documents(spark, [(1, "a b")]), bench)) == truth([(1, "a b")], [])
    assert d.decontaminate(documents(spark, [(1, "a b")]), bench).count() == 1


def test_long_text_is_taken_in_pieces(monkeypatch):
    monkeypatch.setattr(d, "CHUNK", 7)
    text = "Abc dé fghij klmnopqrstuvw x y z " * 3
    assert [w for part in d.words_of(text) for w in part] == [w.encode() for w in words(text)]
