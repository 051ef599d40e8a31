"""Sentence spans against all runs of sentences, of any length."""

import random

from helpers import documents

from ledgerwave.llm import spans


def truth(rows, at_least=spans.SENTENCES, words=spans.WORDS, long=spans.LONG):
    """Texts without the sentences of any run that has occurred before."""
    seen, result = set(), {}
    for doc_id, text in sorted(rows):
        places = spans.sentences(text)
        own = [(i, " ".join(text[a:b].lower().split())) for i, (a, b) in enumerate(places) if text[a:b].split()]
        gone = set()
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                n = sum(len(x.split()) for _, x in own[s:e])
                if (e - s >= at_least and n >= words) or n >= long:
                    key = tuple(x for _, x in own[s:e])
                    if key in seen:
                        gone.update(range(own[s][0], own[e - 1][0] + 1))
                    seen.add(key)
        result[doc_id] = "".join(text[a:b] for i, (a, b) in enumerate(places) if i not in gone)
    return result


def got(frame):
    return {r["row"]["doc_id"]: r["row"]["text"] for r in frame.collect()}


def sentence(own, n):
    return (" ".join(own.choice("abcdefghij") * own.randrange(1, 4) for _ in range(n)) + ".").capitalize()


def test_passages_of_uneven_sentences(spark):
    own = random.Random(8)
    pool = [[sentence(own, own.choice([1, 2, 4, 9, 30, 55])) for _ in range(own.randrange(3, 12))] for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [sentence(own, own.choice([2, 5, 40])) for _ in range(3)]
        for passage in own.sample(pool, 2):
            at = own.randrange(len(passage))
            parts += passage[at:] + [sentence(own, own.choice([2, 5, 40]))]
        rows.append((i, " ".join(parts)))
    assert got(spans.dedup_spans(documents(spark, rows))) == truth(rows)


def test_last_sentences_of_a_passage_go(spark):
    own = random.Random(9)
    passage = " ".join(sentence(own, n) for n in (8, 8, 60, 3, 3))
    rows = [(i, f"{sentence(own, 12)} {passage} {sentence(own, 12)}") for i in range(2)]
    found = got(spans.dedup_spans(documents(spark, rows)))
    assert found == truth(rows)
    assert found[0] == rows[0][1] and passage[-10:] not in found[1]


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    found = {d: t or "" for d, t in got(spans.dedup_spans(docs)).items()}
    assert found == truth(rows)
