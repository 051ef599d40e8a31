"""Sentence spans against brute force."""

import random

from helpers import documents, with_clashes

from ledgerwave.llm import spans


def truth(rows, at_least=spans.SENTENCES, words=spans.WORDS, long=spans.LONG):
    """Texts without the sentences of any run that has occurred before."""
    seen, result = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        places = spans.sentences(text or "")
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
        result[doc_id] = None if text is None else "".join(text[a:b] for i, (a, b) in enumerate(places) if i not in gone)
    return result


def got(frame):
    return {r["row"]["doc_id"]: r["row"]["text"] for r in frame.collect()}


def test_sentences_make_up_the_text():
    for text in ("A b. C d!? E\n\n f.g h.\t\ni", "", "\n", ".", "...\n..", "a.\nb. \n c"):
        assert "".join(text[a:b] for a, b in spans.sentences(text)) == text
    parts = [text[a:b] for text in ["One two. Three 4.5 four! Five\nSix"] for a, b in spans.sentences(text)]
    assert [p.strip() for p in parts if p.strip()] == ["One two.", "Three 4.5 four!", "Five", "Six"]


def test_whole_table(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(spans.dedup_spans(docs)) == truth(rows)


def test_passages_are_cut(spark):
    own = random.Random(4)

    def prose(n):
        return " ".join(" ".join(own.choice("abcdefghij") * 2 for _ in range(9)).capitalize() + "." for _ in range(n))

    passage, lone = prose(7), " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(i, f"{prose(4)} {passage}\n{prose(3)}") for i in range(8)] + [(20 + i, f"{prose(2)}\n{lone}\n{prose(2)}") for i in range(3)]
    rows += [(40, passage + " " + passage), (41, prose(12))]
    found = got(spans.dedup_spans(documents(spark, rows)))
    assert found == truth(rows)
    assert found[0] == rows[0][1] and found[41] == rows[-1][1]
    assert all(passage[30:200] not in found[i] for i in [*range(1, 8), 40]) and lone in found[20] and lone not in found[21]


def test_odd_rows(spark):
    text = "One two three four five six seven. Eight nine ten eleven twelve thirteen. " * 4
    rows = [(1, text), (2, text.upper()), (3, None), (4, ""), (5, "short. text."), (6, "short. text."), (None, "x y. " * 30), (7, "z " * 80_000)]
    docs = with_clashes(documents(spark, rows), "row", "hash", "starts", "parts", "removed", "text_key", "first", "n")
    found = spans.dedup_spans(docs)
    assert found.select("row.*").columns == docs.columns
    texts = got(found)
    # Of a text with tens of thousands of equal sentences the first run stays; all its runs are too many for the truth.
    assert texts.pop(7).startswith("z " * spans.WORDS) and len(rows.pop(-1)[1]) == 160_000
    assert texts == truth(rows)
    twice = spans.dedup_spans(documents(spark, [(1, text + "End one."), (1, text + "End one.")]))
    assert len({r["row"]["text"] for r in twice.collect()}) == 1 and twice.count() == 2


def test_empty(spark):
    assert spans.dedup_spans(documents(spark, [])).count() == 0


def test_long_sentences_are_cut_alike_wherever_they_stand():
    own = random.Random(6)
    words = ["".join(own.choice("abcdefgh") for _ in range(own.randrange(2, 7))) + own.choice(["", "", "", ","]) for _ in range(200)]
    text = " ".join(words) + "."
    assert "".join(text[a:b] for a, b in spans.sentences(text)) == text
    parts = {text[a:b].strip() for a, b in spans.sentences(text)}
    other = "  Something else before it " + " ".join(words[50:150]) + " and after it. End."
    own_parts = [other[a:b].strip() for a, b in spans.sentences(other)]
    assert len(parts) > 20 and sum(p in parts for p in own_parts) >= len(own_parts) - 4


def test_passages_in_mid_sentence(spark):
    """Passages of 55 words put anywhere in two texts: in nine of ten something goes, and no other text changes."""
    own = random.Random(10)

    def prose(n):
        made = []
        for _ in range(n):
            made.append("".join(own.choice("abcdefghijklmnop") for _ in range(own.randrange(2, 8))))
            made[-1] += own.choices(["", ",", "."], [12, 1, 1])[0]
        return made

    rows, passages = [(i, prose(150)) for i in range(240)], [prose(55) for _ in range(100)]
    for i, passage in enumerate(passages):
        for doc in (i, 100 + i):
            words = rows[doc][1]
            at = own.randrange(len(words))
            rows[doc] = (doc, words[:at] + passage + words[at:])
    rows = [(i, " ".join(words)) for i, words in rows]
    found = got(spans.dedup_spans(documents(spark, rows)))
    changed = {i for i, text in rows if found[i] != text}
    assert changed <= set(range(100, 200)) and len(changed) >= 90
