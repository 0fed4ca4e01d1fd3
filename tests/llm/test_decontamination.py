import re

import pytest

from chunkloom.llm import decontamination
from tests.llm import samples

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window):
    own, hit, found = split(text), set(), set()
    for item, body in items:
        theirs = split(body)
        n = min(window, len(theirs))
        for a in range(len(theirs) - n + 1 if n else 0):
            for b in range(len(own) - n + 1):
                if own[b : b + n] == theirs[a : a + n]:
                    hit |= set(range(b, b + n))
                    found.add(item)
    return len(own), len(hit), sorted(found - {None})


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_against_all_places(spark, block):
    texts = [samples.words(s, 60, 4) for s in range(25)] + [None, "", "W1, w2; W3", "w1 w2 w3", samples.words(99, 20_000, 50_000)]
    items = [(i, samples.words(100 + i, 9, 4)) for i in range(6)] + [(6, "w1 W2 w3"), (7, None), (8, ""), (6, "w0 w0"), (None, "w3 w3 w3 w3")]
    docs = samples.with_clashes(samples.documents(spark, [*texts, (3, texts[3])]))
    got = decontamination.find(docs, items_frame(spark, items), window=5, block_bytes=block)
    assert [c for c in got.columns if c in ("hits", "score", "n_words")] == ["score", "n_words", "hits"]
    rows = got.collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        n, hit, found = brute(texts[r.doc_id], items, 5)
        assert (r.n_words, sum(h.end - h.start for h in r.hits), r["items"]) == (n, hit, found)
        assert all(a.end < b.start for a, b in zip(r.hits, r.hits[1:]))


def test_matches_end_at_documents(spark):
    docs = samples.documents(spark, ["a b c", "d e f"])
    got = decontamination.find(docs, items_frame(spark, [(1, "b c d e")]), window=4)
    assert all(not r.hits for r in got.collect())


def test_proximity(spark):
    docs = samples.documents(spark, ["x one far two x three", "one x x x x x x x two three", "three two one", None])
    got = decontamination.find(docs, items_frame(spark, [(1, "one two three")]), window=3, within=5)
    near = {r.doc_id: r.near_items for r in got.collect()}
    assert near == {0: [1], 1: [], 2: [1], 3: []}


def test_empty_tables(spark):
    docs = samples.documents(spark, ["a b"])
    assert decontamination.find(docs.limit(0), items_frame(spark, [(1, "a")])).collect() == []
    assert [r["items"] for r in decontamination.find(docs, items_frame(spark, [])).collect()] == [[]]
