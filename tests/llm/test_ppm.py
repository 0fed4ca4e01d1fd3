import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import ppm
from tests.llm import samples


def brute(rows, train):
    trie, counts = ppm.Trie(), collections.Counter()
    for i, text in rows:
        if train(i):
            raw = (text or "").encode()
            counts.update([*ppm.words(raw), ppm.END])
            context = bytes(ppm.ORDER)
            for symbol in b" ".join(ppm.words(raw)) + ppm.END:
                trie.learn(context, symbol)
                context = context[1:] + bytes([symbol])
    total = sum(counts.values())
    out = {}
    for i, text in rows:
        raw = (text or "").encode()
        own = [*ppm.words(raw), ppm.END]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        out[i, text] = len(own), sum(counts[w] > 0 for w in own), total, base, trie.text(raw, learn=False)
    return out


@pytest.mark.parametrize("limit", [10**9, 0])
@pytest.mark.parametrize("some", [True, False])
def test_against_a_plain_trie(spark, limit, some):
    rows = [(i, t if t is None or len(t) < 5000 else t[:5000]) for i, t in samples.edge_texts()] + [(20 + i, samples.words(i, 40, 60)) for i in range(20)]
    docs = samples.with_clashes(samples.documents(spark, rows))
    train = (F.col("doc_id") % 3 != 0) if some else F.lit(False)
    model = ppm.fit(docs, train)
    got = ppm.score(docs, model, broadcast_rows=limit, block_bytes=2000).collect()
    want = brute(rows, lambda i: some and i is not None and i % 3 != 0)
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r.doc_id, r.text]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score) and r.hits == "x"


def test_followers_are_a_distribution():
    trie = ppm.Trie()
    trie.text(b"the cat sat on the mat the end")
    for context in (b"\0\0\0\0\0", b" the ", b"qqqqq", b"at on"):
        assert sum(10 ** trie.cost(context, s) for s in range(256)) == pytest.approx(1)


def test_adaptive(spark):
    texts = ["again and again and again and again", None, "", "zxcvbnmasdfghjkl qwertyuiop"]
    got = {r.doc_id: r.score for r in ppm.adaptive(samples.documents(spark, texts)).collect()}
    assert got[1] == got[2] == pytest.approx(-math.log10(256))
    assert got[0] / len(texts[0]) > got[3] / len(texts[3])


def test_long_texts_and_empty_table(spark):
    docs = samples.documents(spark, ["x" * 300_000, samples.words(1, 50_000, 90_000)])
    model = ppm.fit(docs, F.lit(True))
    got = {r.doc_id: r for r in ppm.score(docs, model).collect()}
    assert got[0].n_tokens == 2 and -100_000 < got[0].score < 0 and got[1].n_tokens == 50_001 and -1e6 < got[1].score < 0
    none = docs.limit(0)
    assert ppm.score(none, ppm.fit(none, F.lit(True))).collect() == []


def normal(text):
    """Words by an expression, small letters by ASCII only, one space between words, a line break as the end."""
    small = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", small)) + b"\n"


def plain_cost(training, context, symbol):
    """By searching the training texts for each context anew, the longest first."""
    probability, excluded = 1.0, set()
    for length in range(5, -1, -1):
        end = context[5 - length :]
        after = collections.Counter(t[i] for t in training for i in range(5, len(t)) if t[i - length : i] == end and t[i] not in excluded)
        if symbol in after:
            return math.log10(probability * after[symbol] / (after.total() + len(after)))
        if after:
            probability *= len(after) / (after.total() + len(after))
            excluded |= after.keys()
    return math.log10(probability / (256 - len(excluded)))


def test_against_contexts_searched_for(spark):
    texts = ["the cat sat on the mat", "The  dog\tsat", "a cat and a dög", None, "", "zebra the", "the cat sat on the mat", "on on on on"]
    docs = samples.documents(spark, texts)
    got = {r.doc_id: r.score for r in ppm.score(docs.coalesce(1), ppm.fit(docs.coalesce(1), F.col("doc_id") < 5)).collect()}
    padded = [bytes(5) + normal(t) for t in texts]
    for i, text in enumerate(padded):
        assert got[i] == pytest.approx(sum(plain_cost(padded[:5], text[j - 5 : j], text[j]) for j in range(5, len(text))))


def test_scores_by_small_runs_of_texts(monkeypatch):
    texts = [samples.words(i, 1 + i % 9, 30).encode() if i % 4 else None for i in range(50)]
    run = ppm.Run(texts)
    keys, n = run.counts(np.arange(50) % 3 > 0)
    grams = keys < ppm.WORD
    tables = (keys[grams], np.log10(1 / (2.0 + n[grams]))), (keys[~grams], n[~grams]), 100, 10
    whole = run.scores(*tables)["score"]
    monkeypatch.setattr(ppm, "TEXT_BITS", 2)
    assert run.scores(*tables)["score"].tolist() == whole.tolist()
    for i in (0, 1, 7):
        assert ppm.Run([texts[i]]).scores(*tables)["score"].tolist() == [whole[i]]
    assert ppm.Run([]).scores(*tables)["score"].tolist() == []
