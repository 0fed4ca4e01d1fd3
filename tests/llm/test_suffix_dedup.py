import random

import numpy as np
import pytest

from chunkloom.llm import suffix_dedup
from tests.llm import samples

LENGTH = suffix_dedup.LENGTH


def brute(rows):
    """By (id, text): removed runs."""
    low = -(2**63)
    seen, out = {}, {}
    docs = sorted({(low if i is None else i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    for i, text in docs:
        b = text.encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - LENGTH + 1):
            if seen.setdefault(b[s : s + LENGTH], (i, s)) != (i, s):
                gone[s : s + LENGTH] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out[i, text] = [(int(a), int(z - a)) for a, z in zip(edges[::2], edges[1::2])]
    return out


def corpus():
    rnd = random.Random(6)
    prose = [samples.words(s, 150, 5000) for s in range(12)]
    rows = list(samples.edge_texts())
    for n in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            text = rnd.choice(prose)
            a = rnd.randrange(len(text))
            parts.append(text[a : a + rnd.randrange(60, 500)])
        rows.append((100 + n, rnd.choice(["", "-", "é" * 20]).join(parts)))
    rows += [(200, "ab" * 300), (201, "ab" * 120 + "c" * 150), (202, prose[0] * 3), (300, prose[1]), (300, prose[1])]
    line = samples.words(88, 30, 5000)
    rows += [(400 + i, samples.words(900 + i, 12, 5000) + line + samples.words(950 + i, 12, 5000)) for i in range(30)]
    return rows


@pytest.mark.parametrize("hot, contexts, held", [(4096, 6000, 1 << 20), (3, 40, 50)])
def test_against_all_strings(spark, monkeypatch, hot, contexts, held):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BUCKET_CONTEXTS", contexts)
    rows = corpus()
    docs = samples.with_clashes(samples.documents(spark, rows)).withColumnRenamed("source", "raw").withColumn("copy", __import__("pyspark").sql.functions.col("text"))
    want = brute(rows)
    got = suffix_dedup.dedup(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    for r in got:
        raw = (r["copy"] or "").encode()
        runs = want.get((-(2**63) if r.doc_id is None else r.doc_id, r["copy"]), [])
        assert [(x["first"], x["n"]) for x in r.removed] == runs
        kept = bytearray(raw)
        for first, n in reversed(runs):
            del kept[first : first + n]
        assert (bytes(r.kept), r.n_bytes, r.n_removed) == (bytes(kept), len(raw), len(raw) - len(kept)) and r.raw == "s"


def test_empty_table(spark):
    assert suffix_dedup.dedup(samples.documents(spark, ["a"]).limit(0)).collect() == []


def order(strings, depth):
    return sorted(((t[o:] + b"\0")[:depth], s, o) for s, t in enumerate(strings) for o in range(len(t) + 1))


@pytest.mark.parametrize("step", [1, 2])
@pytest.mark.parametrize("seed", range(20))
def test_merged_transforms(seed, step):
    rnd = random.Random(seed)
    strings = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 40))) for _ in range(rnd.randint(1, 9))]
    depth = step * rnd.randint(1, 8)
    parts = [suffix_dedup.Transform(strings[a : a + 3], step) for a in range(0, len(strings), 3)]
    turn, new, common = suffix_dedup.merge(parts, depth)
    assert (new[1:] == (common[1:] < depth)).all()
    rows = np.empty((len(turn), 2), np.int64)
    for z, part in enumerate(parts):
        own = turn == z
        rows[own] = np.array(part.places()).T + [3 * z, 0]
    tails = [strings[s][o:] for s, o in rows]
    assert [t[:depth] for t in tails] == sorted(t[:depth] for t in tails)
    for a, b, n in zip(tails, tails[1:], common[1:]):
        same = next((i for i in range(depth) if i >= min(len(a), len(b)) or a[i] != b[i]), depth)
        assert n == same - same % step


def test_every_string_has_its_anchor():
    text = samples.words(3, 400, 50).encode() + b"x" * 300
    gram, context, left, right, at, first, last = suffix_dedup.anchors(text)
    assert first[0] == 0 and last[-1] == len(text) - LENGTH and (first[1:] == last[:-1] + 1).all()
    assert ((at >= last) & (at <= first + LENGTH - suffix_dedup.GRAM)).all()


def test_anchors_of_many_texts_are_those_of_each():
    rnd = random.Random(8)
    texts = [bytes(rnd.choices(b"ab ", k=rnd.randrange(LENGTH, 4 * LENGTH))) for _ in range(40)] + [b"a" * LENGTH, b"ab" * 300]
    text, *found = suffix_dedup.anchors_of(texts)
    for i, own in enumerate(texts):
        for both, single in zip(found, suffix_dedup.anchors(own)):
            assert both[text == i].tolist() == single.tolist()
