"""Many phrases at once, against plain search."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.functions import phrases, text
from chunkloom.operators import segments
from tests.helpers import rows

LETTERS = st.text(alphabet="abß가\x00 ", max_size=14)


@settings(max_examples=200, deadline=None)
@given(st.lists(LETTERS, max_size=12), st.lists(st.text(alphabet="abß가\x00 ", max_size=40), max_size=12))
def test_finds_what_plain_search_finds(searched, texts):
    index = phrases.Phrases(searched)
    want = [any(p and p in t for p in searched) for t in texts]
    assert index.found_in(pa.array(texts, pa.string())).tolist() == want


def test_phrases_do_not_reach_into_the_next_text(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 20)
    index = phrases.Phrases(["abcdefghij", "xy", "\x00\x00\x00"])
    texts = ["..abcdefg", "hij", "x", "y", None, "", "-abcdefghij-" * 5, "xy", "\x00\x00"]
    assert index.found_in(pa.array(texts)).tolist() == [False] * 6 + [True, True, False]


def random_texts(seed, n, size):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcDé .") for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("phrase_bytes", [segments.PHRASE_BYTES, 0])
def test_both_ways_agree_with_one_by_one(spark, phrase_bytes):
    texts, searched = random_texts(1, 300, 60), [*random_texts(2, 400, 12), "???", "d d"]
    searched = [p for p in searched if len(p) > 6]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "dd"])], "i int, text string")
    table = spark.createDataFrame([(p,) for p in [*searched, None, ""]], "p string")
    kept = segments.drop_stop_phrases(frame, table, phrase_bytes=phrase_bytes)
    assert rows(kept) == rows(frame.filter(~text.has_stop_phrase(F.col("text"), searched)))
    assert 30 < kept.count() < 290


def test_lists_of_any_length(spark):
    frame = spark.createDataFrame([(0, "a phrase-16-16 b"), (1, "phrase 9 999 ."), (2, None)], "i int, text string")
    for n in (0, 2, 17, 100, 5000):
        searched = [f"Phrase {i}{i}." for i in range(n)]
        want = rows(frame.filter(~text.has_stop_phrase(F.col("text"), searched)))
        assert rows(segments.drop_stop_phrases(frame, searched)) == want
        assert (len(want) == 3) == (n < 10) and (len(want) == 1) == (n > 16)


def test_time_hardly_depends_on_the_number_of_phrases():
    import time

    texts = pa.array(random_texts(3, 4000, 400))
    letters = "bcdfghjklmnp"
    rnd = random.Random(4)
    searched = ["".join(rnd.choice(letters) for _ in range(14)) for _ in range(50_000)]
    took = []
    for n in (500, 50_000):
        index = phrases.Phrases(searched[:n])
        start = time.perf_counter()
        index.found_in(texts)
        took.append(time.perf_counter() - start)
    assert took[1] < 5 * took[0] + 0.05


@settings(max_examples=200, deadline=None)
@given(st.lists(LETTERS, max_size=12), st.lists(st.text(alphabet="abß가\x00 ", max_size=40), max_size=12), st.booleans())
def test_marks_miss_no_phrase(searched, texts, layer):
    raw = sorted({p.encode() for p in searched if p})
    marks = phrases.Marks(12, {layer: sorted({len(p) for p in raw})}, np.zeros(1 << 12 >> 3, np.uint8))
    for places in marks.places(pa.array(raw, pa.binary()), layer).to_pylist() if raw else []:
        for p in places:
            marks.table[p - 1 >> 3] |= 1 << (p - 1 & 7)
    texts = [t.encode() for t in texts]
    rows, windows = marks.windows(texts, layer, None)
    found = {(r, w) for r, w in zip(rows.tolist(), windows) if w in raw}
    assert found == {(i, p) for i, t in enumerate(texts) for p in raw if p in t}
    assert all(w in texts[r] for r, w in zip(rows.tolist(), windows))


@pytest.mark.parametrize("bits, first", [(28, 4), (15, 1)])
def test_joins_make_no_more_rows_than_they_read(spark, monkeypatch, bits, first):
    """Phrases that start alike and texts that all hold their start, once with few bits, many parts and second searches."""
    monkeypatch.setattr(segments, "_MARK_BITS", bits)
    monkeypatch.setattr(segments, "_FIRST", first)
    made = {}
    keep = segments.stored
    monkeypatch.setattr(segments, "stored", lambda df, name: made.setdefault(name, []).append(keep(df, name)) or made[name][-1])
    searched = [f"the same start {i:04d}" for i in range(3000)]
    texts = [f"The same start {i:04d} of text" if i % 2 else f"The same start {i} of text" for i in range(2000)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    table = spark.createDataFrame([(p,) for p in searched], "p string")
    kept = segments.drop_stop_phrases(frame, table, phrase_bytes=0)
    assert [r.i for r in kept.orderBy("i").collect()] == list(range(0, 1000, 2))
    assert len(made["texts-found"]) == 2 * (1 if bits == 28 else 3)
    assert sum(df.count() for df in made["phrase-windows"]) < (10 if bits == 28 else 100) * len(texts)
    joined = made["phrase-windows"][0].join(made["phrase-layers"][0].select("raw", F.col("phrase").cast("binary").alias("phrase")), ["raw", "phrase"])
    assert joined.count() <= made["phrase-windows"][0].count()


def test_many_phrases_take_little_memory():
    import tracemalloc

    rnd = random.Random(5)
    searched = ["".join(rnd.choice("bcdfghjklmnp") for _ in range(14)) for _ in range(50_000)]
    tracemalloc.start()
    index = phrases.Phrases(searched)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40e6 and index.found_in(pa.array([searched[7], "b"])).tolist() == [True, False]
