import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chunkloom.llm import packing
from chunkloom.llm.queries import PACKED_VOCABULARY
from tests.llm.samples import documents, edge_texts, with_clashes, words

PATH = public_tokenizers.path(PACKED_VOCABULARY)
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocabulary():
    return packing.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return packing.Encoder(vocabulary, PATTERN)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END]


def padded(lengths, size):
    return sum(0 if n & (n - 1) == 0 and n >= packing.SHORTEST else size - n for n in lengths)


def least_cost(places, price, size):
    """All pairs of places, without a queue."""
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = int(places[j] - places[i])
            if n <= size:
                best[j] = min(best[j], best[i] + padded([n], size) + price[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(40))
def test_windows_cost_the_least(seed):
    rnd = random.Random(seed)
    size = rnd.choice([64, 100, 128, 300])
    gaps = [rnd.choice([1, 2, 7, 16, rnd.randint(1, 60)]) for _ in range(rnd.randint(1, 120))]
    places = np.cumsum([0, *gaps])
    price = np.array([0.0, *(float(rnd.choice([0, 2, 8])) for _ in gaps)])
    price[-1] = 0.0
    starts = packing.windows(places, price, size)
    lengths = np.diff(starts, append=places[-1])
    assert starts[0] == 0 and lengths.min() > 0 and lengths.max() <= size
    cost = padded(lengths.tolist(), size) + sum(price[np.searchsorted(places, s)] for s in starts[1:])
    assert cost == pytest.approx(least_cost(places.tolist(), price.tolist(), size))


def test_cut_points_leave_no_long_gap():
    places, price = packing.cut_points(1000, np.array([100, 700, 1000]), np.array([99, 130, 600]), packing.Costs(2, 8))
    assert np.diff(places).max() <= packing.STEP and places[0] == 0 and places[-1] == 1000
    cost = dict(zip(places.tolist(), price.tolist()))
    assert cost[100] == cost[700] == 0 and cost[130] == cost[600] == 2 and 99 not in cost and cost[146] == 8


def test_ids_of_the_library(encoder, library):
    rnd = random.Random(5)
    signs = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = [t for _, t in edge_texts() if t] + ["".join(rnd.choice(signs) for _ in range(300)) for _ in range(100)]
    texts += ["<|endoftext|> it's we'LL  \n\n x", " " * 5000 + "x", "a " * 3 + " " * 2100 + "\n　b", "日本語。文が二つ！はい"]
    for text in texts:
        assert encoder.ids(text).tolist() == library(text)


def test_long_texts_in_parts(encoder, library, monkeypatch):
    monkeypatch.setattr(packing, "PART_CHARS", 50)
    for text in [words(3, 400), "x" * 1000, ("word  two\n three " * 40), "don't 12 !? " * 50, "é ß " * 200]:
        assert encoder.ids(text).tolist() == library(text)


def test_sentence_cuts(encoder):
    stream = encoder.ids('One. Two "three." Four\nfive v1.2 x? Six')
    cuts = encoder.sentence_cuts(stream)
    tokens = {i: t.decode() for t, i in packing.read_vocabulary(PATH).ranks.items() if t.isascii()}
    parts = ["".join(tokens[i] for i in part) for part in np.split(stream[:-1], cuts)]
    assert parts == ["One.", ' Two "three."', " Four\n", "five v1.2 x?", " Six"]


def check_pieces(rows, texts, library, size):
    """The pieces are whole, and sequences are without gaps and bounded."""
    sequences, by_doc = {}, {}
    for r in rows:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) <= size
    want = {}
    for i, text in texts:
        want.setdefault(i, []).append(library(text or ""))
    assert set(by_doc) == set(want)
    for i, lists in want.items():
        got = [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in sorted(by_doc[i], key=lambda r: (r.sequence_id, r.offset))]
        assert sum(got, []) == sum(lists, [])
        assert {r.doc_tokens for r in by_doc[i]} == {len(x) for x in lists}
        assert sum(r.length for r in by_doc[i]) == sum(map(len, lists))
    return [sum(r.length for r in own) for own in sequences.values()]


@pytest.mark.parametrize("stretch", [1 << 20, 3000])
def test_pieces(spark, vocabulary, library, stretch):
    texts = edge_texts()
    docs = with_clashes(documents(spark, texts)).repartition(3, "doc_id")
    rows = packing.pack(docs, vocabulary, PATTERN, size=256, stretch=stretch).collect()
    lengths = check_pieces(rows, texts, library, 256)
    assert padded(lengths, 256) < 0.05 * sum(lengths)


def test_order_is_kept(spark, vocabulary):
    docs = documents(spark, [words(i, 30 + 17 * (i % 40)) for i in range(100)]).coalesce(1)
    rows = sorted(packing.pack(docs, vocabulary, PATTERN).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert [(r.doc_id, r.start) for r in rows] == sorted((r.doc_id, r.start) for r in rows)


def test_empty_table(spark, vocabulary):
    assert packing.pack(documents(spark, []), vocabulary, PATTERN).collect() == []


def test_query_on_a_driver_table(spark, library):
    from chunkloom.llm.queries import op13_packing
    from tests.llm.test_queries import FOLDER

    texts = {r.doc_id: library(r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op13_packing(spark, FOLDER).collect()
    lengths = {}
    for r in rows:
        own = np.array(texts[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(texts[r.doc_id])
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert sum(lengths.values()) == sum(map(len, texts.values())) and max(lengths.values()) <= 1024
    assert padded(lengths.values(), 1024) < 0.01 * sum(lengths.values())
