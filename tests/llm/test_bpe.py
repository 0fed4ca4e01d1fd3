import random

import public_tokenizers
import pytest
import tiktoken

from chunkloom.llm import bpe
from tests.llm import samples

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_round_trip_like_the_library(spark):
    rnd = random.Random(2)
    texts = [t for _, t in samples.edge_texts()]
    texts += ["".join(rnd.choice("ab \n'stéß中😀19_") for _ in range(rnd.randrange(80))) for _ in range(60)]
    texts += ["z" * 5000, "ab" * 400, "<|endoftext|>", "  \n\n  x", "don't I'LL"]
    docs = samples.with_clashes(samples.documents(spark, texts))
    for r in bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect():
        assert r["ids"] == LIBRARY.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
        assert r.hits == "x"


def test_encode_then_decode(spark):
    docs = samples.documents(spark, ["ab é", None])
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()} == {0: "ab é".encode(), 1: b""}


def test_unknown_ids_decode_to_nothing(spark):
    given = spark.createDataFrame([([0, 999_999, None, 0],), (None,), ([],)], "ids array<int>")
    zero = bytes([33]) if RANKS.get(b"!") == 0 else next(t for t, r in RANKS.items() if r == 0)
    assert sorted(bytes(r.decoded) for r in bpe.decode(given, RANKS, public_tokenizers.PATTERN).collect()) == [b"", b"", zero * 2]


def test_heap_and_query_agree():
    rnd = random.Random(4)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    raw = ["".join(rnd.choice("aabcé中") for _ in range(rnd.randint(1, 40))).encode() for _ in range(200)]
    assert coder.merged(raw) == [bpe.merge_long(w, RANKS) for w in raw]


def test_words_are_forgotten_beyond_a_bound(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    for text in ["a b c d e f", "b c x y", "a b c d"]:
        ids, ends = coder.encode([text.encode(), None, b""])
        assert ids.tolist() == LIBRARY.encode_ordinary(text) and ends.tolist() == [len(ids)] * 3
        assert coder.decode(ids, ends) == [text.encode(), b"", b""]


def test_frequent_words_outlive_the_bound_and_the_task(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 4)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    coder.encode([b"qqzx qqzy qqzz qqzw qqzv" + b" qqzy" * 3])
    coder.rest()
    assert set(coder.number) == {" qqzy"}
    for text in ["qqzx qqzy", " qqzy qqzw" * 3, "qqzx qqzy"]:
        ids, ends = coder.encode([text.encode()])
        assert ids.tolist() == LIBRARY.encode_ordinary(text) and coder.decode(ids, ends) == [text.encode()]
        coder.rest()


def test_long_words_are_not_kept_beyond_a_bound_of_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 1000)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    for text in ["xq" * 600 + " abqz" + " abqz", "xq" * 600 + " abqz abqz"]:
        assert coder.encode([text.encode()])[0].tolist() == LIBRARY.encode_ordinary(text)
    coder.rest()
    assert set(coder.number) == {" abqz"}


@pytest.mark.parametrize("letters, size", [("abcdefghijklmnopqrstuvwxyz", 250), ("中文字元編碼語言測試詞", 84)])
def test_text_of_long_different_words(letters, size):
    rnd = random.Random(size)
    text = " ".join("".join(rnd.choices(letters, k=size)) for _ in range((3 << 20) // (size * len(letters[0].encode()))))
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    ids, ends = coder.encode([text.encode()])
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert coder.decode(ids, ends) == [text.encode()]


@pytest.mark.parametrize("rows", [0])
def test_empty_table(spark, rows):
    docs = samples.documents(spark, ["a"]).limit(rows)
    assert bpe.digests(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)).collect() == []
