"""Columns of the caller with the inner names of operators come back with their values."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import bpe, decontamination, licenses, line_dedup, ppm, queries, suffix_dedup, toxicity
from tests.llm.samples import documents, words

INNER = "_id _text _lines _hits _words _grams _doc _tx _runs _block _own hash chunk first first_id n again unit kind at n_grams template theirs dice best word train key cost value part doc tx line lines".split()
LINES = "\n".join(words(s, 12) for s in range(30))


def sample(spark):
    docs = documents(spark, [LINES, LINES, "Released under the MIT License.\nmore", None, "", words(3, 60)])
    return docs.withColumns({name: F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for name in INNER})


def fitted(docs):
    return ppm.fit(docs, F.lit(True))


RUNS = {
    "op1": lambda docs: bpe.digests(bpe.round_trip(docs, bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY)), public_tokenizers.PATTERN)),
    "op2": suffix_dedup.dedup,
    "op3": lambda docs: ppm.score(docs, fitted(docs)),
    "op3 in blocks": lambda docs: ppm.score(docs, fitted(docs), broadcast_rows=0),
    "op7": licenses.scan,
    "op8": lambda docs: decontamination.find(docs, docs.sparkSession.createDataFrame([(1, words(3, 60))], "item_id bigint, text string"), window=10),
    "op9": line_dedup.dedup,
}


@pytest.mark.parametrize("name", RUNS)
def test_inner_names(spark, name):
    docs = sample(spark)
    rows = RUNS[name](docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(6))
    assert all(r[c] == f"{c} {r.doc_id}" for r in rows for c in INNER)
    without = {r.doc_id: r for r in RUNS[name](docs.drop(*INNER)).collect()}
    assert all(r[c] == without[r.doc_id][c] for r in rows for c in without[r.doc_id].asDict())


def test_text_and_id_with_inner_names(spark):
    docs = documents(spark, [LINES, LINES, None]).withColumnsRenamed({"text": "_text", "doc_id": "_id"})
    done = {r["_id"]: r for r in line_dedup.dedup(docs, id_column="_id", text="_text").collect()}
    assert done[0]["_text"] == LINES and done[0].n_removed == 0 and done[1].n_removed > 0


def test_digests_replace_columns_of_their_names(spark):
    docs = documents(spark, ["a b"]).withColumns({"n_tokens": F.lit("x"), "ids_sha256": F.lit("y")})
    row = RUNS["op1"](docs)
    assert row.columns.count("n_tokens") == 1 and row.first().n_tokens == 2


@pytest.mark.parametrize("letter", ["e", "が"])
def test_long_text_of_long_words(letter):
    """Three MiB of different words, each below the length at which they go to a heap."""
    import random

    import tiktoken

    rnd = random.Random(1)
    letters = {"e": "etaoinsr", "が": "がぎぐげござじ"}[letter]
    size = 249 // len(letter.encode())
    text = " ".join("".join(rnd.choice(letters) for _ in range(size)) for _ in range(3 * (1 << 20) // 251))
    ranks = bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    ids, ends = bpe.Coder(ranks, public_tokenizers.PATTERN).encode([text.encode()])
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ends.tolist() == [len(ids)] and ids.tolist() == plain.encode_ordinary(text)
