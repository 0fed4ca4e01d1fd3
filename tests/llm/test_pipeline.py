"""The pipeline on a small folder, against plain versions of its stages."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from chunkloom.llm import bpe
from tests.llm import samples
from tests.llm.test_decontamination import brute as windows
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_line_dedup import brute as lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rows = [(i, samples.words(i, 30 + i % 40, 3000)) for i in range(400)]
    foul = {i for i in range(0, 400, 4)}
    rows = [(i, t + (" filthy wretch swine" if i in foul else "")) for i, t in rows]
    passage = "\n".join(samples.words(5000 + i, 9, 3000) for i in range(15))
    rows += [(500 + i, f"{samples.words(600 + i, 20, 3000)}\n{passage}\n{samples.words(700 + i, 20, 3000)}") for i in range(5)]
    base = samples.words(800, 200, 3000).split()
    rows += [(800 + i, " ".join([*base[:100], f"edit{i}", *base[101:]])) for i in range(6)]
    rows += [(900, "before " + samples.words(9001, 12, 3000) + " after"), (901, None), (902, ""), (903, rows[1][1]), (904, rows[1][1]), (904, rows[1][1])]
    rows += [(905, samples.words(905, 30_000, 60_000))]
    return rows, foul


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, foul = corpus()
    samples.documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i in foul)) for i, t in rows if i < 400]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, samples.words(9001, 12, 3000)), (2, samples.words(9002, 40, 3000)), (3, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, foul, items


def test_stages_against_plain_versions(spark, folder):
    path, rows, foul, items = folder
    kept, docs = rows, spark.read.parquet(f"{path}/documents.parquet")
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, path)
        if at < 4:
            assert docs.columns == COLUMNS, name
        docs.write.parquet(f"{path}/stage-{at}")
        docs = spark.read.parquet(f"{path}/stage-{at}")
        got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
        if at == 0:
            kept = [r for r in kept if r[0] not in foul]
        elif at == 1:
            clean = lines(kept)
            kept = [(i, t if t is None else clean[i, t][0]) for i, t in kept if t is None or not t or clean[i, t][1] <= t.count("\n")]
        elif at == 2:
            label = groups(kept, 5, 80)
            kept = sorted({r for r in kept if label[r[0]][1] == r[0]}, key=repr)
        elif at == 3:
            kept = [r for r in kept if not windows(r[1], items, 10)[1]]
        assert got == sorted(kept, key=repr), name
        if at < 4:
            assert docs.filter(F.coalesce(F.length("text"), F.lit(-1)) != F.coalesce("n_chars", F.lit(-1))).isEmpty()
    ids = {i for i, _ in kept}
    assert {1, 3, 500, 800, 901, 902, 905} <= ids and not {900, 903, 904, 801, 802, 0, 4} & ids
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in docs.collect():
        assert r.token_ids == library.encode_ordinary(r.text or "")
        assert r.n_tokens == len(r.token_ids) and r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_no_piece_of_a_copy_of_many_lines_is_left(spark, tmp_path):
    texts = {i: "\n".join(samples.words(1000 * i + j, 8, 3000) for j in range(30)) for i in range(1, 9)}
    rows = [*texts.items(), *((100 + i, t) for i, t in texts.items())]
    for i, t in texts.items():
        own = t.split("\n")
        rows.append((200 + i, "\n".join([*own[:i], f"edit {i} " + own[i], *own[i + 1 :]])))
        rows.append((300 + i, f"a new head {i}\n{t}\na new end {i}"))
    rows.append((400, "\n".join([samples.words(4000, 60, 3000), *texts[1].split("\n")[:9], samples.words(4001, 60, 3000)])))
    samples.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path))
    assert pieces.filter("doc_id between 100 and 399").count() > 20
    left = corpus_pipeline.drop_near_copies(spark, pieces, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in left if r.doc_id < 400} == texts and len(left) == 9


def test_run_gives_the_last_stage(spark, folder):
    got = corpus_pipeline.run(spark, folder[0])
    assert got.columns == [*COLUMNS, "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 200


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", samples.SCHEMA), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("ids", [[2**63 - 1, -5, 3, 8], [-(2**63), 2**63 - 1, 2**62 + 7, -9], [-(2**63), -3, -2, -1], [0, 1, 2, 3]])
def test_near_copies_under_any_ids(spark, ids):
    """The second document has lost lines since it was read, and resembles the first by its earlier text only."""
    whole = samples.words(1, 200, 5000)
    lost = " ".join(whole.split()[:60])
    before = [(ids[0], whole), (ids[1], whole), (ids[2], samples.words(2, 100, 5000)), (ids[3], samples.words(3, 100, 5000)), (None, "no id")]
    now = [(i, lost if i == ids[1] else t) for i, t in before]
    groups = corpus_pipeline.grouped(samples.documents(spark, now), samples.documents(spark, before)).collect()
    of = {}
    for r in groups:
        if r.doc_id is not None:
            of[r.doc_id] = min(of.get(r.doc_id, r.component_id), r.component_id)  # a changed document has a row for each of its texts
    assert of == {ids[0]: min(ids[:2]), ids[1]: min(ids[:2]), ids[2]: ids[2], ids[3]: ids[3]}
