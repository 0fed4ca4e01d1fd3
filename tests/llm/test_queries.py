"""The registered queries on a driver folder."""

import os

import pytest

from chunkloom.llm import queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_ppm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_exact_topk": "query_id rank vec_id score",
    "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_jaccard_join": "doc_id n_shingles component_id",
    "op7_licenses": "doc_id licenses n_matches best_dice",
    "op8_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op9_line_dedup": "doc_id n_lines n_removed n_chunks kept_sha256",
    "op10_toxicity": "doc_id held_out score predicted predicted_by_lang",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_spelling": "word form root n n_near form_n",
    "op13_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    assert df.columns == COLUMNS[name].split()
    rows = df.collect()
    if name == "op13_packing":
        assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    elif name not in ("op4_exact_topk", "op11_whitening", "op12_spelling"):
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


def test_every_operator_has_one_query():
    assert sorted(queries.queries()) == sorted(COLUMNS)


@pytest.mark.parametrize("name", ["op5_sharding", "op7_licenses", "op9_line_dedup"])
def test_native_operators_run_no_python(spark, name):
    plan = queries.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
