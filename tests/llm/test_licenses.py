import pytest

from chunkloom.llm import licenses
from tests.llm import samples


def matches(spark, text, **options):
    rows = licenses.scan(samples.documents(spark, [text]), **options).collect()
    return rows[0].licenses, rows[0].matches


def test_lines_paragraphs_and_texts(spark):
    assert matches(spark, "words\nReleased under the MIT  licence License.\nmore")[0] == []
    found, where = matches(spark, "Intro with several words here.\nReleased  under the MIT License!\nmore\n")
    assert found == ["MIT"] and [(m.kind, m["at"], m.dice) for m in where] == [("line", 1, 1.0)]
    found, where = matches(spark, "This work is licensed under the\nGNU General Public License, version 3.\n\nother text here with more words than the notice has, so that the whole is far from it")
    assert found == ["GPL-3.0"] and {m.kind for m in where} == {"paragraph"}
    found, _ = matches(spark, "This is free and unencumbered\n\nsoftware released into the public domain")
    assert found == ["Unlicense"]


def test_nearest_template_and_ties(spark):
    assert matches(spark, "Licensed under CC BY-NC 4.0.")[0] == ["CC-BY-NC-4.0"]
    assert matches(spark, "Licensed under CC BY 4.0.")[0] == ["CC-BY-4.0"]
    pair = [("b", "one two three"), ("a", "one two three")]
    assert matches(spark, "one two three", templates=pair)[0] == ["a"]
    assert matches(spark, "one two three", templates=[])[0] == [] and matches(spark, "one", templates=[("a", "one")])[0] == []


@pytest.mark.parametrize("size", [1, 2, 5, 12, 40])
@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_size_bounds_are_exact(size, least):
    low, high = licenses.size_bounds(size, least)
    for n in range(1, 200):
        reachable = 2 * min(n, size) / (n + size) >= least
        assert reachable == (low <= n <= high)


def test_edges(spark):
    texts = samples.edge_texts()
    docs = samples.documents(spark, texts).withColumnRenamed("source", "kind")
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id for r in rows if r.licenses} == {14} and all(r.kind == "s" for r in rows)
    assert licenses.scan(docs.limit(0)).collect() == []
