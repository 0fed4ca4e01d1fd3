import numpy as np

from chunkloom.llm import toxicity
from tests.llm import samples

LABELS = "doc_id bigint, quality int, toxic int"


def labelled(n, seed=0):
    """Texts whose label is whether a foul word, or one made from a foul stem, occurs."""
    rng = np.random.default_rng(seed)
    texts, toxic = [], []
    for i in range(n):
        words = samples.words(seed * 100_000 + i, int(rng.integers(5, 60)), 3000).split()
        bad = rng.random() < 0.3
        if bad:
            words[rng.integers(len(words))] = "vilest" if i % 2 else f"grubby{rng.integers(1000)}"
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, np.array(toxic)


def test_held_out_accuracy():
    texts, toxic = labelled(1200)
    model = toxicity.fit([t.encode() for t in texts], toxic.astype(np.float32), ["en"] * len(texts))
    others, truth = labelled(400, 1)
    scores = model.score([t.encode() for t in others])
    assert ((scores >= 0.7) == truth).mean() > 0.97
    assert ((scores >= model.threshold("en")) == truth).mean() > 0.97
    assert model.threshold("xx") == model.threshold(None) == toxicity.THRESHOLD


def test_score_does_not_depend_on_the_batch():
    texts, toxic = labelled(300)
    model = toxicity.fit([t.encode() for t in texts], toxic.astype(np.float32), ["en"] * len(texts))
    raw = [t.encode() for t in texts[:30]] + [None, b"", samples.words(5, 90_000).encode()]
    assert np.allclose(model.score(raw), [model.score([t])[0] for t in raw], atol=1e-6)


def test_edges(spark):
    texts = samples.edge_texts()
    docs = samples.with_clashes(samples.documents(spark, texts))
    labels = spark.createDataFrame([(0, 1, 0), (4, 1, 1), (4, 0, 0), (5, 1, 0), (7, None, None), (None, 1, 1), (999, 1, 1)], LABELS)
    model = toxicity.train(docs, labels)
    rows = toxicity.classify(docs, model).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.threshold == 0.7 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id == 5}) == 1 and rows[0].hits == "x"
    assert toxicity.classify(docs.limit(0), model).collect() == []


def test_without_labels(spark):
    docs = samples.documents(spark, ["a b", None])
    model = toxicity.train(docs, spark.createDataFrame([], LABELS))
    assert all(r.score < 1e-9 for r in toxicity.classify(docs, model).collect())


def test_sample_is_bounded_and_repeatable(spark):
    texts, toxic = labelled(200)
    docs = samples.documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(toxic)], LABELS)
    first, second = (toxicity.train(docs.repartition(n), labels, sample_rows=120) for n in (1, 3))
    assert np.array_equal(first.vectors, second.vectors) and first.base == second.base


def test_thresholds_cover_all_rows_not_fitted_on(spark):
    texts, toxic = labelled(900)
    langs = ["en" if i % 3 else "fr" if i % 9 else None for i in range(900)]
    docs = samples.documents(spark, texts).drop("lang").join(spark.createDataFrame(list(enumerate(langs)), "doc_id bigint, lang string"), "doc_id")
    labels = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(toxic)], LABELS)
    model = toxicity.train(docs, labels, sample_rows=250)
    assert set(model.thresholds) == {"en", "fr"}  # 50 rows of the sample held few toxic rows in fr
    drawn = [r.doc_id for r in labels.orderBy(toxicity.F.xxhash64("doc_id"), "doc_id").limit(250).select("doc_id").collect()]
    fitted = {sorted(drawn)[i] for i in toxicity._split(250, np.random.default_rng(toxicity.SEED))[0]}
    scores = model.score([t.encode() for t in texts])
    f1 = lambda own, cut: 2 * toxic[own][scores[own] >= cut].sum() / ((scores[own] >= cut).sum() + toxic[own].sum())
    for lang, cut in model.thresholds.items():
        own = np.array([i for i in range(900) if langs[i] == lang and i not in fitted])
        assert len(fitted) == 200 and f1(own, cut) >= max(f1(own, s) for s in scores[own]) - 0.01
    assert model.threshold(None) == toxicity.THRESHOLD
