"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words and their first bytes are hashed; each hash seen in enough training texts has
an embedding, all others count as zero. Filters of several widths run over the
summed embeddings, the maximum of each filter over the whole text goes into a
logistic output. Fitting uses a bounded sample of labelled rows. All labelled rows
that were not fitted on are scored for the thresholds: tasks count labels by language
and bin of the log odds, and the sums of all rows decide. Scoring reads every whole
text, batch by batch, and shuffles nothing.

Only the text goes into a score. Language chooses the threshold of the decision.
Null and empty texts have no words and get the score of an empty text. A row with
a null language, or one with too few toxic rows, uses the common threshold. Labels that are null, or without a
document, are left out; a document labelled twice counts as toxic if one label
says so. Without any usable label all scores are 0. Document rows keep their other
columns; repeated rows get equal scores.
"""

import zlib
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.llm.decontamination import words
from chunkloom.llm.scratch import cut as stored
from chunkloom.llm.tables import text_runs, with_columns

SAMPLE_ROWS = 5000
MIN_TEXTS = 3
PREFIXES = (4, 6)
DIM = 12
FILTERS = 8
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)
EPOCHS = 8
BATCH = 32
RATE = 0.01
THRESHOLD = 0.7
MIN_POSITIVES = 20
BINS = 64  # score bins for a unit of the log odds, which lie between -60 and 60
SEED = 7
BATCH_BYTES = 2 << 20


def hashes(own: list[bytes]) -> np.ndarray:
    """One row per word: the hash of the word and of each of its prefixes."""
    out = np.empty((len(own), 1 + len(PREFIXES)), dtype=np.uint32)
    out[:, 0] = np.fromiter(map(zlib.crc32, own), dtype=np.uint32, count=len(own))
    for i, n in enumerate(PREFIXES, 1):
        out[:, i] = np.fromiter(map(zlib.crc32, [w[:n] for w in own], repeat(n)), dtype=np.uint32, count=len(own))
    return out


@dataclass
class Model:
    known: np.ndarray  # sorted hashes that have an embedding; row 0 of `vectors` is for all others
    vectors: np.ndarray
    filters: list[np.ndarray]  # by width: (width, dim, filters)
    bias: np.ndarray
    out: np.ndarray
    base: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def rows(self, hashed: np.ndarray) -> np.ndarray:
        """Rows of `vectors` for hashes."""
        if not len(self.known):
            return np.zeros(hashed.shape, dtype=np.int32)
        at = np.minimum(np.searchsorted(self.known, hashed), len(self.known) - 1)
        return np.where(self.known[at] == hashed, at + 1, 0).astype(np.int32)

    def responses(self, vectors: np.ndarray) -> np.ndarray:
        """Filter values at each place; the last places of a text are padding."""
        parts = []
        for bank in self.filters:
            total = vectors @ bank[0]
            for j in range(1, len(bank)):
                total[: len(vectors) - j] += vectors[j:] @ bank[j]
            parts.append(total)
        return np.concatenate(parts, axis=1)

    def score(self, texts) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        if not len(self.known):
            return np.full(len(texts), _sigmoid(self.base))
        split = [words(t) for t in texts]
        number: dict[bytes, int] = {}
        for own in split:
            for w in own:
                if w not in number:
                    number[w] = len(number)
        # The embedding of each different word once, with a zero row at the end for padding.
        table = self.vectors[self.rows(hashes(list(number)))].sum(axis=1)
        table = np.concatenate([table, np.zeros((1, DIM), dtype=np.float32)])
        pooled = np.empty((len(texts), len(self.out)), dtype=np.float32)
        most = 1 << 16  # words at once
        for i, own in enumerate(split):
            places = np.fromiter(map(number.__getitem__, own), dtype=np.int64, count=len(own))
            places = np.concatenate([places, np.full(PAD, len(number))])
            best = np.full(len(self.out), -np.inf, dtype=np.float32)
            for at in range(0, len(own) + 1, most):
                end = min(at + most, len(own) + 1)
                part = self.responses(table[places[at : end + PAD - 1]])[: end - at]
                best = np.maximum(best, part.max(axis=0))
            pooled[i] = best
        return _sigmoid(np.maximum(pooled + self.bias, 0) @ self.out + self.base)

    def threshold(self, lang) -> float:
        return self.thresholds.get(lang, THRESHOLD)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(np.asarray(x, dtype=np.float64), -60, 60)))


def _split(n: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Rows to fit on, four fifths, and the others."""
    order = rng.permutation(n)
    cut = n - n // 5
    return order[:cut], order[cut:]


def fit(texts: list[bytes | None], labels: np.ndarray, langs: list, seed: int = SEED) -> Model:
    """Trains on four fifths of the rows and calibrates the thresholds on the others."""
    rng = np.random.default_rng(seed)
    n_out = FILTERS * len(WIDTHS)
    empty = Model(np.zeros(0, np.uint32), np.zeros((1, DIM), np.float32), [], np.zeros(n_out, np.float32), np.zeros(n_out, np.float32), -60.0)
    if not len(labels) or not labels.any():
        return empty
    train, held = _split(len(labels), rng)
    hashed = {i: hashes(words(texts[i])) for i in train}
    seen, times = np.unique(np.concatenate([np.unique(h) for h in hashed.values()]), return_counts=True)
    known = seen[times >= MIN_TEXTS]
    model = Model(
        known,
        np.concatenate([np.zeros((1, DIM)), rng.normal(0, 0.1, (len(known), DIM))]).astype(np.float32),
        [rng.normal(0, (2 / (DIM * w)) ** 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(n_out, np.float32),
        rng.normal(0, 0.3, n_out).astype(np.float32),
        float(np.log((labels[train].mean() + 1e-3) / (1.001 - labels[train].mean()))),
    )
    _train(model, {i: model.rows(h) for i, h in hashed.items()}, labels, train, rng)
    if len(held):
        model.thresholds = _thresholds(model.score([texts[i] for i in held]), labels[held], [langs[i] for i in held])
    return model


class _Adam:
    def __init__(self, shape):
        self.mean, self.square, self.step = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def move(self, grad):
        self.step += 1
        self.mean += 0.1 * (grad - self.mean)
        self.square += 0.001 * (grad * grad - self.square)
        up = self.mean / (1 - 0.9**self.step)
        return RATE * up / (np.sqrt(self.square / (1 - 0.999**self.step)) + 1e-7)


def _train(model: Model, rows: dict, labels: np.ndarray, train: np.ndarray, rng) -> None:
    moves = {"bias": _Adam(model.bias.shape), "out": _Adam(model.out.shape), "base": _Adam(())}
    banks = [_Adam(x.shape) for x in model.filters]
    squares = np.full(len(model.vectors), 1e-6, np.float32)  # one adaptive rate per embedding
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // BATCH)):
            pooled, where = [], []
            for i in part:
                own = np.concatenate([rows[i], np.zeros((PAD, rows[i].shape[1]), np.int32)])
                values = model.responses(model.vectors[own].sum(axis=1))[: len(own) - PAD + 1]
                top = values.argmax(axis=0)
                pooled.append(values[top, np.arange(len(top))])
                where.append((own, top))
            hidden = np.maximum(np.array(pooled) + model.bias, 0)
            error = ((_sigmoid(hidden @ model.out + model.base) - labels[part]) / len(part)).astype(np.float32)
            back = error[:, None] * model.out * (hidden > 0)
            grads = [np.zeros_like(x) for x in model.filters]
            touched, change = [], []
            for (own, top), g in zip(where, back):
                for b, bank in enumerate(model.filters):
                    at, gb = top[b * FILTERS : (b + 1) * FILTERS], g[b * FILTERS : (b + 1) * FILTERS]
                    for j in range(len(bank)):
                        ids = own[at + j]
                        grads[b][j] += model.vectors[ids].sum(axis=1).T * gb
                        touched.append(ids.ravel())
                        change.append(np.repeat(bank[j].T * gb[:, None], ids.shape[1], axis=0))
            ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            step = np.zeros((len(ids), DIM), np.float32)
            np.add.at(step, inverse, np.concatenate(change))
            step[ids == 0] = 0
            squares[ids] += (step * step).mean(axis=1)
            model.vectors[ids] -= 0.1 * step / np.sqrt(squares[ids])[:, None]
            for bank, move, grad in zip(model.filters, banks, grads):
                bank -= move.move(grad)
            model.bias -= moves["bias"].move(back.sum(axis=0))
            model.out -= moves["out"].move(hidden.T @ error)
            model.base -= float(moves["base"].move(error.sum()))


def _thresholds(scores: np.ndarray, labels: np.ndarray, langs: list) -> dict[str, float]:
    """By language, the threshold of the best F1; languages with few toxic rows keep the common one."""
    return _best((lang, 1, y, s, s) for s, y, lang in sorted(zip(scores, labels, langs), key=lambda x: -x[0]))


def _best(bins) -> dict[str, float]:
    """The thresholds from (lang, rows, toxic rows, smallest score, largest score), largest scores first."""
    out, of_lang = {}, {}
    for lang, *counts in bins:
        if lang is not None:
            of_lang.setdefault(lang, []).append(counts)
    for lang, own in sorted(of_lang.items()):
        n, y, low, high = (np.array(x, dtype=np.float64) for x in zip(*own))
        if y.sum() < MIN_POSITIVES:
            continue
        ends = np.flatnonzero(np.append(high[1:] != low[:-1], True))  # a cut lies between different scores
        hits = np.cumsum(y)[ends]
        best = ends[np.argmax(2 * hits / (np.cumsum(n)[ends] + y.sum()))]
        below = high[best + 1] if best + 1 < len(n) else 0.0
        out[lang] = float((low[best] + below) / 2)
    return out


def calibrate(docs: DataFrame, labelled: DataFrame, model: Model) -> dict[str, float]:
    """By language, the threshold of the best F1 over all rows of `labelled` (doc_id, toxic).

    Cuts lie between bins of the log odds. All documents are scored where they are read and
    meet the labels without their texts, so that no text is shuffled, whatever the number of
    labels. Runs a job; at most a row per language with enough toxic rows and bin comes to the driver.
    """
    rows = docs.select("doc_id", "text", "lang").filter("doc_id is not null").withColumn("hash", F.xxhash64("text"))
    scored = classify(rows, model).select("doc_id", "lang", "hash", "score").join(labelled, "doc_id")
    once = scored.groupBy("doc_id").agg(F.min_by("score", "hash").alias("score"), F.min("lang").alias("lang"), F.max("toxic").alias("toxic"))
    odds = F.log(F.col("score") / (1 - F.col("score")))
    bin_ = F.when(F.col("score") >= 1, 60 * BINS).otherwise(F.floor(F.greatest(odds, F.lit(-60.0)) * BINS))
    counted = (
        once.filter("lang is not null")
        .groupBy("lang", bin_.alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("y"), F.min("score").alias("low"), F.max("score").alias("high"))
        .withColumn("toxic", F.sum("y").over(W.partitionBy("lang")))
        .filter(F.col("toxic") >= MIN_POSITIVES)
    )
    bins = counted.select("lang", "n", "y", "low", "high").collect()
    return _best(sorted((tuple(r) for r in bins), key=lambda r: -r[3]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits a model on at most `sample_rows` labelled documents, drawn by the hash of their id.

    The thresholds come from all labelled documents that it was not fitted on. `docs`
    needs doc_id, text and lang; `labels` needs doc_id and toxic. Runs jobs.
    """
    usable = labels.filter("doc_id is not null and toxic is not null")
    labelled = stored(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labelled")
    sample = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).withColumnRenamed("toxic", "_toxic")
    # At most sample_rows pairs of numbers are broadcast.
    rows = (
        docs.select("doc_id", "text", "lang")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("lang").alias("lang"), F.max("_toxic").alias("toxic"))
        .collect()
    )
    rows.sort(key=lambda r: r.doc_id)
    texts = [None if r.text is None else r.text.encode() for r in rows]
    model = fit(texts, np.array([r.toxic for r in rows], dtype=np.float32), [r.lang for r in rows])
    if model.filters:
        fitted = [(rows[i].doc_id,) for i in _split(len(rows), np.random.default_rng(SEED))[0].tolist()]
        known = docs.sparkSession.createDataFrame(fitted, "doc_id bigint")
        model.thresholds = calibrate(docs, labelled.join(F.broadcast(known), "doc_id", "left_anti"), model)
    return model


def _score(held, lang: str | None):
    def run(batches):
        model = held.value
        for batch in batches:
            for rows, texts in text_runs(batch, "text", BATCH_BYTES):
                langs = rows.column(rows.schema.get_field_index(lang)).to_pylist() if lang else repeat(None, len(texts))
                yield with_columns(
                    rows.select([n for n in rows.schema.names if n not in ("score", "threshold")]),
                    score=pa.array(model.score(texts), pa.float64()),
                    threshold=pa.array([model.threshold(x) for x in langs], pa.float64()),
                )

    return run


def classify(docs: DataFrame, model: Model, lang: str | None = "lang") -> DataFrame:
    """Document rows with score and the threshold of their language; both replace columns of these names."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "threshold")
    fields = [*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("threshold", T.DoubleType())]
    return kept.mapInArrow(_score(held, lang), T.StructType(fields))
