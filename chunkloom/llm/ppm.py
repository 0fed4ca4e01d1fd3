"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts of up to ORDER bytes with the counts of the bytes
that follow, learned from all training texts. A byte that a context has not seen is
escaped to the next shorter context: the escape weighs as many counts as the context
has different followers, and followers that a longer context has excluded are no
longer counted in the shorter ones. Below the empty context, all bytes left are
equally likely.

What is modelled is the normalised text: its words in lower case (A-Z), one space
between two, and an end. A text's score is the log10 of its probability. Beside it
stands a base score, from the counts of whole words with one added.

Counts are combined inside tasks, then summed by key. The code length of every n-gram
that occurs is worked out once, by parts of the trie that share a context of three
bytes. Documents then look their n-grams and words up. Below BROADCAST_ROWS these
tables go to every task; beyond, documents go to blocks, and each block gets the rows
that it needs. `adaptive` instead learns within each text only.

Null and empty texts have only the end. Repeated rows and ties need no care: they give
equal scores. Without training texts every byte is equally likely. An empty table gives
no rows. Other columns stay; the result columns replace columns of their names.
"""

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.llm.scratch import cut
from chunkloom.llm.tables import blocks_for, own_names, text_runs

ORDER = 5
LOW = 2  # contexts up to this length are few enough for every task: at most 256 ** 3 n-grams
BATCH_BYTES = 4 << 20
HELD_KEYS = 1 << 21  # keys that a task combines before it hands them on
PART_ROWS = 400_000
BROADCAST_ROWS = 8_000_000
BLOCK_BYTES = 16 << 20
TEXT_BITS = 16  # an n-gram of ORDER + 1 bytes leaves so many bits for the number of its text
WORD = np.uint64(1 << 62)  # keys of words lie above those of n-grams
END = b"\n"

_SPACES = bytes(i + 32 if 65 <= i <= 90 else 32 if 9 <= i <= 13 else i for i in range(256))
RESULTS = {"n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_SPACES).split() if text else []


class Run:
    """Some texts: their n-grams by text, and their words."""

    def __init__(self, texts):
        import xxhash

        split = [words(t) for t in texts]
        raw = [b" ".join(own) + END for own in split]
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        # Each text follows ORDER zero bytes, so that no context reaches into the text before.
        flat = np.frombuffer(b"".join(bytes(ORDER) + r for r in raw), np.uint8).astype(np.uint64)
        ends = np.cumsum(self.sizes + ORDER)
        inside = np.ones(len(flat), bool)
        for j in range(ORDER):
            inside[ends - self.sizes - ORDER + j] = False
        # Pairs of neighbouring bytes, three of which make an n-gram.
        pairs = flat.copy()
        pairs[1:] |= flat[:-1] << np.uint64(8)
        grams = pairs.copy()
        for j in range(2, ORDER + 1, 2):
            grams[j:] |= pairs[:-j] << np.uint64(8 * j)
        self.grams = grams[inside]
        for own in split:
            own.append(END)
        self.lengths = np.fromiter(map(len, split), np.int64, len(split))
        all_words = list(chain.from_iterable(split))
        number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.words = np.fromiter(map(number.__getitem__, all_words), np.int64, len(all_words))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
        self.word_keys = (hashes & (WORD - np.uint64(1))) | WORD

    def counts(self, train: np.ndarray):
        """Distinct keys, and how often each occurs in training texts."""
        # The lowest bit tells whether the text is one to learn from.
        marked, n = np.unique(self.grams << np.uint64(1) | np.repeat(train, self.sizes).astype(np.uint64), return_counts=True)
        n *= (marked & np.uint64(1)).astype(np.int64)
        keys, first = _distinct(marked >> np.uint64(1))
        n = np.add.reduceat(n, first) if len(first) else n
        m = np.bincount(self.words, np.repeat(train, self.lengths), len(self.word_keys))
        return np.concatenate([keys, self.word_keys]), np.concatenate([n, m]).astype(np.int64)

    def scores(self, costs, known, total: int, distinct: int) -> dict:
        """costs and known: (sorted keys, values) of n-grams and words."""
        c = _look(*known, self.word_keys)[self.words]
        first = np.cumsum(self.lengths) - self.lengths
        base = np.log10((c + 1) / (total + distinct + 1))
        some = len(self.sizes) > 0
        return {
            "n_tokens": self.lengths,
            "n_known": np.add.reduceat((c > 0).astype(np.int64), first) if some else first,
            "train_tokens": np.full(len(self.sizes), total),
            "base_score": np.add.reduceat(base, first) if some else np.zeros(0),
            "score": self._sums(costs),
        }

    def _sums(self, costs) -> np.ndarray:
        """The costs of each text's n-grams, added up in the order of the n-grams."""
        out, ends, most = [np.zeros(0)], np.cumsum([0, *self.sizes]), 1 << TEXT_BITS
        for start in range(0, len(self.sizes), most):
            sizes = self.sizes[start : start + most]
            text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
            both = np.sort(self.grams[ends[start] : ends[start + len(sizes)]] << np.uint64(TEXT_BITS) | text)
            keys, first = _distinct(both >> np.uint64(TEXT_BITS))
            each = np.repeat(_look(*costs, keys), np.diff(first, append=len(both)))
            out.append(np.bincount((both & np.uint64(most - 1)).astype(np.int64), each, len(sizes)))
        return np.concatenate(out)


def _distinct(keys: np.ndarray):
    """Of sorted keys: the distinct ones, and where each begins."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], first


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _combine(parts):
    keys = np.concatenate([k for k, _ in parts])
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(distinct)).astype(np.int64)


def _count(batches):
    held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    out = lambda keys, n: pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["key", "n"])
    for batch in batches:
        for rows, texts in text_runs(batch, "text", BATCH_BYTES):
            train = rows.column(rows.schema.get_field_index("train")).to_numpy(zero_copy_only=False).astype(bool)
            held.append(Run(texts).counts(train))
            if sum(len(k) for k, _ in held) > 2 * HELD_KEYS:
                held = [_combine(held)]
                if len(held[0][0]) > HELD_KEYS:
                    yield out(*held.pop())
                    held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    yield out(*_combine(held))


class Level:
    """The contexts of one length: n-grams (context and follower) with counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, inverse = np.unique(keys, return_inverse=True)
        self.n = np.bincount(inverse, n, len(self.keys))
        self.contexts, first, self.followers = np.unique(self.keys >> np.uint64(8), return_index=True, return_counts=True)
        self.total = np.add.reduceat(self.n, first) if len(first) else np.zeros(0)
        self.first = first

    def excluded(self, shorter: "Level", length: int):
        """By context: the counts that its followers have in the context one byte shorter."""
        if not len(self.first):
            return np.zeros(0)
        return np.add.reduceat(_look(shorter.keys, shorter.n, self.keys & _mask(length)), self.first)


def _mask(length: int):
    return np.uint64((1 << 8 * (length + 1)) - 1)


def costs(grams: np.ndarray, n: np.ndarray, low_keys: np.ndarray, low_n: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each n-gram.

    grams hold all n-grams of their contexts of LOW + 1 bytes; low_* all n-grams of LOW + 1 bytes.
    """
    seen = n > 0
    levels = [Level(low_keys & _mask(j), low_n) for j in range(LOW + 1)]
    levels += [Level(grams[seen] & _mask(j), n[seen]) for j in range(LOW + 1, ORDER + 1)]
    out, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
    gone_n, gone_followers = np.zeros(len(grams)), np.zeros(len(grams))
    for j in range(ORDER, -1, -1):
        level = levels[j]
        context = (grams & _mask(j)) >> np.uint64(8)
        total = _look(level.contexts, level.total, context) - gone_n
        followers = _look(level.contexts, level.followers, context) - gone_followers
        own = _look(level.keys, level.n, grams & _mask(j))
        weight = total + followers
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = open_ & (own > 0)
            out[hit] += np.log10(own[hit] / weight[hit])
            open_ &= ~hit
            missed = open_ & (weight > 0)
            out[missed] += np.log10(followers[missed] / weight[missed])
        if j:
            gone_n = _look(level.contexts, level.excluded(levels[j - 1], j - 1), context)
            gone_followers = _look(level.contexts, level.followers, context)
    left = 256 - len(levels[0].keys)
    if left > 0:
        out[open_] -= np.log10(left)
    return out


def _cost_rows(low):
    def run(table: pa.Table) -> pa.Table:
        keys, n = low.value
        grams = table["key"].to_numpy().astype(np.uint64)
        return pa.table([table["key"], costs(grams, table["n"].to_numpy(), keys, n)], names=["key", "cost"])

    return run


def _sorted(df: DataFrame, value: str):
    table = df.select("key", value).toArrow()
    keys = table["key"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return keys[order], table[value].to_numpy()[order]


def fit(docs: DataFrame, train: Column, text: str = "text"):
    """Tables of n-gram costs (key, cost) and word counts (key, n), both stored, and the numbers of words: all and distinct."""
    rows = docs.select(F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counts = cut(rows.mapInArrow(_count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "ppm-counts")
    grams, known = counts.filter(F.col("key") < int(WORD)), counts.filter((F.col("key") >= int(WORD)) & (F.col("n") > 0))
    low = grams.filter("n > 0").groupBy(F.col("key").bitwiseAND(F.lit(int(_mask(LOW)))).alias("key")).agg(F.sum("n").alias("n"))
    # At most 256 ** (LOW + 1) rows, whatever the input.
    held = docs.sparkSession.sparkContext.broadcast(_sorted(low, "n"))
    sums = counts.agg(F.count_if(F.col("key") < int(WORD)).alias("grams"), F.sum(F.when(F.col("key") >= int(WORD), F.col("n"))).alias("n"), F.count_if((F.col("key") >= int(WORD)) & (F.col("n") > 0)).alias("v")).first()
    part = F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))), F.lit(max(16, blocks_for(sums.grams, PART_ROWS))))
    cost = cut(grams.groupBy(part.alias("part")).applyInArrow(_cost_rows(held), "key bigint, cost double"), "ppm-costs")
    return cost, known, sums.n or 0, sums.v


def _with_scores(rows, run: Run, tables) -> pa.RecordBatch:
    own = run.scores(*tables)
    kept = [n for n in rows.schema.names if n not in ("_block", "_text", *RESULTS)]
    arrays = [rows.column(n) for n in kept] + [pa.array(own[n], pa.int64() if t == "bigint" else pa.float64()) for n, t in RESULTS.items()]
    return arrays, [*kept, *RESULTS]


def _score(tables):
    def run(batches):
        for batch in batches:
            for rows, texts in text_runs(batch, "_text", BATCH_BYTES):
                arrays, names = _with_scores(rows, Run(texts), tables.value)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _needed(table: pa.Table) -> pa.Table:
    block = table["_block"][0].as_py()
    keys = [np.zeros(0, np.uint64)]
    for batch in table.to_batches():
        for _, texts in text_runs(batch, "_text", BATCH_BYTES):
            run = Run(texts)
            keys = [np.unique(np.concatenate([*keys, run.grams, run.word_keys]))]
    return pa.table([np.full(len(keys[0]), block), keys[0].astype(np.int64)], names=["_block", "key"])


def _score_block(total: int, distinct: int, schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        keys = right["key"].to_numpy().astype(np.uint64)
        order = np.argsort(keys)
        keys, values = keys[order], right["value"].to_numpy()[order]
        grams = keys < WORD
        tables = (keys[grams], values[grams]), (keys[~grams], values[~grams]), total, distinct
        parts = []
        for batch in left.to_batches():
            for rows, texts in text_runs(batch, "_text", BATCH_BYTES):
                arrays, names = _with_scores(rows, Run(texts), tables)
                parts.append(pa.table(arrays, names=names))
        return pa.concat_tables(parts)

    return run


@own_names("text")
def score(docs: DataFrame, model, text: str = "text", broadcast_rows: int = BROADCAST_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Document rows with n_tokens, n_known, train_tokens, base_score and score."""
    cost, known, total, distinct = model
    kept = docs.drop(*RESULTS)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in RESULTS.items())])
    rows = kept.withColumn("_text", F.col(text))
    if distinct + cost.count() <= broadcast_rows:
        held = docs.sparkSession.sparkContext.broadcast((_sorted(cost, "cost"), _sorted(known, "n"), total, distinct))
        return rows.mapInArrow(_score(held), schema)
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_text", *kept.columns), F.lit(blocks_for(size, block_bytes))))
    needed = rows.groupBy("_block").applyInArrow(_needed, "_block bigint, key bigint")
    values = cost.select("key", F.col("cost").alias("value")).union(known.select("key", F.col("n").cast("double")))
    found = needed.join(values, "key").select(F.col("_block").alias("to_block"), "key", "value")
    shape = _arrow(schema)
    return rows.groupBy("_block").cogroup(found.groupBy("to_block")).applyInArrow(_score_block(total, distinct, shape), schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class Trie:
    """A trie that learns while it predicts, for one text at a time."""

    def __init__(self):
        self.seen: list[dict[bytes, dict[int, int]]] = [{} for _ in range(ORDER + 1)]

    def cost(self, context: bytes, symbol: int) -> float:
        """log10 probability of a byte after a context."""
        out, gone = 0.0, set()
        for j in range(min(ORDER, len(context)), -1, -1):
            followers = {s: n for s, n in self.seen[j].get(context[len(context) - j :], {}).items() if s not in gone}
            weight = sum(followers.values()) + len(followers)
            if symbol in followers:
                return out + np.log10(followers[symbol] / weight)
            if followers:
                out += np.log10(len(followers) / weight)
                gone |= followers.keys()
        return out - np.log10(256 - len(gone))

    def learn(self, context: bytes, symbol: int):
        for j in range(min(ORDER, len(context)) + 1):
            followers = self.seen[j].setdefault(context[len(context) - j :], {})
            followers[symbol] = followers.get(symbol, 0) + 1

    def text(self, text: bytes | None, learn: bool = True) -> float:
        total, context = 0.0, bytes(ORDER)
        for symbol in b" ".join(words(text)) + END:
            total += self.cost(context, symbol)
            if learn:
                self.learn(context, symbol)
            context = context[1:] + bytes([symbol])
        return total


def _adaptive(batches):
    for batch in batches:
        for rows, texts in text_runs(batch, "_text", BATCH_BYTES):
            kept = [n for n in rows.schema.names if n not in ("_text", "score")]
            own = pa.array([Trie().text(t) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), own], names=[*kept, "score"])


@own_names("text")
def adaptive(docs: DataFrame, text: str = "text") -> DataFrame:
    """Document rows with score: the code length of a trie that starts empty for each text. Byte by byte, so slow."""
    kept = docs.drop("score")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    return kept.withColumn("_text", F.col(text)).mapInArrow(_adaptive, schema)
