"""Byte-level BPE encoding and decoding by recursive queries.

Each task holds the rank table in a small DuckDB database of its own. The words
(matches of the pattern) of a run of texts become token-position rows, one per
byte. A recursive query joins neighbours with the merge table and contracts, in every word
at once, the leftmost pair of minimum rank, until no pair of any word has a rank. Decoding joins ids with the vocabulary and puts the pieces together in
an ordered aggregation. Different words are encoded once and kept in a table of the
worker, bounded in words and bytes; when it is full, those that came at least twice stay, frequent
ones first. The database goes when its task ends. Texts never leave their task, so nothing is shuffled.

A word that is a token itself is that token, as the ranks' own library has it. The
recursive query reads a word again for each merge; a word beyond LONG_WORD bytes is
merged with a heap by the same rule instead, in proportion to its length.

Null counts as the empty text, which has no ids and decodes to no bytes. An id that
is not in the vocabulary, or null, decodes to nothing. Rows keep their other columns
(ids and decoded replace columns of these names), also repeated rows.
"""

import base64
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.llm.tables import runs, text_runs, with_columns

BATCH_BYTES = 1 << 20
LONG_WORD = 256
# A recursion keeps all its steps: a word of n bytes takes up to n * n cells. So many at once, whatever the words.
CELLS_AT_ONCE = 1 << 23
LEAST_CELLS = 1 << 10
KEPT_WORDS = 200_000
KEPT_BYTES = 8 << 20
DATABASE = {"threads": 1, "memory_limit": "400MB", "temp_directory": ""}

MERGE = """
with recursive state(step, word, ids) as (
  select 0, word, ids from words
  union all
  select s.step + 1, s.word, s.ids[:best & 4294967295] || [(best >> 32)::int] || s.ids[(best & 4294967295) + 3:]
  from state s join (
    select word, min(rank::bigint << 32 | pos) as best
    from (select word, unnest(ids) as tok, unnest(ids[2:]) as following, unnest(range(0, len(ids) - 1)) as pos from state)
    join merges on tok = lft and following = rgt
    group by word) b on s.word = b.word
)
select word, unnest(ids) as id
from (select word, ids from state join (select word, max(step) as step from state group by word) using (word, step) order by word)
"""

# A character below 256 stands for each byte, since the pieces need not be UTF-8.
JOIN = """
select doc, array_to_string(list(piece order by pos), '') as text from tokens join vocabulary using (id) group by doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Leftmost minimum-rank merges with a heap."""
    piece = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    heap = []

    def offer(i):
        if i >= 0 and after[i] < len(piece):
            joined = piece[i] + piece[after[i]]
            if joined in ranks:
                heapq.heappush(heap, (ranks[joined], i, joined))

    for i in range(len(piece)):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        if piece[i] is None or after[i] >= len(piece) or piece[i] + piece[after[i]] != joined:
            continue
        gone = after[i]
        piece[i], piece[gone], after[i] = joined, None, after[gone]
        if after[i] < len(piece):
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[x] for x in piece if x is not None]


class Coder:
    """Encodes and decodes in one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern).findall
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        columns = np.array(pairs, dtype=np.int32).reshape(-1, 3).T
        self.tables = {
            "merges": pa.table(dict(zip(("lft", "rgt", "rank"), columns))),
            "vocabulary": pa.table({"id": np.array(list(ranks.values()), np.int32), "piece": [t.decode("latin-1") for t in ranks]}),
        }
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.number: dict[str, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.seen, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._database = None

    @property
    def database(self):
        if self._database is None:
            import duckdb

            self._database = duckdb.connect(config=DATABASE)
            for name, rows in self.tables.items():
                self._database.register("given", rows)
                self._database.execute(f"create table {name} as select * from given")
                self._database.unregister("given")
        return self._database

    def rest(self):
        """Frees what only a running task needs; the worker may go on to work of another kind."""
        if self._database is not None:
            self._database.close()
            self._database = None
        self._forget()
        pa.default_memory_pool().release_unused()

    def _forget(self):
        """Keeps words that came at least twice, frequent ones first, up to half of the bounds."""
        order = np.argsort(-self.seen, kind="stable")
        order = order[self.seen[order] > 1][: KEPT_WORDS // 2]
        order = order[np.cumsum(self.sizes[order]) <= KEPT_BYTES // 2]
        names = list(self.number)
        self.number = {names[i]: n for n, i in enumerate(order.tolist())}
        first = (np.cumsum(self.lengths) - self.lengths)[order]
        self.ids = self.ids[_places(first, self.lengths[order])]
        self.lengths, self.sizes, self.seen = self.lengths[order], self.sizes[order], self.seen[order] // 2

    def _learn(self, new: list[str]):
        """Encodes words and keeps their ids."""
        raw = {w: w.encode() for w in new}
        own = {w: [self.ranks[x]] if x in self.ranks else merge_long(x, self.ranks) for w, x in raw.items() if x in self.ranks or len(x) > LONG_WORD}
        open_words = [w for w in new if w not in own]
        ids = [self.ids, np.fromiter(chain.from_iterable(own.values()), np.int32)]
        lengths = [self.lengths, np.fromiter(map(len, own.values()), np.int64)]
        for start, end in runs([max(LEAST_CELLS, len(raw[w]) ** 2) for w in open_words], CELLS_AT_ONCE):
            flat, own_lengths = self._merged([raw[w] for w in open_words[start:end]])
            ids.append(flat)
            lengths.append(own_lengths)
        order = [*own, *open_words]
        self.number.update(zip(order, range(len(self.number), len(self.number) + len(order))))
        self.ids, self.lengths = np.concatenate(ids), np.concatenate(lengths)
        self.sizes = np.concatenate([self.sizes, np.fromiter((len(raw[w]) for w in order), np.int64, len(order))])
        self.seen = np.concatenate([self.seen, np.zeros(len(order), np.int64)])

    def _merged(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each word has."""
        ends = np.cumsum([0, *map(len, raw)])
        tok = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tok))
        self.database.register("words", pa.table({"word": np.arange(len(raw), dtype=np.int32), "ids": lists}))
        found = self.database.execute(MERGE).fetchnumpy()
        self.database.unregister("words")
        return np.asarray(found["id"], np.int32), np.bincount(found["word"], minlength=len(raw))

    def merged(self, raw: list[bytes]) -> list[list[int]]:
        flat, lengths = self._merged(raw)
        return [x.tolist() for x in np.split(flat, np.cumsum(lengths)[:-1])]

    def encode(self, texts: list[bytes | None]):
        """Ids of all texts end to end, and where each text ends."""
        if len(self.number) > KEPT_WORDS or self.sizes.sum() > KEPT_BYTES:
            self._forget()
        split = [self.split(t.decode()) if t else [] for t in texts]
        words = list(chain.from_iterable(split))
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.seen += np.bincount(numbers, minlength=len(self.seen))
        sizes = self.lengths[numbers]
        first = (np.cumsum(self.lengths) - self.lengths)[numbers]
        flat = self.ids[_places(first, sizes)]
        per_text = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        return flat, np.concatenate([[0], np.cumsum(sizes)])[per_text]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        sizes = np.diff(ends, prepend=0)
        doc = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)
        pos = np.arange(len(ids), dtype=np.int32)
        self.database.register("tokens", pa.table({"doc": doc, "pos": pos, "id": ids}))
        out = [b""] * len(ends)
        for i, text in self.database.execute(JOIN).fetchall():
            out[i] = text.encode("latin-1")
        return out


def _places(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `first`, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


_CODERS: dict = {}


def _coder(held) -> Coder:
    """One coder per worker; its frequent words serve later tasks."""
    ranks, pattern = held.value
    key = (pattern, len(ranks), hash(tuple(ranks.items())))
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(ranks, pattern)
    return _CODERS[key]


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32()))


def _encode(held, text: str, back: bool):
    def run(batches):
        coder = _coder(held)
        try:
            for batch in batches:
                for rows, texts in text_runs(batch, text, BATCH_BYTES):
                    flat, ends = coder.encode(texts)
                    own = {"ids": _lists(flat, ends)}
                    if back:
                        own["decoded"] = pa.array(coder.decode(flat, ends), pa.binary())
                    yield with_columns(rows.select([n for n in rows.schema.names if n not in own]), **own)
        finally:
            coder.rest()

    return run


def _decode(held, ids: str):
    def run(batches):
        coder = _coder(held)
        try:
            for batch in batches:
                for row in range(0, len(batch), 256):
                    rows = batch.slice(row, 256)
                    lists = rows.column(rows.schema.get_field_index(ids))
                    flat, ends = lists.flatten(), np.cumsum([len(x) if x is not None else 0 for x in lists.to_pylist()])
                    decoded = coder.decode(flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32), ends)
                    yield with_columns(rows.select([n for n in rows.schema.names if n != "decoded"]), decoded=pa.array(decoded, pa.binary()))
        finally:
            coder.rest()

    return run


def _broadcast(spark: SparkSession, ranks: dict[bytes, int], pattern: str):
    """The vocabulary goes to all tasks: its file fits into the driver's memory, and does not grow with the data."""
    return spark.sparkContext.broadcast((ranks, pattern))


def _with(docs: DataFrame, **types: T.DataType) -> tuple[DataFrame, T.StructType]:
    kept = docs.drop(*types)
    return kept, T.StructType([*kept.schema.fields, *(T.StructField(n, t) for n, t in types.items())])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Rows with the column ids, array<int>."""
    kept, schema = _with(docs, ids=T.ArrayType(T.IntegerType()))
    return kept.mapInArrow(_encode(_broadcast(docs.sparkSession, ranks, pattern), text, False), schema)


def decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, ids: str = "ids") -> DataFrame:
    """Rows with the column decoded, binary."""
    kept, schema = _with(docs, decoded=T.BinaryType())
    return kept.mapInArrow(_decode(_broadcast(docs.sparkSession, ranks, pattern), ids), schema)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Rows with ids and with decoded, made from the ids; one Python worker does both."""
    kept, schema = _with(docs, ids=T.ArrayType(T.IntegerType()), decoded=T.BinaryType())
    return kept.mapInArrow(_encode(_broadcast(docs.sparkSession, ranks, pattern), text, True), schema)


def digests(coded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 in place of ids and decoded, and of columns of these names."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        *[c for c in coded.columns if c not in ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")],
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
