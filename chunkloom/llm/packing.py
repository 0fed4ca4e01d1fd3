"""Packing of token streams by order-preserving dynamic programming.

The documents of a scan task, in the order in which they are read, are one stream of
token ids, each document ended by END. The stream is cut into consecutive windows of at
most `size` ids. Cuts may lie at the end of a document (free), at the end of a sentence
(Costs.sentence) or, where neither comes for STEP ids, inside a sentence (Costs.inside). A
window pays a unit for each id that it lacks to `size`; a window whose length is a power
of two, SHORTEST at least, is not padded and pays none. With f the least cost of a prefix,

    f(j) = cut(j) + size - p(j) + min { f(i) + p(i) : p(j) - size <= p(i) < p(j) }

so that a monotone queue over f(i) + p(i) gives each minimum in constant time; powers of two
are looked up. The stream is solved in stretches of STRETCH ids, which end a window each:
at most one window in a thousand is cut short by that.

No text leaves its task and nothing is shuffled. A task that is run again makes the same
pieces, as its rows come from the same file range; write the result of a shuffle to a table
before packing it. Sequences are numbered by task and place in it.

Null and empty texts consist of END alone. Repeated rows and null ids are documents of
their own. A very long text is encoded in parts that end before a space and a word, which
changes no id; its ids take four bytes each. An empty table gives no pieces. Only the id and
the text column are read, so other columns may have any names.
"""

import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chunkloom.llm.tables import text_runs

END = 0
STRETCH = 1 << 20
STEP = 16
SHORTEST = 64
BATCH_BYTES = 1 << 22
PART_CHARS = 1 << 18
BLANK_RUN = 2000
#: Sequence numbers of a task start at its number times this.
PER_TASK = 1 << 40

# Before a space that follows a word and precedes one, all earlier matches of the pattern are complete.
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_BLANKS = re.compile(r"\s{%d}" % BLANK_RUN)
_SENTENCE_END = tuple(x.encode() for x in ".!?…。！？")
_CLOSING = b"\"')]\xbb"


class Costs(NamedTuple):
    """What a cut costs, in units of one padded id."""

    sentence: float = 2.0
    inside: float = 8.0


class Vocabulary(NamedTuple):
    """The content of a tokenizer file, and its tokens as bytes by rank."""

    content: str
    ranks: dict[bytes, int]


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones are themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level tokenizer file, read on the driver. Its merges must be in the order of their tokens' ids."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    model = json.loads(content)["model"]
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    first = len(model["vocab"]) - len(merges)
    ids = [model["vocab"][m] for m in merges]
    if ids != sorted(ids):
        raise ValueError(f"merges are not in the order of their ids: {path}")
    symbols = byte_of_symbol()
    last = max(ids, default=first)
    return Vocabulary(content, {bytes(symbols[c] for c in t): i for t, i in model["vocab"].items() if i <= last})


class Encoder:
    """Ids of texts as the tokenizers library gives them; special tokens in a text are ordinary text."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import tiktoken

        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})
        self.content, self.slow = vocabulary.content, None
        tokens = [b""] * (max(vocabulary.ranks.values()) + 1)
        for token, i in vocabulary.ranks.items():
            tokens[i] = token
        self.ends = np.array([t.rstrip(_CLOSING).endswith(_SENTENCE_END) or t.endswith(b"\n") for t in tokens])
        self.breaks = np.array([t.endswith((b"\n", *_SENTENCE_END[4:])) for t in tokens])
        self.opens = np.array([t[:1].isspace() for t in tokens])

    def _part(self, text: str) -> np.ndarray:
        if len(text) > BLANK_RUN and _BLANKS.search(text):  # the other library's pattern recurses over white space
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.content)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def ids(self, text: str) -> np.ndarray:
        """Ids of one text, ended by END."""
        out, start = [], 0
        while len(text) - start > PART_CHARS:
            cut = _SAFE.search(text, start + PART_CHARS)
            if cut is None:
                break
            out.append(self._part(text[start : cut.start()]))
            start = cut.start()
        out.append(self._part(text[start:] if start else text))
        return np.concatenate([*out, np.array([END], dtype=np.uint32)])

    def sentence_cuts(self, stream: np.ndarray) -> np.ndarray:
        """Places in the stream, from 1, before which a sentence ends."""
        before, after = stream[:-1], stream[1:]
        return np.flatnonzero(self.ends[before] & (self.breaks[before] | self.opens[after])) + 1


def cut_points(n: int, documents: np.ndarray, sentences: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places from 0 to n where a window may end, STEP apart at most, and the cost of each."""
    # Next to the end of a document, the end of its last sentence would cut off END alone.
    marks = np.union1d(np.setdiff1d(sentences, documents - 1), np.concatenate([[0], documents, [n]]))
    marks = marks[(marks >= 0) & (marks <= n)]
    extra = (np.diff(marks) - 1) // STEP
    total = int(extra.sum())
    nth = np.arange(total) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    inside = np.repeat(marks[:-1], extra) + STEP * nth
    places = np.concatenate([marks, inside])
    price = np.concatenate([np.full(len(marks), costs.sentence), np.full(total, costs.inside)])
    price[: len(marks)][np.isin(marks, documents)] = 0.0
    order = np.argsort(places, kind="stable")
    price = price[order]
    price[0] = price[-1] = 0.0
    return places[order], price


def windows(places: np.ndarray, price: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of least total cost between the first place and the last."""
    powers = [1 << k for k in range(size.bit_length()) if SHORTEST <= 1 << k < size]
    if powers:
        found = [np.searchsorted(places, places - power) for power in powers]
        rows = [(np.flatnonzero((places >= p) & (places[at] == places - p)), at) for p, at in zip(powers, found)]
        exact_j = np.concatenate([j for j, _ in rows])
        exact_i = np.concatenate([at[j] for j, at in rows])
        order = np.argsort(exact_j, kind="stable")
        exact = list(zip(exact_j[order].tolist(), exact_i[order].tolist()))
    else:
        exact = []
    exact.append((len(places), 0))
    at, cost = places.tolist(), price.tolist()
    least, before = [0.0] * len(at), [0] * len(at)
    key = [0.0] * len(at)  # least cost plus place: what the queue compares
    key[0] = at[0]
    queue, head, nxt = [0], 0, 0
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[head]] < p - size:
            head += 1
        i = queue[head]
        best = key[i] + size - p
        while exact[nxt][0] == j:
            if least[exact[nxt][1]] < best:
                i = exact[nxt][1]
                best = least[i]
            nxt += 1
        least[j], before[j] = best + cost[j], i
        k = key[j] = least[j] + p
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    path, j = [], len(at) - 1
    while j > 0:
        j = before[j]
        path.append(j)
    return places[np.array(path[::-1], dtype=np.int64)]


def _stretches(places: np.ndarray, most: int):
    """Cut points in runs that span about `most` ids; neighbours share a place."""
    start = 0
    while start < len(places) - 1:
        end = max(int(np.searchsorted(places, places[start] + most, side="right")) - 1, start + 1)
        yield start, end + 1
        start = end


def pieces(encoder: Encoder, encoded: list[np.ndarray], size: int, costs: Costs, stretch: int = STRETCH):
    """Columns of the pieces of some documents: document, start, length, window, offset, and the stream of ids."""
    stream = np.concatenate(encoded)
    ends = np.cumsum([len(x) for x in encoded])
    starts = ends - [len(x) for x in encoded]
    places, price = cut_points(len(stream), ends, encoder.sentence_cuts(stream), costs)
    opened = np.concatenate([windows(places[a:b], price[a:b], size) for a, b in _stretches(places, stretch)])
    first = np.union1d(opened, starts)
    length = np.diff(first, append=len(stream))
    doc = np.searchsorted(starts, first, side="right") - 1
    window = np.searchsorted(opened, first, side="right") - 1
    return doc, first - starts[doc], length, window, first - opened[window], stream, first


_ENCODERS: dict = {}


def _encoder(held) -> Encoder:
    """One encoder per worker, kept for its later tasks; it does not grow."""
    vocabulary, pattern = held.value
    key = (pattern, hash(vocabulary.content))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, pattern)
    return _ENCODERS[key]


RESULT = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    vocabulary: Vocabulary,
    pattern: str,
    size: int = 1024,
    costs: Costs = Costs(),
    id_column: str = "doc_id",
    text: str = "text",
    stretch: int = STRETCH,
) -> DataFrame:
    """Pieces in sequences of at most `size` ids: RESULT, with ids as little-endian 32-bit numbers.

    `start` counts the ids of the document before the piece, `offset` those of its sequence.
    """
    rows = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    held = rows.sparkSession.sparkContext.broadcast((vocabulary, pattern))
    binary = pa.binary()

    def solved(encoder, ids, encoded, number):
        doc, start, length, window, offset, stream, first = pieces(encoder, encoded, size, costs, stretch)
        total = np.array([len(x) for x in encoded])
        values = pa.Array.from_buffers(
            binary, len(first), [None, pa.py_buffer(np.append(first, len(stream)).astype("<i4") * np.int32(4)), pa.py_buffer(stream.astype("<u4"))]
        ) if len(stream) < 1 << 29 else pa.array([stream[a : a + n].astype("<u4").tobytes() for a, n in zip(first, length)], binary)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()).take(pa.array(doc)), pa.array(start), pa.array(length), values, pa.array(total[doc]), pa.array(number + window), pa.array(offset)],
            names=[f.split()[0] for f in RESULT.split(", ")],
        )
        return batch, number + int(window[-1]) + 1

    def run(batches):
        encoder, number = _encoder(held), TaskContext.get().partitionId() * PER_TASK
        ids, encoded, waiting = [], [], 0
        for batch in batches:
            for part, texts in text_runs(batch, "text", BATCH_BYTES):
                for i, content in zip(part.column(0).to_pylist(), texts):
                    own = encoder.ids(content.decode() if content else "")
                    ids.append(i)
                    encoded.append(own)
                    waiting += len(own)
                    if waiting >= stretch:
                        done, number = solved(encoder, ids, encoded, number)
                        yield done
                        ids, encoded, waiting = [], [], 0
        if encoded:
            yield solved(encoder, ids, encoded, number)[0]

    return rows.mapInArrow(run, RESULT)
