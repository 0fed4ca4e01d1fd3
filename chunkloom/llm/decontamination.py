"""Benchmark decontamination with positional inverted indexes.

The index is distributed by documents: each task notes, for about 4 MB of the documents
it reads at a time, the positions of every word that occurs in test items. A test window
starts from the posting list of the word that is rarest in these documents; its other
words are then compared with the words at their offsets in the texts, rarer ones first.
What is left are exact phrase matches. For proximity, all words of a window only have
to occur, in any order, in a stretch of a given number of words.

Postings stay with their documents and are dropped after them, so no list of a frequent
word meets in one task, and nothing is shuffled. Test items come in blocks of bounded
size, one stage after another; all blocks are held at once, so the benchmark as a whole
has to fit into memory.

Words are runs of digits, letters after lower-casing A-Z, and characters beyond
ASCII. Null and empty texts have no words and no matches; items without words have
no windows. Matches do not cross documents. Rows of an item id that repeats count
as one item; a null item id marks words but is not counted as an item. Document
rows keep their other columns, also repeated rows. An empty table of either kind
gives no matches.
"""

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.llm.tables import blocks_for, text_runs, with_columns

WINDOW = 10
ITEM_BLOCK_BYTES = 16 << 20
BATCH_BYTES = 4 << 20

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if i in _KEEP else 32 for i in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Windows:
    """The windows of a block of items, as rows of word numbers by window length."""

    def __init__(self, items, window: int):
        self.ids: dict[bytes, int] = {}
        rows: dict[int, list] = {}
        for item, text in items:
            numbers = [self.ids.setdefault(w, len(self.ids)) for w in words(text)]
            size = min(window, len(numbers))
            for at in range(len(numbers) - size + 1 if size else 0):
                rows.setdefault(size, []).append((item, numbers[at : at + size]))
        self.by_size = {
            size: (np.array([r[1] for r in found], dtype=np.int32), [r[0] for r in found])
            for size, found in sorted(rows.items())
        }


class Postings:
    """Positional inverted index over the words of some documents, laid end to end with a gap between two."""

    def __init__(self, texts, ids: dict[bytes, int]):
        parts, self.lengths = [], []
        for text in texts:
            own = words(text)
            self.lengths.append(len(own))
            parts.append(np.fromiter(map(ids.get, own, repeat(-1)), dtype=np.int32, count=len(own)))
            parts.append(np.full(1, -1, dtype=np.int32))
        self.terms = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        self.starts = np.concatenate([[0], np.cumsum(np.array(self.lengths, dtype=np.int64) + 1)])
        known = np.flatnonzero(self.terms >= 0)
        self.places = known[np.argsort(self.terms[known], kind="stable")]
        self.counts = np.bincount(self.terms[known], minlength=len(ids))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def of_rarest(self, windows: np.ndarray):
        """For each place of the rarest word of each window: window, column of that word, place."""
        counts = self.counts[windows]
        live = np.flatnonzero(counts.min(axis=1) > 0)
        column = counts[live].argmin(axis=1)
        term = windows[live, column]
        n = self.counts[term]
        ends = np.cumsum(n)
        inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        return np.repeat(live, n), np.repeat(column, n), self.places[np.repeat(self.first[term], n) + inner]

    def phrases(self, windows: np.ndarray):
        """Exact occurrences: (window, start)."""
        window, column, place = self.of_rarest(windows)
        start = place - column
        inside = (start >= 0) & (start + windows.shape[1] <= len(self.terms))
        window, start = window[inside], start[inside]
        by_rarity = np.argsort(self.counts[windows], axis=1, kind="stable")
        for step in range(1, windows.shape[1]):
            offset = by_rarity[window, step]
            same = self.terms[start + offset] == windows[window, offset]
            window, start = window[same], start[same]
        return window, start

    def near(self, windows: np.ndarray, within: int):
        """Windows whose words all occur in a stretch of `within` words of one text: (window, a place in it)."""
        window, _, place = self.of_rarest(windows)
        width = len(self.terms) + 1
        keys = self.terms[self.places].astype(np.int64) * width + self.places
        document = np.searchsorted(self.starts, np.arange(len(self.terms)), side="right")
        # Each other word has to be close enough to the rarest one on either side.
        for step in range(windows.shape[1]):
            term = windows[window, step].astype(np.int64)
            after = np.searchsorted(keys, term * width + place)
            close = np.zeros(len(place), dtype=bool)
            for at in (after, after - 1):
                other = self.places[np.clip(at, 0, max(len(keys) - 1, 0))]
                close |= (
                    (at >= 0) & (at < len(keys)) & (self.terms[other] == term)
                    & (np.abs(other - place) < within) & (document[other] == document[place])
                )
            window, place = window[close], place[close]
        whole = np.array([self._together(set(windows[w].tolist()), p, within) for w, p in zip(window, place)], dtype=bool)
        return window[whole], place[whole]

    def _together(self, terms: set[int], place: int, within: int) -> bool:
        """Whether one stretch around a place holds all the words."""
        owner = np.searchsorted(self.starts, place, side="right") - 1
        low, high = max(self.starts[owner], place - within + 1), min(self.starts[owner] + self.lengths[owner], place + within)
        around = self.terms[low:high].tolist()
        return any(terms <= set(around[a : a + within]) for a in range(max(1, len(around) - within + 1)))


def _spans(mask: np.ndarray):
    """Runs of true values as (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _search(block, window: int, within: int | None, text: str, last: pa.Schema):
    def run(batches):
        windows = Windows(block.value, window)
        for batch in batches:
            for rows, texts in text_runs(batch, text, BATCH_BYTES):
                index = Postings(texts, windows.ids)
                owner = lambda places: np.searchsorted(index.starts, places, side="right") - 1
                change = np.zeros(len(index.terms) + 1, dtype=np.int32)
                exact: list[set] = [set() for _ in texts]
                near: list[set] = [set() for _ in texts]
                for size, (table, items) in windows.by_size.items():
                    found, start = index.phrases(table)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + size, -1)
                    for d, w in zip(owner(start), found):
                        exact[d].add(items[w])
                    if within is not None:
                        found, place = index.near(table, within)
                        for d, w in zip(owner(place), found):
                            near[d].add(items[w])
                held = rows.to_pydict() if "hits" in rows.schema.names else {}
                hit = np.cumsum(change[:-1]) > 0
                hits, exacts, nears = [], [], []
                for d, (at, n) in enumerate(zip(index.starts, index.lengths)):
                    own = hit[at : at + n]
                    for x in held["hits"][d] if held else ():
                        own[x["start"] : x["end"]] = True
                    hits.append([{"start": int(a), "end": int(b)} for a, b in zip(*_spans(own))])
                    for out, new, name in ((exacts, exact[d], "items"), (nears, near[d], "near_items")):
                        out.append(sorted((new | set(held[name][d] if held else ())) - {None}))
                own = {"n_words": index.lengths, "hits": hits, "items": exacts, "near_items": nears}
                kept = rows.select([n for n in rows.schema.names if n not in own])
                yield with_columns(kept, **{k: pa.array(v, last.field(k).type) for k, v in own.items()})

    return run


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_OWN = pa.schema([("n_words", pa.int64()), ("hits", _SPAN), ("items", pa.list_(pa.int64())), ("near_items", pa.list_(pa.int64()))])
_TYPES = {
    "n_words": "bigint",
    "hits": "array<struct<start:bigint,end:bigint>>",
    "items": "array<bigint>",
    "near_items": "array<bigint>",
}


def find(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    within: int | None = None,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """Document rows with n_words, hits (spans of word numbers), items and near_items (ids found).

    The four columns replace columns of the same names. near_items stays empty without `within`.
    Runs a job that sizes the item blocks and one that reads each of them.
    """
    spark = docs.sparkSession
    tests = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text")).filter("text is not null")
    n_blocks = blocks_for(tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0, block_bytes)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    out = docs.drop(*_TYPES)
    fields = [*out.schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in _TYPES.items())]
    for n in range(n_blocks):
        rows = tests.filter(block == n).toLocalIterator()
        held = spark.sparkContext.broadcast([(r.id, r.text.encode()) for r in rows])
        out = out.mapInArrow(_search(held, window, within, text, _OWN), T.StructType(fields))
    return out
