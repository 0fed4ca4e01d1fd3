"""Search for many phrases at once, in time that hardly depends on their number.

Texts are searched as UTF-8 bytes, in which a text holds a phrase where its bytes hold the
phrase's. Each phrase is found by one window of KEY bytes, the one that fewest phrases share;
phrases shorter than that are windows themselves. All windows of a batch of texts are looked
up in a bit table, and only where it answers are phrases compared.

Phrases that are too many for that leave nothing but bits in the tasks: `Marks` tells which
windows of a text may be phrases, by hashes of windows of all lengths that phrases have.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sent along with each job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = 8
#: Texts are searched in blocks of about this many bytes.
BLOCK = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def _number(window: bytes) -> int:
    return int.from_bytes(window, "little")


def _blocks(texts: pa.Array):
    """Texts as bytes, null as empty, in lists of about BLOCK bytes."""
    raw = texts.cast(pa.binary()).fill_null(b"")
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(raw):
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + BLOCK, side="right")) - 1)
        yield raw.slice(start, end - start).to_pylist()
        start = end


class Phrases:
    """Phrases with the windows by which they are found; empty ones occur in no text."""

    def __init__(self, phrases):
        raw = sorted({p.encode() for p in phrases if p})
        short: dict[int, list[int]] = {}
        for p in raw:
            if len(p) < KEY:
                short.setdefault(len(p), []).append(_number(p))
        self.short = {n: np.array(sorted(found), dtype=np.uint64) for n, found in short.items()}
        # Arrays throughout: a table of Python objects for the windows would take a hundred times the phrases.
        raw = [p for p in raw if len(p) >= KEY]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.data, self.ends = b"".join(raw), np.cumsum(sizes)
        self.keys, self.owner, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if raw:
            counts = sizes - KEY + 1
            starts = np.cumsum(counts) - counts
            windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(self.data, np.uint8), KEY)
            places = np.arange(counts.sum()) + np.repeat(self.ends - sizes - starts, counts)
            windows = np.ascontiguousarray(windows[places]).view("<u8").ravel()
            _, number, shared = np.unique(windows, return_inverse=True, return_counts=True)
            # The rarest window of each phrase, the first of equally rare ones; a phrase's own repetitions count, too.
            rank = shared[number] * (counts.max() + 1) + np.arange(len(windows)) - np.repeat(starts, counts)
            at = np.minimum.reduceat(rank, starts) % (counts.max() + 1)
            keys = windows[starts + at]
            order = np.argsort(keys, kind="stable")
            self.keys, self.owner, self.at = keys[order], order, at[order]
        self.marks = np.zeros(1 << _BITS if len(self.keys) else 0, dtype=bool)
        if len(self.keys):
            self.marks[self._places(self.keys)] = True

    @staticmethod
    def _places(windows: np.ndarray) -> np.ndarray:
        return (windows * _SPREAD >> np.uint64(64 - _BITS)).astype(np.int64)

    def _short_hits(self, windows: np.ndarray, ends: np.ndarray, row: np.ndarray, hit: np.ndarray) -> None:
        for n, known in self.short.items():
            own = windows & np.uint64((1 << 8 * n) - 1)
            at = np.searchsorted(known, own)
            found = known[np.minimum(at, len(known) - 1)] == own
            places = np.flatnonzero(found)
            rows = row[places]
            hit[rows[places + n <= ends[rows]]] = True

    def _long_hits(self, data: bytes, windows: np.ndarray, starts, ends, row, hit: np.ndarray) -> None:
        places = np.flatnonzero(self.marks[self._places(windows)])
        own = windows[places]
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        places = places[self.keys[at] == own]
        first, last = (np.searchsorted(self.keys, windows[places], side) for side in ("left", "right"))
        for place, r, i, end in zip(places.tolist(), row[places].tolist(), first.tolist(), last.tolist()):
            while i < end and not hit[r]:
                start, own = place - self.at[i], self.owner[i]
                phrase = self.data[self.ends[own - 1] if own else 0 : self.ends[own]]
                hit[r] = start >= starts[r] and start + len(phrase) <= ends[r] and data.startswith(phrase, start)
                i += 1

    def _block(self, texts: list[bytes]) -> np.ndarray:
        hit = np.zeros(len(texts), dtype=bool)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        data = b"".join(texts) + bytes(KEY)
        n = int(ends[-1]) if len(texts) else 0
        if not n:
            return hit
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), KEY)[:n]).view("<u8").ravel()
        row = np.repeat(np.arange(len(texts)), sizes)
        self._short_hits(windows, ends, row, hit)
        if len(self.keys):
            self._long_hits(data, windows, ends - sizes, ends, row, hit)
        return hit

    def found_in(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold a phrase; null holds none."""
        out = [self._block(block) for block in _blocks(texts)]
        return np.concatenate(out) if out else np.zeros(0, dtype=bool)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


_LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64), 1)
_BASE = 0xD1342543DE82EF95


class _Windows:
    """Hashes of the windows of a block of texts, by sums over its bytes times powers that wrap around."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.data = b"".join(texts)
        n = len(self.data)
        powers = np.ones(n + 1, np.uint64)
        self.inverse = np.ones(n + 1, np.uint64)
        powers[1:] = np.cumprod(np.full(n, _BASE, np.uint64))
        self.inverse[1:] = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[np.frombuffer(self.data, np.uint8)] * powers[:n], out=self.sums[1:])
        self.row = np.repeat(np.arange(len(texts)), sizes)

    def hashes(self, at: np.ndarray, size, salt: int) -> np.ndarray:
        return _mixed((self.sums[at + size] - self.sums[at]) * self.inverse[at], salt)


@dataclass
class Marks:
    """Bits that are set for all phrases of two layers, and for their first KEY bytes; some others are set by chance."""

    bits: int
    lengths: dict[bool, list[int]]
    table: np.ndarray | None = None

    def _both(self, hashes: np.ndarray) -> list[np.ndarray]:
        return [(h >> np.uint64(64 - self.bits)).astype(np.int64) for h in (hashes, hashes * _SPREAD)]

    def _marked(self, hashes: np.ndarray) -> np.ndarray:
        one, two = ((self.table[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool) for p in self._both(hashes))
        return one & two

    @staticmethod
    def _salt(layer: bool, size: int) -> int:
        return 2 * size + layer

    def places(self, phrases: pa.Array, layer: bool) -> pa.Array:
        """The numbers of the bits of each phrase, from 1 on."""
        out = []
        for block in _blocks(phrases):
            w = _Windows(block)
            sizes = w.ends - w.starts
            own, found = [], []
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                for part, salt in [(size, int(size)), (KEY, 0)] if size >= KEY else [(size, int(size))]:
                    for places in self._both(w.hashes(w.starts[rows], part, self._salt(layer, salt))):
                        own.append(rows)
                        found.append(places + 1)
            own, found = np.concatenate(own), np.concatenate(found)
            order = np.argsort(own, kind="stable")
            ends = np.searchsorted(own[order], np.arange(len(block) + 1))
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[order], pa.int64())))
        return pa.chunked_array(out, pa.list_(pa.int64())).combine_chunks()

    def windows(self, texts: list[bytes], layer: bool, most: int | None):
        """(rows, windows): the windows of texts that are marked as phrases are, the first `most` of each text."""
        w = _Windows(texts)
        if not w.data:
            return np.zeros(0, np.int64), []
        every = np.arange(len(w.data))
        likely = every[every + KEY <= w.ends[w.row]]
        likely = likely[self._marked(w.hashes(likely, KEY, self._salt(layer, 0)))]
        at, size = [], []
        for length in self.lengths[layer]:
            places = every if length < KEY else likely
            places = places[places + length <= w.ends[w.row[places]]]
            places = places[self._marked(w.hashes(places, length, self._salt(layer, length)))]
            at.append(places)
            size.append(np.full(len(places), length))
        if not at:
            return np.zeros(0, np.int64), []
        at, size = np.concatenate(at), np.concatenate(size)
        order = np.argsort(at, kind="stable")
        at, size = at[order], size[order]
        rows = w.row[at]
        if most is not None:
            kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < most
            at, size, rows = at[kept], size[kept], rows[kept]
        return rows, [w.data[i : i + n] for i, n in zip(at.tolist(), size.tolist())]


def mark(layers: DataFrame, bits: int) -> Marks:
    """The marks of a table (raw, phrase); at most two to the power of `bits` bits reach the driver. Runs jobs."""
    found = layers.groupBy("raw").agg(F.collect_set(F.octet_length("phrase")).alias("lengths")).collect()
    marks = Marks(bits, {False: [], True: []} | {r.raw: sorted(r.lengths) for r in found})

    @F.arrow_udf("array<bigint>")
    def places(raw: pa.Array, phrases: pa.Array) -> pa.Array:
        both = [marks.places(phrases.filter(own), layer) for layer, own in ((False, pc.invert(raw)), (True, raw))]
        order = np.argsort(raw.to_numpy(zero_copy_only=False), kind="stable")
        return pa.chunked_array(both, pa.list_(pa.int64())).combine_chunks().take(pa.array(np.argsort(order, kind="stable")))

    place = layers.select(F.explode(places("raw", F.col("phrase").cast("binary"))).alias("place"))
    numbered = place.select(F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("bit"))
    slices = numbered.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    marks.table = np.zeros(max(1 << bits, 1 << 15) >> 3, np.uint8)
    for bucket, held in zip(slices["bucket"].to_pylist(), slices["bits"]):
        start = (bucket - 1) << 12
        marks.table[start : start + 4096] = np.frombuffer(held.as_buffer(), np.uint8)
    return marks


def marked_windows(texts: DataFrame, marks: Marks, most: int | None) -> DataFrame:
    """(id, raw, phrase): windows of texts (id, written, bare) that may be phrases, at most so many of a text and layer."""
    held = texts.sparkSession.sparkContext.broadcast(marks)

    def search(batches):
        for batch in batches:
            for layer, name in ((True, "written"), (False, "bare")):
                start = 0
                for block in _blocks(batch.column(name)):
                    rows, found = held.value.windows(block, layer, most)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(rows + start)), pa.array([layer] * len(rows), pa.bool_()), pa.array(found, pa.binary())],
                        names=["id", "raw", "phrase"],
                    )
                    start += len(block)

    return texts.select("id", "written", "bare").mapInArrow(search, "id bigint, raw boolean, phrase binary")


def holds_any(spark, first: tuple[Column, list[str]], second: tuple[Column, list[str]]) -> Column:
    """True where a text of either layer (text, phrases) holds one of its phrases. The phrases are sent to all tasks."""
    held = spark.sparkContext.broadcast([Phrases(phrases) for _, phrases in (first, second)])

    @F.arrow_udf("boolean")
    def search(one: pa.Array, other: pa.Array) -> pa.Array:
        return pa.array(held.value[0].found_in(one) | held.value[1].found_in(other))

    return search(first[0], second[0])
