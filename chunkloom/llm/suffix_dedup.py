"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

Every byte covered by a string of LENGTH bytes that also starts earlier (in a smaller
document, or earlier in the same one) is removed.

A string of LENGTH bytes belongs to the smallest hash of its inner k-grams, its anchor,
so equal strings have equal anchors. The strings of neighbouring starts share an anchor
place; the bytes that they cover are a context. Contexts whose anchors occur once cannot
repeat anything, and of equal contexts all but the earliest are covered whole. That
leaves contexts that differ, with a common part long enough to matter: around the ends
of copied passages. They are dealt to buckets by anchor.

In a bucket, shards of the contexts get a suffix array and a Burrows-Wheeler transform
each. The transforms are merged by refining their interleave: rows go to the bucket of
their two preceding bytes, in order, until the order holds for LENGTH bytes. The round in
which a boundary appears tells the common prefix there; intervals without a boundary at
the end are the repeated strings. No suffix is sorted again for the merge.

Anchors with very many different contexts are taken apart into single strings, which
Spark groups by hash with a partial aggregation; no task meets them all.

Matches do not cross documents. Null and short texts keep all bytes. A null id counts
as the smallest. Rows that repeat an id and a text are one document and get equal
results. Columns but the text stay; result columns replace columns of their names. An empty
table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.llm.scratch import cut
from chunkloom.llm.tables import blocks_for, own_names, runs, text_runs

LENGTH = 100
GRAM = 36
STARTS = LENGTH - GRAM + 1  # k-grams of a string
HALF = 32  # a string holds this many bytes left or right of its anchor
BATCH_BYTES = 2 << 20
HASHED_BYTES = 1 << 16  # of short texts at once, so that their hashes stay in the processor's cache
HELD_ANCHORS = 1 << 20
HOT = 4096
BUCKET_CONTEXTS = 6000
SHARDS = 2

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256).astype(np.uint64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring strings from theirs."""
    h = a * _A + b * _B + _C
    h ^= h >> np.uint64(31)
    h *= _C
    h ^= h >> np.uint64(29)
    return h


def _slide(values: np.ndarray, width: int, choose) -> np.ndarray:
    """Minimum or maximum over each `width` neighbours."""
    have, out = 1, values
    while 2 * have <= width:
        out = choose(out[:-have], out[have:])
        have *= 2
    more = width - have
    return choose(out[:-more], out[more:]) if more else out


class Hashes:
    """Hashes of strings in a byte array: of all strings of HALF and GRAM bytes, and of longer ones where asked for."""

    def __init__(self, data: np.ndarray):
        h = _BYTE[data]
        for n in (1, 2, 4, 8, 16):
            if n == 4:
                four = h
            h = _pair(h[:-n], h[n:])
        self.halves = h
        size = max(0, len(data) - GRAM + 1)
        self.grams = _pair(h[:size], four[HALF : HALF + size])

    def wide(self, at: np.ndarray) -> np.ndarray:
        """Of GRAM + HALF bytes."""
        return _pair(self.grams[at], self.halves[at + GRAM])

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Of LENGTH bytes."""
        return _pair(_pair(self.halves[at], self.halves[at + HALF]), self.grams[at + 2 * HALF])

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of spans of LENGTH bytes or more, at most 2 LENGTH, with their sizes."""
        h = _pair(self.strings(first), self.strings(last - LENGTH))
        return _pair(h, (last - first).astype(np.uint64))


def anchors_of(texts: list[bytes]):
    """The anchors of texts of LENGTH bytes or more: number of the text, gram hash, context hash, left and right hash, place, first and last start."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    hashes = Hashes(data)
    grams = hashes.grams
    inside = np.ones(len(data) - LENGTH + 1, bool)
    inside[(ends[:-1, None] - np.arange(1, LENGTH)).ravel()] = False  # strings that reach into the next text
    starts = np.flatnonzero(inside)
    least = np.where(inside, _slide(grams, STARTS, np.minimum), np.uint64(0))  # by start
    # The place of the leftmost minimum of each start: the first k-gram from there on that equals it.
    edge = np.zeros(STARTS - 1, np.uint64)
    is_chosen = _slide(np.concatenate([edge, least, edge]), STARTS, np.maximum) == grams
    chosen, least = np.flatnonzero(is_chosen), least[starts]
    nth = (np.cumsum(is_chosen) - is_chosen)[starts]
    place = chosen[nth]
    # Between a start and its minimum there may be chosen places of other starts.
    wrong = np.flatnonzero(grams[place] != least)
    while len(wrong):
        nth[wrong] += 1
        place[wrong] = chosen[nth[wrong]]
        wrong = wrong[grams[place[wrong]] != least[wrong]]
    here = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    first, last = starts[here], starts[np.append(here[1:], len(starts)) - 1]
    at = place[here]
    left, right = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    has = at - first >= HALF
    left[has] = hashes.wide(at[has] - HALF)
    has = last + LENGTH >= at + GRAM + HALF
    right[has] = hashes.wide(at[has])
    context = _pair(hashes.spans(first, last + LENGTH), (at - first).astype(np.uint64))
    text = np.searchsorted(ends, at, side="right")
    origin = np.append(0, ends)[text]
    return text, grams[at], context, left, right, at - origin, first - origin, last - origin


def anchors(text: bytes):
    """The anchors of one text, without its number."""
    return anchors_of([text])[1:]


_ROW = "gram bigint, context bigint, lft int, rgt int, doc bigint, tx int, place int, first int, last int, covered boolean"


class _Rows:
    """Columns of anchor rows."""

    names = ["gram", "context", "lft", "rgt", "doc", "tx", "place", "first", "last"]

    def __init__(self):
        self.parts = []
        self.count = 0

    def add(self, docs, txs, found):
        """Anchors of some texts, with the keys of these texts."""
        text, gram, context, left, right, at, first, last = found
        fold = lambda h: np.where(h == 0, 0, (h >> np.uint64(33)).astype(np.int32) | 1).astype(np.int32)
        self.parts.append((gram.view(np.int64), context.view(np.int64), fold(left), fold(right), docs[text], txs[text], at.astype(np.int32), first.astype(np.int32), last.astype(np.int32)))
        self.count += len(gram)

    def flush(self):
        """Rows of a task so far; of equal contexts only the earliest is not covered."""
        if not self.parts:
            return
        columns = dict(zip(self.names, map(np.concatenate, zip(*self.parts))))
        self.__init__()
        keys = ("place", "tx", "doc", "context", "gram")
        order = np.lexsort([columns[n] for n in keys])
        columns = {n: v[order] for n, v in columns.items()}
        same = [np.append(False, columns[n][1:] == columns[n][:-1]) for n in keys]
        once = ~np.logical_and.reduce(same)  # rows may repeat an id and a text
        covered = (same[3] & same[4])[once]
        columns = {n: v[once] for n, v in columns.items()}
        order = np.lexsort([columns[n] for n in ("place", "tx", "doc")])
        columns, covered = {n: v[order] for n, v in columns.items()}, covered[order]
        # Neighbouring covered anchors of a text become one row, dealt by place and not by what they hold.
        columns["gram"][covered] = _pair(columns["doc"][covered].view(np.uint64), columns["place"][covered].astype(np.uint64)).view(np.int64)
        keep = np.ones(len(order), bool)
        both = covered[1:] & covered[:-1] & (columns["doc"][1:] == columns["doc"][:-1]) & (columns["tx"][1:] == columns["tx"][:-1]) & (columns["first"][1:] == columns["last"][:-1] + 1)
        keep[1:] = ~both
        heads = np.flatnonzero(keep)
        columns["last"] = columns["last"][np.append(heads[1:], len(order)) - 1]
        out = [pa.array(columns[n] if n == "last" else columns[n][heads]) for n in self.names]
        yield pa.RecordBatch.from_arrays([*out, pa.array(covered[heads])], names=[*self.names, "covered"])


def _find(batches):
    rows = _Rows()
    for batch in batches:
        for part, texts in text_runs(batch, "text", BATCH_BYTES):
            docs, txs = (part.column(part.schema.get_field_index(n)).to_numpy() for n in ("doc", "tx"))
            long = [i for i, text in enumerate(texts) if text is not None and len(text) >= LENGTH]
            for start, end in runs([len(texts[i]) for i in long], HASHED_BYTES):
                some = long[start:end]
                rows.add(docs[some], txs[some], anchors_of([texts[i] for i in some]))
                if rows.count >= HELD_ANCHORS:
                    yield from rows.flush()
    yield from rows.flush()


def _fetch(batches):
    """Bytes of contexts, and of hot contexts the hashes of all strings."""
    names = ["gram", "doc", "tx", "first", "last", "bytes"]
    for batch in batches:
        for part, texts in text_runs(batch, "text", BATCH_BYTES):
            rows = part.to_pydict()
            out = []
            for doc, tx, text, wanted in zip(rows["doc"], rows["tx"], texts, rows["wanted"]):
                strings = Hashes(np.frombuffer(text, np.uint8)).strings(np.arange(len(text) - LENGTH + 1)) if any(x["hot"] for x in wanted) else None
                for x in wanted:
                    if x["hot"]:
                        out += [(int(strings[s].view(np.int64)), doc, tx, s, s, None) for s in range(x["first"], x["last"] + 1)]
                    else:
                        out.append((x["gram"], doc, tx, x["first"], x["last"], text[x["first"] : x["last"] + LENGTH]))
            if out:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names=names)


class Transform:
    """Suffix array and Burrows-Wheeler transform of some strings, each with ends of its own.

    With a `step` of 2, a row's preceding symbol is the pair of bytes before it; strings then
    get two or three ends, so that pairs start at even places of all.
    """

    DIGITS, BITS = 7, 9

    def __init__(self, strings: list[bytes], step: int = 1):
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        tails = np.ones(len(strings), np.int64) if step == 1 else 2 + sizes % 2
        symbols = np.zeros(int((sizes + tails).sum()), np.uint64)
        self.start = np.cumsum(sizes + tails) - sizes - tails
        self.string = np.repeat(np.arange(len(strings)), sizes + tails)
        self.step, self.ends = step, int(tails.sum())
        offset = np.arange(len(symbols)) - self.start[self.string]
        size = sizes[self.string]
        symbols[offset < size] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint64) + np.uint64(1)
        # Ranks of growing prefixes; nothing is read beyond the first end of a string.
        key, alive = np.zeros(len(symbols), np.uint64), np.ones(len(symbols), bool)
        padded = np.concatenate([symbols, np.zeros(self.DIGITS, np.uint64)])
        for j in range(self.DIGITS):
            part = padded[j : j + len(symbols)]
            key = (key << np.uint64(self.BITS)) | np.where(alive, part, np.uint64(0))
            alive &= part != 0
        rank = np.unique(key, return_inverse=True)[1]
        depth, longest = self.DIGITS, int(sizes.max(initial=0)) + 1
        while depth < longest:
            other = np.minimum(np.arange(len(symbols)) + depth, len(symbols) - 1)
            beyond = np.where(size - offset >= depth, rank[other] + 1, 0)
            rank = np.unique(rank * (len(symbols) + 1) + beyond, return_inverse=True)[1]
            depth *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        # 0 where an end comes before; else the bytes before, as one number.
        value = np.zeros(len(symbols), np.int64)
        for j in range(step):
            value = value << self.BITS | symbols[np.maximum(np.arange(len(symbols)) - step + j, 0)].astype(np.int64)
        value = np.where((offset < step) | (offset - step >= size), 0, value + 1)
        self.before = value[self.suffixes]

    def places(self):
        """String and offset of each row."""
        string = self.string[self.suffixes]
        return string, self.suffixes - self.start[string]


def merge(shards: list[Transform], depth: int, prefixes: bool = True):
    """Interleaves the rows of transforms of one step.

    Returns the shard of each row, whether it differs from the row before within `depth`
    bytes, and with `prefixes` how many they have in common at least (less than a step
    more, and at most `depth`).
    """
    step = shards[0].step
    symbols = np.unique(np.concatenate([s.before for s in shards]))
    # The symbols that occur, numbered in few bytes: counting sorts then take one or two passes.
    code = next((c for c in (np.uint8, np.uint16) if len(symbols) <= np.iinfo(c).max), np.uint32)
    columns = [np.searchsorted(symbols, s.before).astype(code) for s in shards]
    # Pairs of a byte and an end: no two of these are equal, either. Later rounds know from the blocks.
    closing = (symbols > 0) & ((symbols - 1) % (1 << Transform.BITS) == 0) & (step > 1)
    turn = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.before) for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=np.uint8), [s.ends for s in shards])
    block = np.zeros(len(turn), np.int32)
    common = np.full(len(turn), depth, np.uint8) if prefixes else None
    before = np.empty(len(turn), code)
    new = np.ones(len(turn), bool)
    for h in range(0, depth, step):
        for z, column in enumerate(columns):
            before[turn == z] = column
        order = np.argsort(before, kind="stable")
        # Ends stay in front, shard by shard; no two are equal.
        turn = turn[order]
        turn[: len(ends)] = ends
        by_before, by_block = before[order], block[order]
        np.not_equal(by_block[1:], by_block[:-1], out=new[1:])
        new[1:] |= by_before[1:] != by_before[:-1]
        new[: len(ends)] = True
        if h == 0:
            new |= closing[by_before]
        if prefixes:
            np.minimum(common, np.uint8(h), out=common, where=new)
        np.cumsum(new, dtype=np.int32, out=block)
    return turn, new, common


def repeated(strings: list[bytes], depth: int = LENGTH, shards: int = SHARDS):
    """Suffixes that share `depth` bytes with another: (interval, string, offset)."""
    n = max(1, min(shards, len(strings)))
    bounds = [len(strings) * i // n for i in range(n + 1)]
    parts = [Transform(strings[a:b], 1 + (depth % 2 == 0)) for a, b in zip(bounds, bounds[1:])]
    turn, new, _ = merge(parts, depth, prefixes=False)
    string, offset = np.empty(len(turn), np.int64), np.empty(len(turn), np.int64)
    for z, (part, first) in enumerate(zip(parts, bounds)):
        own = turn == z
        string[own], offset[own] = part.places()
        string[own] += first
    interval = np.cumsum(new)
    sizes = np.bincount(interval)
    several = sizes[interval] > 1
    return interval[several], string[several], offset[several]


def _bucket(table: pa.Table) -> pa.Table:
    schema = pa.schema([("doc", pa.int64()), ("tx", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
    doc, tx, first = (table[n].to_numpy() for n in ("doc", "tx", "first"))
    order = np.lexsort([first, tx, doc])
    # Rows that repeat an id and a text come several times.
    same = [np.append(False, x[order][1:] == x[order][:-1]) for x in (doc, tx, first)]
    order = order[~np.logical_and.reduce(same)]
    texts = table["bytes"].to_pylist()
    interval, string, offset = repeated([texts[i] for i in order])
    row = order[string]
    start = first[row] + offset
    by = np.lexsort([start, tx[row], doc[row], interval])
    interval, row, start = interval[by], row[by], start[by]
    if not len(by):
        return schema.empty_table()
    same = np.concatenate([[False], interval[1:] == interval[:-1]])
    row, start = row[same], start[same]
    by = np.lexsort([start, tx[row], doc[row]])
    row, start = row[by], start[by]
    d, t = doc[row], tx[row]
    head = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (start[1:] > start[:-1] + 1)])[: len(row)]
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], len(row)) - 1 if len(heads) else heads
    return pa.table([d[heads], t[heads], start[heads].astype(np.int32), start[tails].astype(np.int32)], schema=schema)


def covered_starts(docs: DataFrame) -> DataFrame:
    """Runs of starts (doc, tx, first, last) whose strings also start earlier. docs: doc, tx, text. Runs jobs."""
    rows = docs.mapInArrow(_find, _ROW)
    times = F.sum((~F.col("covered")).cast("int")).over(W.partitionBy("gram"))
    several = rows.repartition("gram").withColumn("times", times).filter("covered or times > 1").drop("times")
    nth = F.dense_rank().over(W.partitionBy("gram", "context").orderBy("doc", "tx", "place"))
    several = several.withColumn("nth", F.when(F.col("covered"), F.lit(2)).otherwise(nth))
    # Whether another context shares the bytes left or right of the anchor; equal contexts were counted already.
    fits = lambda side: (F.col(side) != 0) & (F.sum((F.col("nth") == 1).cast("int")).over(W.partitionBy("gram", side)) > 1)
    several = cut(several.withColumns({"on_left": fits("lft"), "on_right": fits("rgt")}), "anchors")
    again = several.filter("nth > 1").select("doc", "tx", "first", "last")
    open_contexts = several.filter("nth = 1 and (on_left or on_right)")
    counts = cut(open_contexts.groupBy("gram").agg(F.count("*").alias("contexts")), "anchor-counts")
    wanted = open_contexts.join(counts.filter(F.col("contexts") > 1), "gram")
    # Strings that start HALF or more bytes before the anchor hold its left side, others its right side.
    first = F.when(F.col("on_left"), F.col("first")).otherwise(F.greatest("first", F.col("place") - HALF + 1))
    last = F.when(F.col("on_right"), F.col("last")).otherwise(F.least("last", F.col("place") - HALF))
    wanted = wanted.withColumns({"first": first, "last": last}).filter("first <= last")
    wanted = wanted.groupBy("doc", "tx").agg(F.collect_set(F.struct("gram", "first", "last", (F.col("contexts") > HOT).alias("hot"))).alias("wanted"))
    fetched = cut(docs.join(cut(wanted, "wanted"), ["doc", "tx"]).mapInArrow(_fetch, "gram bigint, doc bigint, tx int, first int, last int, bytes binary"), "contexts")
    bucket = F.pmod(F.xxhash64("gram"), F.lit(blocks_for(fetched.filter("bytes is not null").count(), BUCKET_CONTEXTS)))
    by_merge = fetched.filter("bytes is not null").groupBy(bucket.alias("bucket")).applyInArrow(_bucket, "doc bigint, tx int, first int, last int")
    single = fetched.filter("bytes is null").select("gram", "doc", "tx", "first")
    lowest = cut(single.groupBy("gram").agg(F.min(F.struct("doc", "tx", "first")).alias("least")), "earliest")
    later = single.join(lowest, "gram").filter(F.struct("doc", "tx", "first") > F.col("least"))
    by_hash = later.select("doc", "tx", "first", F.col("first").alias("last"))
    return again.union(by_merge).union(by_hash)


_OWN = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "removed": T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("n", T.IntegerType())])), "kept": T.BinaryType()}


def _remove(shape, text_column: str):
    def run(batches):
        for batch in batches:
            for part, texts in text_runs(batch, text_column, BATCH_BYTES):
                runs = part.column(part.schema.get_field_index("_runs")).to_pylist()
                n_bytes, n_removed, removed, kept = [], [], [], []
                for text, own in zip(texts, runs):
                    text = text or b""
                    spans = []
                    for x in sorted((x["first"], x["last"] + LENGTH) for x in own or ()):
                        if spans and x[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], x[1])
                        else:
                            spans.append(list(x))
                    cuts = [0, *(p for s in spans for p in s), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                    n_bytes.append(len(text))
                    n_removed.append(len(text) - len(kept[-1]))
                    removed.append([{"first": a, "n": b - a} for a, b in spans])
                names = [n for n in part.schema.names if n not in (text_column, "_runs")]
                own = [pa.array(v, shape.field(n).type) for n, v in (("n_bytes", n_bytes), ("n_removed", n_removed), ("removed", removed), ("kept", kept))]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *own], names=[*names, *_OWN])

    return run


@own_names("id_column", "text")
def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Document rows with n_bytes, n_removed, removed (maximal runs: first, n) and kept (the bytes left), without the text. Runs jobs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = docs.drop(*_OWN)
    low = F.lit(-(2**63)).cast("bigint")
    keys = {"doc": F.coalesce(F.col(id_column).cast("bigint"), low), "tx": F.hash(F.col(text))}
    runs = covered_starts(docs.select(*[c.alias(n) for n, c in keys.items()], F.col(text).alias("text")))
    of_doc = runs.groupBy("doc", "tx").agg(F.collect_list(F.struct("first", "last")).alias("_runs"))
    of_doc = cut(of_doc.select(F.col("doc").alias("_doc"), F.col("tx").alias("_tx"), "_runs"), "runs")
    rows = rest.withColumns({"_doc": keys["doc"], "_tx": keys["tx"]}).join(of_doc, ["_doc", "_tx"], "left").drop("_doc", "_tx")
    shape = T.StructType([T.StructField(n, t) for n, t in _OWN.items()])
    return rows.mapInArrow(_remove(to_arrow_schema(shape), text), T.StructType([*rest.drop(text).schema.fields, *shape.fields]))
