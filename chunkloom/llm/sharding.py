"""Sharding by sampled splitters, in DataFrame operations only.

Each record has a key: the hash of its text, then the hash of its id, so that equal
texts stand together and a hot text still has many keys. A sample of keys, drawn
with a chance in proportion to record size, gives quantile boundaries. Records are
range-partitioned by these, and a range that turns out overfull is subdivided by a
second hash. Sizes of ranges, added up in range order, place every record on one
line from 0 to the total; the shards cut this line in equal lengths.

Records over a share of a shard's size would make cuts uneven. There can only be so
many of them (their number times their least size is at most the total), so they
are dealt first, the largest to the emptiest shard, and the line of the other
records is cut where it fills the shards up.

Law: `bytes`; shard sizes differ by less than the largest record that went on the
line, unless a record alone is larger than a shard.

A null text has no bytes and no checksum, an empty text no bytes and checksum 0.
Null ids and repeated rows take part like other rows. An empty table gives no rows.
More shards than records leave shards empty.
"""

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm.scratch import cut

OVERHEAD = 16
SAMPLES_PER_RANGE = 8
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 1 << 20
LARGE = 32  # a record is large from this part of a shard's mean size on


def size_of(text: str, overhead: int = OVERHEAD) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("bigint")


def key_of(text: str, id_column: str) -> Column:
    """40 bits of the text's hash, then 23 of the id's."""
    first = F.shiftrightunsigned(F.xxhash64(text), 24).bitwiseAND(F.lit((1 << 40) - 1))
    second = F.shiftrightunsigned(F.xxhash64(F.lit(1), id_column), 41)
    return F.shiftleft(first, 23).bitwiseOR(second)


def splitters(keyed: DataFrame, total: int, ranges: int, samples: int) -> list[int]:
    """At most `ranges` - 1 quantiles of a size-weighted sample of about `samples` keys."""
    # A hash of the row decides, so that a task that runs again draws the same keys.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(2), "key", "size"), 11) / F.lit(float(1 << 53))
    drawn = keyed.filter(draw * F.lit(float(total)) < F.col("size") * F.lit(float(samples)))
    part = W.orderBy("key")
    tiles = drawn.select("key").withColumn("tile", F.ntile(ranges).over(part))
    return [r.key for r in tiles.groupBy("tile").agg(F.min("key").alias("key")).filter("tile > 1").orderBy("key").collect()]


def range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds that are not above the key, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    literal = lambda values: F.array(*[F.lit(v) for v in values])
    below = lambda values: F.size(F.filter(values, lambda x: x <= key))
    group = F.greatest(below(literal([g[0] for g in groups])) - 1, F.lit(0))
    table = F.array(*[literal(g) for g in groups])
    return group * step + below(F.element_at(table, group + 1))


def fills(large: list[tuple[int, int]], total: int, shards: int):
    """Deals the large records; returns their shards and where the line of the others is cut.

    large: (size, number). The cuts are cumulative sizes, one per shard.
    """
    loads = [(0, s) for s in range(shards)]
    placed = {}
    for size, number in sorted(large, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(loads)
        placed[number] = shard
        heapq.heappush(loads, (load + size, shard))
    held = {s: load for load, s in loads}
    left = total - sum(size for size, _ in large)
    # Shards above the common level get none of the others; the level then falls.
    open_shards = set(range(shards))
    while open_shards:
        level = (left + sum(held[s] for s in open_shards)) / len(open_shards)
        over = {s for s in open_shards if held[s] > level}
        if not over:
            break
        open_shards -= over
    room = {s: max(0.0, level - held[s]) if s in open_shards else 0.0 for s in range(shards)}
    ends, at = [], 0.0
    for s in range(shards):
        at += room[s]
        ends.append(at)
    ends[max(open_shards, default=shards - 1) :] = [float(left) + 1.0] * (shards - max(open_shards, default=shards - 1))
    return placed, ends


def assign(
    records: DataFrame,
    shards: int,
    text: str = "text",
    id_column: str = "doc_id",
    size: Column | None = None,
    samples_per_range: int = SAMPLES_PER_RANGE,
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """One row per record: id, size, text_crc32, law, shard, slot, grown_shard.

    Slots number the records of a shard from 0 without gaps, in key order.
    Runs jobs: the keys are written once, then sampled and counted.
    """
    checksum = F.crc32(F.col(text).cast("binary"))
    keyed = cut(
        records.select(
            F.col(id_column).alias("id"),
            (size_of(text) if size is None else size.cast("bigint")).alias("size"),
            checksum.alias("text_crc32"),
            key_of(text, id_column).alias("key"),
        ),
        "shard-keys",
    )
    sums = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.count("*").alias("n")).first()
    total = sums.total
    least_large = total // (shards * LARGE) + 1
    is_large = F.col("size") >= least_large
    # At most shards * LARGE records are that large. Equal ones get numbers in the order of this list.
    order = ["size", "key", "id", "text_crc32"]
    large = keyed.filter(is_large).orderBy(*order).collect()
    placed, ends = fills([(r["size"], i) for i, r in enumerate(large)], total, shards)

    others = keyed.filter(~is_large)
    # More rows get more ranges, so that the rows of a range stay few enough to sort in a task.
    n_ranges = max(shards * ranges_per_shard, sums.n // ROWS_PER_RANGE)
    bounds = splitters(others, total, n_ranges, n_ranges * samples_per_range)
    ranged = others.withColumn("range", range_of(F.col("key"), bounds))
    # An overfull range is subdivided by a second hash, in about parts of the size meant for a range.
    meant = max(1, total // n_ranges)
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > 2 * meant)
    parts = {r["range"]: -(-r["bytes"] // meant) for r in sizes.collect()}  # one number per range at most
    n_parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col("range")), F.lit(1)) if parts else F.lit(1)
    ranged = ranged.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "id", "key"), n_parts).cast("int"))

    # Where each range begins on the line. A range per row: a few thousand rows, whatever the input.
    begins = (
        ranged.groupBy("range", "part")
        .agg(F.sum("size").alias("bytes"))
        .withColumn("begin", F.sum("bytes").over(W.orderBy("range", "part")) - F.col("bytes"))
        .drop("bytes")
    )
    own = W.partitionBy("range", "part").orderBy("key", "id", "text_crc32", "size")
    on_line = ranged.withColumn("within", F.sum("size").over(own.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    on_line = on_line.join(F.broadcast(begins), ["range", "part"])
    middle = F.col("begin") + F.col("within") + F.col("size") / 2
    cuts = F.array(*[F.lit(x) for x in ends[:-1]]) if shards > 1 else F.array().cast("array<double>")
    line = on_line.withColumn("shard", F.size(F.filter(cuts, lambda x: x <= middle)).cast("int"))
    line = cut(line.select("id", "size", "text_crc32", "key", "range", "part", "shard"), "shard-line")

    # Slots: the large records first, then range by range.
    counts = line.groupBy("shard", "range", "part").count()
    first = [0] * shards
    slots = []
    for i, _ in enumerate(large):
        slots.append((i, placed[i], first[placed[i]]))
        first[placed[i]] += 1
    before = F.sum("count").over(W.partitionBy("shard").orderBy("range", "part")) - F.col("count")
    offsets = counts.select("shard", "range", "part", (before + F.element_at(F.array(*[F.lit(n) for n in first]), F.col("shard") + 1)).alias("before"))
    own = W.partitionBy("shard", "range", "part").orderBy("key", "id", "text_crc32", "size")
    small = line.withColumn("slot", F.row_number().over(own) - 1).join(F.broadcast(offsets), ["shard", "range", "part"])
    small = small.select("id", "size", "text_crc32", "shard", (F.col("slot") + F.col("before")).cast("bigint").alias("slot"))
    if large:
        spark = records.sparkSession
        rows = [(r["id"], r["size"], r["text_crc32"], shard, slot) for r, (_, shard, slot) in zip(large, slots)]
        small = small.unionByName(spark.createDataFrame(rows, small.schema))
    return small.select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write(records: DataFrame, assigned: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Writes the records as Parquet, one folder per shard. Ids have to be unique and not null."""
    records.join(assigned.select(id_column, "shard", "slot"), id_column).repartition("shard", F.floor(F.col("slot") / 65536)).write.partitionBy("shard").parquet(path)
