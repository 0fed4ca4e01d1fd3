"""Exact n-gram Jaccard join with a token-group matrix.

Documents with equal shingle sets are one class, and only its smallest id goes on.
Similar classes are partitioned into groups: equal minimum hashes, divided
further where a group would get too large. The matrix has a row for each token that
stands early in the order of a member's tokens, each group and size; frequent tokens come
last in this order. Two sets that link share a known number of tokens that stand before a
place which follows from both sizes, so a query counts its own among the tokens of a group,
and only groups with enough of them are visited. A visited group has the union of its members' tokens: if the query
shares too few tokens with the union, the group stays closed; else the query is
compared with the members exactly. Members of one group are compared in their group.

Only links that connect something new are returned, never all pairs of a group. The
groups of one family meet in its first group, and classes that share one of the minima
in the group of the smallest id, if a second one is equal. Parts that are still unconnected go through the
matrix; a query visits groups with members of larger parts only, which finds each link once.

Sets are of 64-bit hashes of shingles. Documents with fewer words than a shingle have
the whole sequence as their one shingle; null and empty texts have an empty set and
link with nothing. Rows of one id are one document. Rows without an id link with
nothing. An empty table gives no rows. Other columns are not returned.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm.components import connected
from chunkloom.llm.scratch import cut
from chunkloom.llm.tables import text_runs

BATCH_BYTES = 2 << 20
GROUP_ROWS = 128
GROUP_TOKENS = 1 << 17
VISITORS = 512
SAMPLE = 32  # one document in so many shows which tokens are frequent
FREQUENT = 8  # sampled documents that make a token frequent
MOST_FREQUENT = 1 << 20  # bound of the list that is broadcast; it only orders tokens

_SPACES = bytes(i + 32 if 65 <= i <= 90 else 32 if 9 <= i <= 13 else i for i in range(256))
# A family shares a minimum for each of these.
_STARTS = np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Rule:
    """Shingle length, and the least Jaccard similarity as a percentage."""

    words: int = 3
    percent: int = 90

    def overlap(self, n):
        """The fewest common tokens of a set of n with a set that it links with."""
        return -(-self.percent * n // 100)

    def early_common(self, n):
        """So many of the early tokens of a set of n are common with any set of its size or larger that it links with."""
        return np.maximum(1, np.minimum(n // 16, np.maximum(3, n // 64)))

    def early(self, n):
        return min(n, n - self.overlap(n) + int(self.early_common(n)))

    def links(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _P2
    return h ^ (h >> np.uint64(32))


def sets_of(texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    import xxhash

    split = [t.translate(_SPACES).split() if t else [] for t in texts]
    number: dict[bytes, int] = {}
    places = [np.fromiter((number.setdefault(w, len(number)) for w in own), np.int64, len(own)) for own in split]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    out = []
    for own in places:
        h = hashes[own]
        n = min(size, len(h))
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        # A whole short sequence differs from any shingle of full length by its start.
        total = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):
            total = _mix((total ^ h[j : len(h) - n + 1 + j]) * _P1)
        out.append(np.unique(total))
    return out


def _early(rule: Rule, frequent):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()), ("family", pa.int64()), ("low", pa.list_(pa.int64())), ("early", pa.list_(pa.int64()))])

    def run(batches):
        import xxhash

        common = frequent.value
        for batch in batches:
            for rows, texts in text_runs(batch, "text", BATCH_BYTES):
                out = []
                for own in sets_of(texts, rule.words):
                    often = np.zeros(len(own), bool)
                    if len(common) and len(own):
                        often = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
                    first = np.concatenate([own[~often], own[often]])[: rule.early(len(own))]
                    family, low = 0, []
                    if len(own):
                        low = [_mix(own ^ start).min() for start in _STARTS]
                        family = int(xxhash.xxh3_64_intdigest(np.array(low).tobytes()) >> 1)
                    out.append((len(own), xxhash.xxh3_128_digest(own.tobytes()), family, np.array(low, np.uint64).astype(np.int64), first.astype(np.int64)))
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.get_field_index("id")), *(pa.array(v, schema.field(i).type) for i, v in enumerate(columns, 1))],
                    schema=schema,
                )

    return run, "id bigint, n bigint, class binary, family bigint, low array<bigint>, early array<bigint>"


def frequent_tokens(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Sorted hashes of tokens that many sampled documents hold, at most MOST_FREQUENT."""

    def tokens(batches):
        for batch in batches:
            for _, texts in text_runs(batch, "text", BATCH_BYTES):
                every = np.concatenate(sets_of(texts, rule.words))
                yield pa.RecordBatch.from_arrays([pa.array(every.astype(np.int64))], names=["token"])

    sample = docs.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(tokens, "token bigint").groupBy("token").count().filter(F.col("count") >= FREQUENT)
    found = counts.orderBy(F.col("count").desc(), "token").limit(MOST_FREQUENT).select("token").toArrow()
    return np.sort(found["token"].to_numpy().astype(np.int64).view(np.uint64))


class Group:
    """A group opened in a task: its members' sets and the union of their tokens."""

    def __init__(self, ids, sets, rule: Rule):
        self.ids, self.sets, self.rule = ids, sets, rule
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.union = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        self.held = np.zeros((len(sets), len(self.union)), np.uint8)
        for row, own in zip(self.held, sets):
            row[np.searchsorted(self.union, own)] = 1
        self.part = np.arange(len(sets))

    def linked(self, query: np.ndarray) -> np.ndarray:
        """Members that link with a set; none if its overlap with the union is too small."""
        if not len(query) or not len(self.union):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if len(at) < self.rule.overlap(len(query)):
            return np.zeros(0, np.int64)
        common = self.held[:, at].sum(axis=1, dtype=np.int64)
        return np.flatnonzero(self.rule.links(common, len(query), self.sizes) & (common > 0))

    def connect(self):
        """Links inside the group, one for each two parts that it connects."""
        for i, own in enumerate(self.sets):
            for j in self.linked(own):
                if self.part[i] != self.part[j]:
                    yield self.ids[i], self.ids[j]
                    self.part[self.part == self.part[j]] = self.part[i]

    def visit(self, query: np.ndarray):
        """One linked member for each part of the group."""
        found = self.linked(query)
        return [self.ids[found[i]] for i in np.unique(self.part[found], return_index=True)[1]]


def _open(rule: Rule):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["member"].to_pylist(), table["id"].to_pylist(), table["set"].to_pylist()), key=lambda r: (not r[0], r[1]))
        ids = {True: [], False: []}
        sets = {True: [], False: []}
        for member, i, raw in rows:
            if not ids[member] or ids[member][-1] != i:  # repeated rows
                ids[member].append(i)
                sets[member].append(np.frombuffer(raw, np.uint64))
        group = Group(ids[True], sets[True], rule)
        links = list(group.connect())
        for i, own in zip(ids[False], sets[False]):
            links += [(i, j) for j in group.visit(own)]
        return pa.table([[a for a, _ in links], [b for _, b in links]], schema=schema)

    return run


def _ship(rule: Rule):
    """Rows (group, part, member, id, set): a document's set for each of its errands."""

    def run(batches):
        for batch in batches:
            for rows, texts in text_runs(batch, "text", BATCH_BYTES):
                errands = rows.column(rows.schema.get_field_index("errands"))
                counts = np.array([len(x) for x in errands.to_pylist()])
                owner = np.repeat(np.arange(len(rows)), counts)
                flat = errands.flatten()
                sets = pa.array([s.tobytes() for s in sets_of(texts, rule.words)], pa.binary())
                ids = rows.column(rows.schema.get_field_index("id"))
                # In slices, since many errands copy a large set many times.
                for at in range(0, len(owner), 256):
                    part, who = flat.slice(at, 256), pa.array(owner[at : at + 256])
                    yield pa.RecordBatch.from_arrays(
                        [*(part.field(n) for n in ("group", "part", "member")), ids.take(who), sets.take(who)],
                        names=["group", "part", "member", "id", "set"],
                    )

    return run, "group bigint, part int, member boolean, id bigint, set binary"


def links(docs: DataFrame, members: DataFrame, visits: DataFrame, rule: Rule) -> DataFrame:
    """Opens groups: links (a, b) inside them and of their visitors.

    members: (id, group) of all classes, visits: (id, group). A group with many visitors
    is opened in several tasks, each with all members.
    """
    visits = visits.distinct()
    counts = visits.groupBy("group").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("parts"))
    several = members.groupBy("group").agg(F.count("*").alias("rows")).filter("rows > 1").select("group")
    opened = cut(several.join(counts, "group", "full").select("group", F.coalesce("parts", F.lit(1)).alias("parts")), "opened")
    at_home = members.join(opened, "group").select("id", "group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("member"))
    away = visits.join(opened, "group").select("id", "group", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("member"))
    errands = at_home.unionByName(away).groupBy("id").agg(F.collect_list(F.struct("group", "part", "member")).alias("errands"))
    ship, shape = _ship(rule)
    errands = cut(errands, "errands")
    shipped = docs.join(errands.hint("merge"), "id").select("id", "text", "errands").mapInArrow(ship, shape)
    return shipped.groupBy("group", "part").applyInArrow(_open(rule), "a bigint, b bigint")


def _early_common(n):
    """Rule.early_common of a column."""
    return F.greatest(F.lit(1), F.least(F.floor(n / 16), F.greatest(F.lit(3), F.floor(n / 64))))


def visits_of(members: DataFrame, rule: Rule) -> DataFrame:
    """(id, group): queries and the groups that hold enough of their early tokens.

    members: id, n, group, rank, early. Only members of different ranks meet, and the
    smaller rank is the query, so that a token of one rank only costs nothing. Sets of a
    and b tokens that link have at least P * (a + b) / (100 + P) in common, P percent. As
    many less k - 1 of them come after the k-th, so this one stands before a last place in
    either set. Near copies that don't link differ in their first tokens up to there, mostly.
    """
    cells = members.select(F.posexplode("early").alias("place", "token"), "id", "n", "group", "rank")
    of_token = W.partitionBy("token")
    cells = cells.repartition("token").withColumns({"top": F.max("rank").over(of_token), "low": F.min("rank").over(of_token)})
    cells = cut(cells.filter("low < top").select("token", "place", "id", "n", "group", "rank", "top"), "matrix")
    asked = cells.filter("rank < top").select("token", "place", "id", "n", F.col("rank").alias("own"))
    held = cells.groupBy("token", "group", "rank", F.col("n").alias("size")).agg(F.min("place").alias("first"))
    k = F.least(_early_common(F.col("n")), _early_common(F.col("size")))
    after = F.least(F.col("n") - F.col("place"), F.col("size") - F.col("first")) - 1
    met = asked.join(held.hint("merge"), "token").filter(
        (F.col("own") < F.col("rank"))
        & (F.col("size") * 100 >= F.col("n") * rule.percent)
        & (F.col("size") * rule.percent <= F.col("n") * 100)
        & ((F.col("n") + F.col("size")) * rule.percent <= (after + k) * (100 + rule.percent))
    )
    # A group can stand in several rows of a token, one for each rank and size of its members; it is then counted too high.
    common = met.groupBy("id", "group").agg(F.count("*").alias("common"), F.min(k).alias("needed"))
    return common.filter(F.col("common") >= F.col("needed")).select("id", "group")


def components(docs: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links). Runs jobs."""
    docs = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, rule))
    early, shape = _early(rule, frequent)
    sets = cut(docs.mapInArrow(early, shape), "sets")
    # What follows from a set is the same in all rows of its class.
    of_set = {"n": F.min("n"), "family": F.min("family")} | {f"low{i}": F.min(F.col("low")[i]) for i in range(len(_STARTS))}
    full = sets.filter("n > 0 and id is not null")
    reps = cut(full.groupBy("class").agg(F.min("id").alias("id"), *(v.alias(k) for k, v in of_set.items())), "classes")
    # Joins with tables that grow with the documents are merged at every size, so that plan and
    # shuffle of a document stay alike as the table grows.

    # Families, and the groups they are divided into. The groups of a family are numbered by the hash of the id.
    families = cut(
        reps.groupBy("family")
        .agg(F.count("*").alias("rows"), F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("groups"))
        .filter("rows > 1"),
        "families",
    )
    member = (
        reps.join(families.hint("merge"), "family", "left")
        .withColumns({"rows": F.coalesce("rows", F.lit(1)), "groups": F.coalesce("groups", F.lit(1))})
        .withColumn("group", F.when(F.col("rows") == 1, F.col("id")).otherwise(F.xxhash64("family", F.pmod(F.xxhash64("id"), F.col("groups")))))
    )
    member = cut(member.select("class", "id", "n", "family", "rows", "groups", "group", *(f"low{i}" for i in range(len(_STARTS)))), "members")
    home = member.select("id", "group")

    # The members of a divided family visit the family's first group.
    divided = member.filter("groups > 1")
    hubs = cut(divided.groupBy("family").agg(F.min("group").alias("hub")), "hubs")
    to_hub = divided.join(hubs, "family").filter("group <> hub").select("id", F.col("hub").alias("group"))
    # Classes that share one minimum visit the group of the smallest id among them, if a second one is equal and the sizes allow a link.
    # 16 bits of each are compared: a frequent phrase alone sends nobody.
    lows = [F.col(f"low{i}") for i in range(len(_STARTS))]
    bits = F.array(*(x.bitwiseAND(0xFFFF) for x in lows))
    minimum = member.select("id", "n", "group", bits.alias("bits"), F.posexplode(F.array(*lows)).alias("nth", "low"))
    first = minimum.groupBy("nth", "low").agg(F.min(F.struct("id", "n", "group", "bits")).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    first = cut(first, "first")
    equal = sum((F.col("bits")[i] == F.col("first.bits")[i]).cast("int") for i in range(len(_STARTS)))
    may = (F.greatest("n", "first.n") * rule.percent <= F.least("n", "first.n") * 100) & (equal > 1)
    to_first = minimum.join(first.hint("merge"), ["nth", "low"]).filter("group <> first.group").filter(may).select("id", F.col("first.group").alias("group"))
    found = cut(links(docs, home, cut(to_hub.union(to_first), "sent"), rule), "links")
    joined = connected(found)

    # What is connected by now is one part. The parts go through the matrix, whose queries visit groups with members of other
    # parts only: a family of near copies does not meet itself pair by pair.
    labelled = member.join(joined.withColumnRenamed("node", "id").hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = cut(labelled.select("class", "id", "n", "group", "component"), "labelled")
    parts = labelled.groupBy("component").agg(F.count("*").alias("size"))
    ranked = labelled.join(parts.hint("merge"), "component").select("class", "id", "group", F.struct("size", "component").alias("rank"))
    # The early tokens are fetched here, once, and not carried along.
    late = cut(visits_of(full.select("class", "id", "n", "early").join(ranked.hint("merge"), ["class", "id"]), rule), "late")
    if not late.isEmpty():
        their = home.join(late.select("group").distinct(), "group", "left_semi").select("id", "group")
        joined = connected(found.union(links(docs, their, late, rule)))
    of_class = reps.join(joined, reps.id == joined.node, "left").select("class", F.coalesce("component", "id").alias("component"))
    out = sets.join(cut(of_class, "class-components"), "class", "left")
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"))
