import random
import re

import pytest

from chunkloom.llm import components, jaccard_join
from tests.llm import samples

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, shingles(t, k))
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def family(seed, copies, n, edits):
    rnd = random.Random(seed)
    base = samples.words(seed, n, 3000).split()
    for _ in range(copies):
        own = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            own[rnd.randrange(n)] = f"e{rnd.randrange(10**6)}"
        yield " ".join(own)


def corpus():
    texts = [t for _, t in samples.edge_texts()]
    for s, (copies, n, edits) in enumerate([(60, 90, 3), (12, 40, 1), (9, 12, 1), (25, 300, 12), (6, 5, 1), (4, 2, 1)]):
        texts += family(s, copies, n, edits)
    shared = samples.words(77, 40, 3000)
    texts += [f"{samples.words(500 + i, 60, 3000)} {shared}" for i in range(40)]
    return list(enumerate(texts)) + [(None, texts[0]), (3, texts[3]), (0, texts[0])]


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_against_all_pairs(spark, k, percent, monkeypatch):
    # Small groups, so that families are divided and groups have several parts.
    for name, value in (("GROUP_ROWS", 4), ("VISITORS", 3), ("SAMPLE", 2), ("FREQUENT", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus()
    docs = samples.with_clashes(samples.documents(spark, rows))
    got = jaccard_join.components(docs, jaccard_join.Rule(k, percent)).collect()
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_empty_table(spark):
    assert jaccard_join.components(samples.documents(spark, ["a"]).limit(0)).collect() == []
    assert [tuple(r) for r in jaccard_join.components(samples.documents(spark, [None])).collect()] == [(0, 0, 0)]


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_bounds_never_lose_a_link(percent):
    rule = jaccard_join.Rule(3, percent)
    for a in range(1, 60):
        for b in range(a, 60):
            fewest = next((c for c in range(1, a + 1) if rule.links(c, a, b)), None)
            if fewest:
                assert rule.overlap(a) <= fewest and rule.overlap(b) <= fewest
                # Of so many common tokens, the first early_common are early in both orders.
                smaller = max(1, -(-b * percent // 100) // 16)
                for n in (a, b):
                    assert rule.early(n) >= min(n, smaller + n - fewest)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_links_of_near_copies_grow_with_their_number(spark, monkeypatch):
    made, connect = [], components.connected
    monkeypatch.setattr(jaccard_join, "connected", lambda edges: made.append(edges.count()) or connect(edges))
    texts = []
    for i, t in enumerate(["base"] * 300):
        own = samples.words(5, 200, 3000).split()
        own[37 * i % 200] = f"x{i}"
        own[(53 * i + 90) % 200] = f"y{i}"
        texts.append(" ".join(own))
    got = jaccard_join.components(samples.documents(spark, texts), jaccard_join.Rule(5, 80)).collect()
    assert {r.component_id for r in got} == {0}
    assert max(made) < 6 * len(texts)


def near_copies(count, edits, n=150):
    """Copies of one text; each lacks words at places of its own and has new ones."""
    rnd = random.Random(8)
    for i in range(count):
        own = samples.words(5, n, 3000).split()
        for at in rnd.sample(range(5, n - 5), edits):
            own[at] = f"x{i}w{at}"
        yield " ".join(own)


def test_near_copies_below_the_threshold_hardly_meet(spark, monkeypatch):
    for name, value in (("SAMPLE", 2), ("FREQUENT", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    met, of = [], jaccard_join.visits_of
    monkeypatch.setattr(jaccard_join, "visits_of", lambda *args: met.append(of(*args)) or met[-1])
    got = jaccard_join.components(samples.documents(spark, list(near_copies(200, 4)))).collect()
    assert all(r.component_id == r.doc_id for r in got)
    assert met[0].count() < 200  # of 19900 pairs


def test_a_phrase_alone_sends_nobody(spark, monkeypatch):
    sent, links = [], jaccard_join.links
    monkeypatch.setattr(jaccard_join, "links", lambda docs, members, visits, *args, **options: sent.append(visits.count()) or links(docs, members, visits, *args, **options))
    texts = [f"{samples.words(900 + i, 80, 3000)} {samples.words(77, 20, 3000)}" for i in range(200)]
    got = jaccard_join.components(samples.documents(spark, texts)).collect()
    assert all(r.component_id == r.doc_id for r in got)
    assert sent[0] < 60  # some 100 share a minimum


def test_early_tokens_are_not_carried_from_table_to_table(spark, monkeypatch):
    kept, cut = {}, jaccard_join.cut
    monkeypatch.setattr(jaccard_join, "cut", lambda df, name: kept.setdefault(name, df.columns) and cut(df, name))
    jaccard_join.components(samples.documents(spark, list(family(1, 9, 60, 2))))
    assert [name for name, columns in kept.items() if "early" in columns] == ["sets"]


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_the_matrix_loses_no_link(spark, k, percent):
    rule, rnd, texts = jaccard_join.Rule(k, percent), random.Random(3), []
    for n in (4, 12, 40, 50, 90, 300, 700):
        base = samples.words(n, n, 3000).split()
        for _ in range(20):
            own = list(base)
            for _ in range(rnd.randrange(1 + n * (100 - percent) // (150 * k))):
                at = rnd.randrange(len(own))
                own[at : at + rnd.choice((0, 1, 1, 2))] = rnd.choice(([], [f"e{rnd.randrange(10**6)}"]))
                own = own or ["e"]
            texts.append(" ".join(own).encode())
    distinct = {s.tobytes(): s for s in jaccard_join.sets_of(texts, k)}.values()
    sets = [(i, set(s.tolist()), [int(x) for x in s[: rule.early(len(s))].astype("int64")]) for i, s in enumerate(distinct)]
    rows = [(i, len(s), i, (1, i), early) for i, s, early in sets]
    members = spark.createDataFrame(rows, "id bigint, n bigint, `group` bigint, rank struct<size: bigint, component: bigint>, early array<bigint>")
    found = {(r.id, r.group) for r in jaccard_join.visits_of(members, rule).collect()}
    want = {(a, b) for a, s, _ in sets for b, t, _ in sets if a < b and rule.links(len(s & t), len(s), len(t)) and s & t}
    assert len(want) > 50 and want <= found
    assert len({len(s) - len(t) for a, s, _ in sets for b, t, _ in sets if (a, b) in want}) > 5
