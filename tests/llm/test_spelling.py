import random
import zlib
from collections import Counter

import pytest

from chunkloom.llm import spelling
from tests.llm.samples import documents, edge_texts, with_clashes


def brute(texts, shortest=7, fewest=2, ratio=10):
    """Characters one by one, all pairs of words, and forms followed one by one."""
    counts = Counter()
    for i, text in texts:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    kept = {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]

    near = {w: [v for v in kept if one_edit(w, v)] for w in kept}
    best = {w: min(vs, key=lambda v: (-kept[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if kept[v] >= ratio * kept[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), kept[form[w]] if w in form else None) for w, n in kept.items()}


def varied(seed, n):
    """Words of few letters with their variants, some far more frequent than others, in chains."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 9))) for _ in range(25)]
    out = []
    for _ in range(n):
        w = base[min(int(rnd.expovariate(0.25)), 24)]
        while rnd.random() < 0.12:
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice("abcdÀ") + w[i:], w[:i] + rnd.choice("abcd") + w[i + 1 :]])
        out.append(w.upper() if rnd.random() < 0.1 else w)
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed,parts,ratio", [(1, 6, 10), (2, 3, 2), (3, 9, 3)])
def test_against_all_pairs(spark, seed, parts, ratio):
    many = varied(seed, 9000)
    texts = [(i, ", ".join(many[i::60])) for i in range(60)]
    result = got(spelling.variants(with_clashes(documents(spark, texts)), ratio=ratio, parts=parts))
    assert result == brute(texts, ratio=ratio)
    assert any(r[1] is not None and r[1] != r[2] for r in result) or ratio > 2


def test_edges(spark):
    texts = edge_texts() + [(20, "Straße×÷straße STRASSE naïveté NAÏVETÉ"), (21, "x" * 9 + " " + "x" * 10 + " " + "x" * 9 + "1" + "x" * 10), (None, "nothing nothing")]
    assert got(spelling.variants(documents(spark, texts))) == brute(texts)


def test_chains_of_forms(spark):
    texts = [(1000 + i, " ".join(["abcdefgh"] * 70 + ["abcdefgx"] * 7 * (i < 10) + ["abcdefyx"] * 7 * (i < 1))) for i in range(100)]
    result = got(spelling.variants(documents(spark, texts)))
    assert result == brute(texts)
    assert {r[0]: (r[1], r[2]) for r in result}["abcdefyx"] == ("abcdefgx", "abcdefgh")


def test_anagrams_in_several_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CLASS_WORDS", 3)
    rnd = random.Random(4)
    letters = [list("aabbccdd"), list("aabbccde"), list("aabbccddd")]
    many = []
    for _ in range(600):
        own = rnd.choice(letters)
        rnd.shuffle(own)
        many.append("".join(own))
    texts = [(i, " ".join(many[i::5] + many[i::5])) for i in range(5)]
    assert got(spelling.variants(documents(spark, texts))) == brute(texts)


def test_long_texts_in_windows(monkeypatch):
    monkeypatch.setattr(spelling, "WINDOW_CHARS", 10)
    text = "alpha beta " * 9 + "y" * 50 + " gamma"
    assert sum((Counter({w: n}) for w, n in spelling.occurrences(3, text)), Counter()).total() == 20
    assert {w for w, _ in spelling.occurrences(3, "z" * 40)} <= {"z" * 40, "z" * 39}


@pytest.mark.parametrize("parts", [2, 3, 6])
def test_close_multisets_share_a_signature(parts):
    rnd = random.Random(parts)
    for _ in range(300):
        a = [rnd.choice("abcdef") for _ in range(rnd.randint(2, 9))]
        b = list(a)
        b[rnd.randrange(len(b))] = rnd.choice("abcdefg")
        own, other = "".join(sorted(a)), "".join(sorted(b))
        shared = {s for s in spelling.signatures(own, {}, parts) if s[1] == spelling.SAME} & set(spelling.signatures(other, {}, parts))
        out, into = spelling.difference(own, other)
        if out:
            assert spelling.agreed_signature(out[0], into[0], {}, parts) in {s[2] for s in shared}
        longer = "".join(sorted([*a, rnd.choice("abcdefg")]))
        short = {(h, p) for h, side, p in spelling.signatures(own, {}, parts) if side == spelling.SHORT}
        assert short & {(h, p) for h, side, p in spelling.signatures(longer, {}, parts) if side == spelling.LONG}


def test_empty_table(spark):
    assert got(spelling.variants(documents(spark, []))) == set()
