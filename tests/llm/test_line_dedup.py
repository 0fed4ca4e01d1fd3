import hashlib
import random

from chunkloom.llm import line_dedup
from tests.llm import samples


def chunks(text, mean=3):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, first = [], 0
    for i in range(len(lines)):
        rolling = h[i] * 1000003 + (h[i - 1] if i else 0)
        if i == len(lines) - 1 or rolling % 2147483647 % mean == 0:
            out.append((first, i + 1))
            first = i + 1
    return lines, out


def brute(rows):
    """By (id, text): the clean text and the number of lines removed."""
    seen, result = {}, {}
    whole = lambda own: len(own) >= 2 and sum(x.strip(" ") != "" for x in own) >= 2
    order = lambda r: (-(2**63) if r[0] is None else r[0])
    for i, text in sorted(set(rows), key=order):
        if text is None:
            continue
        lines, spans = chunks(text)
        kept = []
        for a, b in spans:
            body = "\n".join(lines[a:b])
            owner = (order((i,)), text)
            if whole(lines[a:b]) and (seen.setdefault(body, (owner, a)) != (owner, a)):
                continue
            kept += lines[a:b]
        result[i, text] = "\n".join(kept), len(lines) - len(kept)
    return result


def test_against_plain_chunking(spark):
    rnd = random.Random(8)
    pool = [f"line {i}" for i in range(30)] + ["", " "]
    texts = []
    for i in range(60):
        start = rnd.randrange(20)
        texts.append("\n".join([rnd.choice(pool) for _ in range(rnd.randrange(4))] + pool[start : start + rnd.randrange(12)] + ["end"] * rnd.randrange(3)))
    rows = [(i, t) for i, t in enumerate(texts)] + samples.edge_texts()[1:2] + [(70, ""), (71, "é\n" * 9), (72, "one\ntwo\n" * 400), (None, texts[5]), (73, texts[9]), (73, texts[9])]
    got = line_dedup.dedup(samples.with_clashes(samples.documents(spark, rows))).collect()
    want = brute(rows)
    assert len(got) == len(rows) and sum(r.n_removed for r in got) > 50
    for r in got:
        if r.text is None:
            assert (r.n_lines, r.n_removed, r.clean_text) == (0, 0, None)
        else:
            assert (r.clean_text, r.n_removed, r.n_lines, r.hits) == (*want[r.doc_id, r.text], r.text.count("\n") + 1, "x")


def test_boundaries_shift_with_the_content(spark):
    lines = [f"sentence {i} of the passage" for i in range(40)]
    docs = samples.documents(spark, ["\n".join(lines), "\n".join(["a", "b", "c", "d", *lines[3:], "e"])])
    removed = {r.doc_id: r.n_removed for r in line_dedup.dedup(docs).collect()}
    assert removed[0] == 0 and removed[1] >= 25


def test_empty_table(spark):
    assert line_dedup.dedup(samples.documents(spark, ["a"]).limit(0)).collect() == []
