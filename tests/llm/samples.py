"""Documents with the cases that every operator has to bear."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = "score string, hits string, ids string, n string, key string, token string, removed string, licenses string, shard string, class string, component string"


def documents(spark, texts, **extra):
    """One row per text, or per (id, text)."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], SCHEMA)


def with_clashes(df):
    """Extra columns named like results and inner columns of the operators."""
    from pyspark.sql import functions as F

    return df.withColumns({c.split()[0]: F.lit("x") for c in CLASHES.split(", ")})


def words(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def edge_texts():
    base = words(1, 120, 5000)
    copied = base.split()
    copied[60] = "changed"
    lines = "\n".join(words(s, 12) for s in range(8))
    return [
        (0, base), (1, None), (2, ""), (3, " \t\n "), (4, " ".join(copied)), (5, base.upper()), (5, base.upper()),
        (None, "no id at all " * 5), (7, words(7, 30_000, 60_000)), (8, "é" * 150 + "\x00 ß ﬁn"), (9, "one"), (10, "two words"),
        (11, lines), (12, "Title\n" + lines), (13, "a" * 700), (14, "Released under the MIT License.\n" + words(9, 20)),
    ]
