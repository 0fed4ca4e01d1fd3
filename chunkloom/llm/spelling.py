"""Grouping of spelling variants by PartEnum signatures.

Words that differ by one inserted, deleted or replaced letter have letter multisets that are
close: as binary vectors with a dimension (letter, k) for the k-th copy of a letter, a
replacement changes two dimensions of words of equal length, an insertion one. PartEnum
deals the dimensions to PARTS parts and enumerates the parts that may differ: vectors at
Hamming distance two agree on all parts but some two, at distance one on all but one. A
signature is the length, the parts left out, and the dimensions in all others; multisets that are
close share one, exactly. They meet in an equi-join, and Python verifies what meets: the
multisets first, then their words, by looking up each word with the one letter changed.

A multiset stands for all words with these letters, so that words which only order them
differently never meet in pairs; beyond CLASS_WORDS they are dealt to several rows. Dimensions are dealt so that the parts tell as much as each
other, by counted frequencies: of the MOST_DIMENSIONS most frequent ones, the rest by hash.
Two multisets that share several signatures are verified at one of them.

Words are counted once per text and task before they are shuffled, and near words per batch.
Null texts have no words, a null id counts as the empty text. Repeated rows count each. Ties
go to the smaller word in code-point order. Texts of any length are read in windows that end
between words. An empty table gives no words. Only the id and the text are read, so other
columns may have any names.
"""

import functools
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.scratch import cut
from chunkloom.llm.tables import text_runs

PARTS = 6
MOST_DIMENSIONS = 512
BATCH_BYTES = 1 << 22
WINDOW_CHARS = 1 << 20
KEPT_WORDS = 200_000
#: A multiset that more words share than this is dealt to several rows.
CLASS_WORDS = 2048
DROP_EVERY = 31

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_OTHER = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lowered(word: str) -> str:
    """A to Z in lower case, all else as it is."""
    return word.lower() if word.isascii() else word.translate(_LOWER)


def _windows(text: str):
    """Parts of a text that cut no run of letters."""
    start = 0
    while len(text) - start > WINDOW_CHARS:
        gap = _OTHER.search(text, start + WINDOW_CHARS)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def occurrences(doc_id, text: str):
    """(word, times) of a text, with the letter deleted that the id and the word choose."""
    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for part in _windows(text):
        for run, times in Counter(_RUN.findall(part)).items():
            word = lowered(run)
            h = zlib.crc32(word.encode(), salt)
            if h % DROP_EVERY == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            yield word, times


def words(docs: DataFrame, shortest: int = 7, fewest: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of words of `shortest` letters and `fewest` occurrences at least."""

    def run(batches):
        counts: Counter = Counter()
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

        def counted():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)
            counts.clear()
            return batch

        for batch in batches:
            for rows, texts in text_runs(batch, "text", BATCH_BYTES):
                for doc_id, content in zip(rows.column(0).to_pylist(), texts):
                    for word, times in occurrences(doc_id, content.decode()) if content else ():
                        if len(word) >= shortest:
                            counts[word] += times
                if len(counts) > KEPT_WORDS:
                    yield counted()
        yield counted()

    rows = docs.select(docs[id_column].cast("string").alias("id"), docs[text].alias("text")).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def dimensions(letters: str):
    """(letter, k) of the letters of a word, sorted."""
    for letter, group in itertools.groupby(letters):
        for k, _ in enumerate(group):
            yield letter, k


def balanced(counts: dict[tuple[str, int], int], rows: int, parts: int = PARTS) -> dict[tuple[str, int], int]:
    """The part of each counted dimension: the most telling ones first, each to the part that tells least so far."""

    def entropy(n: int) -> float:
        p = min(max(n / max(rows, 1), 1e-9), 1 - 1e-9)
        return float(-(p * np.log2(p) + (1 - p) * np.log2(1 - p)))

    told, out = [0.0] * parts, {}
    for _, name in sorted((-entropy(n), name) for name, n in counts.items()):
        out[name] = min(range(parts), key=told.__getitem__)
        told[out[name]] += entropy(counts[name])
    return out


def part_of(dimension: tuple[str, int], dealt: dict, parts: int = PARTS) -> int:
    known = dealt.get(dimension)
    return zlib.crc32(f"{dimension[0]}{dimension[1]}".encode()) % parts if known is None else known


def _hashes(letters: str, dealt: dict, parts: int) -> list[int]:
    """A 64-bit hash of the dimensions in each part: equal dimensions give equal hashes."""
    own = [[] for _ in range(parts)]
    for dimension in dimensions(letters):
        own[part_of(dimension, dealt, parts)].append(f"{dimension[0]}{dimension[1]}")
    return [int.from_bytes(_digest("|".join(x)), "little") for x in own]


def _digest(text: str) -> bytes:
    import hashlib

    return hashlib.blake2b(text.encode(), digest_size=8).digest()


SAME, SHORT, LONG = 0, 1, 2


def signatures(letters: str, dealt: dict, parts: int = PARTS):
    """(hash, side, left out) of a multiset.

    SAME meets SAME of its length with two parts left out; SHORT meets LONG, which is one
    letter longer, with one part left out. Hashes of parts only have to agree where parts do:
    what meets is verified.
    """
    own, length = _hashes(letters, dealt, parts), len(letters)
    mask = (1 << 64) - 1
    multipliers = [(2 * i + 1) * 0x9E3779B97F4A7C15 & mask for i in range(parts)]
    total = sum(h * m for h, m in zip(own, multipliers))

    def mixed(rest: int, salt: int) -> int:
        x = (rest + salt * 0xD6E8FEB86659FD93) & mask
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & mask
        x ^= x >> 32
        return x - (1 << 64) if x >> 63 else x

    for number, (p, q) in enumerate(itertools.combinations(range(parts), 2)):
        yield mixed(total - own[p] * multipliers[p] - own[q] * multipliers[q], length * 1024 + number), SAME, p * parts + q
    for p in range(parts):
        rest = total - own[p] * multipliers[p]
        yield mixed(rest, length * 1024 + 512 + p), SHORT, p
        yield mixed(rest, (length - 1) * 1024 + 512 + p), LONG, p


def difference(a: str, b: str) -> tuple[list, list]:
    """Dimensions that only the first, and only the second, of two sorted words has."""
    left, right = set(dimensions(a)), set(dimensions(b))
    return list(left - right), list(right - left)


def agreed_signature(out: tuple, into: tuple, dealt: dict, parts: int) -> int:
    """The one signature, of those that two multisets of equal length share, at which they are verified."""
    p, q = sorted((part_of(out, dealt, parts), part_of(into, dealt, parts)))
    if p == q:
        p, q = (p, p + 1) if p + 1 < parts else (p - 1, p)
    return p * parts + q


def replaced(word: str, old: str, new: str):
    """The words that the word becomes when one letter `old` is replaced by `new` (empty: deleted)."""
    return {word[:i] + new + word[i + 1 :] for i, c in enumerate(word) if c == old}


def near_words(a: dict, b: dict, out: list, into: list):
    """Pairs of words at one edit, from the words of two close multisets.

    out: what only the first multiset has, into: what only the second has.
    """
    if out:  # a letter `out` becomes the letter `into`
        for word in a:
            for other in replaced(word, out[0][0], into[0][0]):
                if other in b:
                    yield word, other
    else:  # the second has the letter `into` besides
        for word in b:
            for other in replaced(word, into[0][0], ""):
                if other in a:
                    yield other, word


#: The words of a multiset with their numbers, all separated by spaces.
_CLASS = "letters string, words string"
_ROW = "hash bigint, side int, dropped int, " + _CLASS
_NEAR = "word string, n_near bigint, form_n bigint, form string"


def _spelled(text: str) -> dict[str, int]:
    parts = text.split(" ")
    return dict(zip(parts[::2], map(int, parts[1::2])))


def _signed(dealt: dict, parts: int):
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            letters = batch.column(0).to_pylist()
            made = [(i, *s) for i, own in enumerate(letters) for s in signatures(own, dealt, parts)]
            at, hashes, side, dropped = (pa.array(x, kind) for x, kind in zip(zip(*made), (pa.int64(), pa.int64(), pa.int32(), pa.int32())))
            for start in range(0, len(at), 8192):
                part = slice(start, start + 8192)
                rows = at[part]
                yield pa.RecordBatch.from_arrays([hashes[part], side[part], dropped[part], batch.column(0).take(rows), batch.column(1).take(rows)], names=["hash", "side", "dropped", "letters", "words"])

    return run


def _verified(dealt: dict, parts: int):
    """Per word: how many near words, and the best of them, of the pairs of a batch."""

    def run(batches):
        held_dimensions = functools.lru_cache(1 << 16)(lambda letters: frozenset(dimensions(letters)))
        for batch in batches:
            best: dict[str, list] = {}

            def note(word, other, n):
                held = best.get(word)
                if held is None:
                    best[word] = [1, n, other]
                    return
                held[0] += 1
                if n > held[1] or n == held[1] and other < held[2]:
                    held[1], held[2] = n, other

            rows = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("side", "dropped", "a_letters", "b_letters", "a_words", "b_words")))
            for side, dropped, a, b, a_words, b_words in rows:
                left, right = held_dimensions(a), held_dimensions(b)
                out, into = list(left - right), list(right - left)
                if side == SAME:
                    close = len(out) == len(into) == 1 and agreed_signature(out[0], into[0], dealt, parts) == dropped
                else:
                    close = not out and len(into) == 1
                if close:
                    a_counts, b_counts = _spelled(a_words), _spelled(b_words)
                    for x, y in near_words(a_counts, b_counts, out, into):
                        note(x, y, b_counts[y])
                        note(y, x, a_counts[x])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.string()), *(pa.array([v[i] for v in best.values()], kind) for i, kind in ((0, pa.int64()), (1, pa.int64()), (2, pa.string())))],
                names=["word", "n_near", "form_n", "form"],
            )

    return run


def near(counted: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, n_near, form, form_n) of words (word, n): how many are at one edit, and the most frequent of these.

    Runs jobs; words without a near word are not in the result.
    """
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    lettered = counted.withColumn("letters", letters)
    large = cut(lettered.groupBy("letters").count().filter(F.col("count") > CLASS_WORDS), "large-classes")
    dealt_rows = F.coalesce(F.ceil(F.col("count") / CLASS_WORDS), F.lit(1))
    split = lettered.join(large, "letters", "left").withColumn("row", F.pmod(F.xxhash64("word"), dealt_rows))
    classes = cut(split.groupBy("letters", "row").agg(F.array_join(F.collect_list(F.concat_ws(" ", "word", "n")), " ").alias("words")).drop("row"), "letter-classes")
    copies = classes.select("letters", F.explode(F.split("letters", "")).alias("letter")).filter("letter <> ''")
    held = copies.groupBy("letters", "letter").count()
    per_copy = held.select("letter", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count"))).alias("k")).groupBy("letter", "k").count()
    top = per_copy.orderBy(F.col("count").desc(), "letter", "k").limit(MOST_DIMENSIONS).collect()
    dealt = balanced({(r.letter, r.k - 1): r["count"] for r in top}, classes.count(), parts)
    signed = cut(classes.mapInArrow(_signed(dealt, parts), _ROW), "signatures")
    a = signed.select("hash", "side", "dropped", F.col("letters").alias("a_letters"), F.col("words").alias("a_words"))
    b = signed.select(F.col("hash").alias("b_hash"), F.col("side").alias("b_side"), F.col("letters").alias("b_letters"), F.col("words").alias("b_words"))
    same = (F.col("side") == SAME) & (F.col("b_side") == SAME) & (F.col("a_letters") < F.col("b_letters"))
    longer = (F.col("side") == SHORT) & (F.col("b_side") == LONG)
    # Two sorted words at distance two or less differ by two edits at most.
    close = F.levenshtein("a_letters", "b_letters", 2) >= 0
    met = a.join(b, (F.col("hash") == F.col("b_hash")) & (same | longer) & close)
    partial = met.select("side", "dropped", "a_letters", "b_letters", "a_words", "b_words").mapInArrow(_verified(dealt, parts), _NEAR)
    first = F.min(F.struct((-F.col("form_n")).alias("minus"), "form"))
    best = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("best"))
    return best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) that lead from rarer to more frequent words: the last form.

    Each round doubles the steps taken; counts rise tenfold a step or so, which bounds the rounds.
    """
    at = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("from"), F.col("root").alias("to"))
        moved = cut(at.join(step, at.root == step["from"], "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(
    docs: DataFrame, shortest: int = 7, fewest: int = 2, ratio: int = 10, id_column: str = "doc_id", text: str = "text", parts: int = PARTS
) -> DataFrame:
    """Words of the texts with their form: (word, form, root, n, n_near, form_n).

    form: the most frequent near word if it occurs `ratio` times as often as the word; root:
    the last word that forms lead to. Runs jobs.
    """
    if ratio < 2:
        raise ValueError("forms must occur more often than their variants")
    counted = cut(words(docs, shortest, fewest, id_column, text), "words")
    known = near(counted, parts)
    joined = counted.join(known, "word", "left").withColumn("formed", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    result = cut(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("formed"), F.col("form")).alias("form"), F.when(F.col("formed"), F.col("form_n")).alias("form_n")
        ),
        "variants",
    )
    rooted = roots(result.filter("form is not null"))
    return result.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
