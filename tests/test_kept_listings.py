"""Listings and title indexes that are kept up to date, searched with and without wildcards."""

import glob
import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from chunkloom.functions import folding
from chunkloom.operators import listing_state, serving, title_index
from chunkloom.plans import listings
from tests.helpers import rows, values

CHUNK = "video_id string, title string, upload_date string"


def spoil(path, keep):
    """Overwrite all data files but those in the folders to keep, so that opening one is an error."""
    spoilt = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        if not any(part in name for part in keep):
            with open(name, "wb") as file:
                file.write(b"not parquet")
            crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
            spoilt += 1
    return spoilt


def plainly(title, q):
    """The search in plain Python: letters without accents and case, % and _ as wildcards."""
    out, letters = "", iter(folding.fold_literal(q))
    for c in letters:
        if c == "\\":
            out += re.escape(next(letters, "\\"))
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
    return re.search(f"^.*{out}.*$", folding.fold_literal(title), re.DOTALL) is not None


def test_folding():
    assert folding.fold_literal("ÀÉõ Ü ς Σ ẞß K é 가 Å ﬁ İ") == "aeo u σ σ ßß k e 가 a ﬁ i"


def test_folding_in_spark_and_python_agree(spark):
    texts = ["".join(chr(c) for c in range(start, start + 64)) for start in range(0x20, 0x3000, 64)]
    assert values(spark, texts, folding.fold) == [folding.fold_literal(t) for t in texts]


def test_searches_without_accents(spark):
    rnd = random.Random(5)
    titles = ["".join(rnd.choice("aáÁbBçC%_\\ é") for _ in range(rnd.randint(0, 8))) for _ in range(300)]
    for _ in range(25):
        q = "".join(rnd.choice(["á", "A", "b", "Ç", "%", "_", "\\%", "\\_", "\\\\"]) for _ in range(rnd.randint(1, 4)))
        got = values(spark, titles, lambda c: serving.title_matches(c, q, "UNICODE_CI_AI"))
        assert got == [plainly(t, q) for t in titles], q


def test_unknown_collation(spark):
    with pytest.raises(ValueError):
        serving.title_matches(F.col("title"), "a", "UNICODE")


def test_literal_pieces():
    assert serving.literal_pieces("ab%c_\\%d\\\\%%e\\f") == ["ab", "c", "%d\\", "ef"]
    assert serving.literal_pieces("%_") == [] and serving.literal_pieces("a\\") == ["a\\"]


@pytest.fixture(scope="module")
def chunks(spark):
    rnd = random.Random(6)
    out = []
    for i in range(400):
        title = " ".join(rnd.choice(["Rote", "Café", "naïve", "100%", "ab", "Straße", "x"]) for _ in range(rnd.randint(0, 4)))
        for _ in range(3):
            date = rnd.choice([None, "soon", f"20{rnd.randint(10, 25)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}"]) if i % 9 == 0 else f"20{rnd.randint(10, 25)}-0{rnd.randint(1, 9)}-11"
            out.append((f"v{i}", title if rnd.random() < 0.9 else f"{title} new", date))
    return spark.createDataFrame(out, CHUNK)


@pytest.fixture(scope="module")
def summaries(chunks):
    return chunks.filter("video_id not like '%3'").select("video_id").distinct()


@pytest.fixture(scope="module")
def kept(spark, chunks, tmp_path_factory):
    folder = tmp_path_factory.mktemp("kept")
    state, index = str(folder / "state"), str(folder / "index")
    for part in range(3):
        listings.keep_listing(chunks.filter(F.pmod(F.xxhash64("video_id", "upload_date"), F.lit(3)) == part), state, index)
    listings.keep_listing(chunks.limit(50), state, index)  # once more
    return state, index


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_kept_listing_equals_the_whole(spark, chunks, summaries, kept, tmp_path):
    state, _ = kept
    assert rows(listing_state.read(spark, state)) == rows(serving.latest_per_title(chunks))
    for n in (1, 5, 24, 10_000):
        assert listed(listings.kept_catalogue(spark, state, summaries, n)) == listed(listings.catalogue(chunks, summaries, n))
    listing_state.compact(spark, state, str(tmp_path / "small"))
    assert rows(listing_state.read(spark, str(tmp_path / "small"))) == rows(serving.latest_per_title(chunks))


def test_newest_reads_only_the_newest_months(spark, chunks, summaries, tmp_path):
    state = str(tmp_path / "state")
    dated = chunks.filter("upload_date <> 'soon'")
    listing_state.append(dated, state)
    want = listed(listings.catalogue(dated, summaries, 3))
    months = sorted((os.path.basename(m).removeprefix("month=") for m in glob.glob(f"{state}/month=2*")), reverse=True)
    read = 2 ** (months.index(want[-1][2][:7]) + 1).bit_length()
    assert spoil(state, [f"month={m}" for m in months[:read]]) > len(months) / 2
    assert listed(listings.kept_catalogue(spark, state, summaries, 3)) == want


@pytest.mark.parametrize(
    "q, collation",
    [("Caf", None), ("caf", None), ("cafE", "UNICODE_CI_AI"), ("rote%AB", "UTF8_LCASE"), ("0\\% x", None), ("n_ive", "UNICODE_CI_AI"),
     ("b", None), ("", None), ("STRAßE", "UNICODE_CI_AI"), ("ew%", None), ("zzz", None)],
)
def test_indexed_search_equals_the_scan(spark, chunks, summaries, kept, q, collation):
    got = listings.kept_search(spark, *kept, summaries, q, 40, collation)
    assert listed(got) == listed(listings.search(chunks, summaries, q, 40, collation))


def test_search_opens_only_the_folders_of_its_runs(spark, kept, tmp_path):
    index = str(shutil.copytree(kept[1], tmp_path / "index"))
    want = rows(title_index.matching(spark, index, "Straße"))
    needed = spark.range(1).select(*[title_index._bucket(F.lit(r)).alias(r) for r in title_index.runs_of("Straße")]).first()
    files = len(glob.glob(f"{index}/**/*.parquet", recursive=True))
    assert spoil(index, {f"bucket={b}/" for b in needed}) > files / 2
    assert want and rows(title_index.matching(spark, index, "Straße")) == want


def test_titles_are_indexed_once(spark, kept):
    _, index = kept
    found = title_index.titles(spark, index)
    assert found.count() == found.distinct().count()


def test_nothing_kept_yet(spark, tmp_path, summaries):
    state, index = str(tmp_path / "s"), str(tmp_path / "i")
    listings.keep_listing(spark.createDataFrame([], CHUNK), state, index)
    assert listed(listings.kept_search(spark, state, index, summaries, "abc")) == []


def test_new_chunks_are_read_once(spark, chunks, tmp_path, monkeypatch):
    given = []
    for module in (listing_state, title_index):
        monkeypatch.setattr(module, "append", lambda listing, path: given.append(listing))
    listings.keep_listing(chunks.join(spark.range(1).select(F.lit(1).alias("one"))), str(tmp_path / "s"), str(tmp_path / "i"))
    assert len(given) == 2 and not any("Join" in df._jdf.queryExecution().toString() for df in given)
    assert given[0].count() == chunks.select("video_id", "title").distinct().count()
