"""Listing queries and summaries."""

import re

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.operators import serving
from chunkloom.operators.summaries import summarise
from chunkloom.plans import listings
from chunkloom.plans.summarise import summarise_videos
from tests.helpers import plan, rows

CHUNK = "video_id string, title string, upload_date string"
SUMMARY = "video_id string, summary_text string, video_url string"


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(
        [
            ("a", "Red Café", "2025-07-11"),
            ("a", "Red Café", "2025-07-11"),
            ("b", "green", "2025-07-04"),
            ("b", "renamed", "2025-07-03"),
            ("c", "100% cotton", "2026-01-01"),
            ("d", "unknown date", None),
            ("e", "no summary", "2025-07-11"),
            ("f", "old", "2020-01-01"),
            ("f", "old", "2020-03-01"),
        ],
        CHUNK,
    )


@pytest.fixture(scope="module")
def summaries(spark):
    return spark.createDataFrame(
        [(v, f"about {v}", f"https://youtu.be/{v}") for v in "aabcdfx"], SUMMARY
    )


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_recent(chunks, summaries):
    assert listed(listings.recent(chunks, summaries, "2025-07-11")) == [
        ("c", "100% cotton", "2026-01-01"), ("a", "Red Café", "2025-07-11"), ("b", "green", "2025-07-04")
    ]
    assert len(listed(listings.recent(chunks, summaries, "2025-07-11", n=1))) == 1
    assert listings.recent(chunks, summaries).columns == ["video_id", "title", "upload_date"]


def test_catalogue(chunks, summaries):
    assert listed(listings.catalogue(chunks, summaries)) == [
        ("c", "100% cotton", "2026-01-01"),
        ("a", "Red Café", "2025-07-11"),
        ("b", "green", "2025-07-04"),
        ("b", "renamed", "2025-07-03"),
        ("f", "old", "2020-03-01"),
        ("d", "unknown date", None),
    ]
    assert [r[0] for r in listed(listings.catalogue(chunks, summaries, n=2))] == ["c", "a"]


@pytest.mark.parametrize(
    "q, collation, videos",
    [
        ("re", None, "bb"),
        ("", None, "cabbfd"),
        ("%", None, "cabbfd"),
        ("r%d", None, "b"),
        ("1_0", None, "c"),
        ("0\\%", None, "c"),
        ("\\gre", None, "b"),
        ("CAFE", None, ""),
        ("RED", "UTF8_LCASE", "a"),
        ("cafe", "UNICODE_CI_AI", "a"),
    ],
)
def test_search(chunks, summaries, q, collation, videos):
    found = listings.search(chunks, summaries, q, collation=collation)
    assert "".join(r[0] for r in listed(found)) == videos


def test_summary_of(summaries):
    assert listed(listings.summary_of(summaries, "b")) == [
        ("about b", "https://youtu.be/b", "https://www.youtube.com/embed/b")
    ]
    assert listed(listings.summary_of(summaries, "a")) == listed(listings.summary_of(summaries, "a"))[:1]
    assert listed(listings.summary_of(summaries, "nobody")) == []


def test_listing_plans(spark, tmp_path, chunks, summaries):
    chunks.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    found = plan(listings.search(stored, summaries, "red"))
    assert "StringContains(title,red)" in found
    assert "TakeOrderedAndProject" in found and "HashAggregate" in found and "SortAggregate" not in found
    assert "GreaterThanOrEqual(upload_date,2025-07-04)" in plan(listings.recent(stored, summaries, "2025-07-11"))


CHUNKS = "video_id string, chunk_id int, text string, emb string"


def test_summarise_videos(spark):
    chunks = spark.createDataFrame(
        [
            ("v", 1, "One.", "[1, 0]"),
            ("v", 2, "Two!", "[1, 0.1]"),
            ("v", 3, "Far away.", "[-1, 0]"),
            ("blank", 1, " ", "[1, 0]"),
            (None, 1, "Nobody's.", None),
        ],
        CHUNKS,
    )
    assert rows(summarise_videos(chunks, top_k=2).summaries) == [
        ("blank", "(내용 없음)", "https://youtu.be/blank"),
        ("v", "One. Two!", "https://youtu.be/v"),
        (None, "Nobody's.", None),
    ]


def test_summarise_videos_with_model(spark):
    @F.pandas_udf("string")
    def model(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: f"{len(p)} characters. Done.")

    chunks = spark.createDataFrame([("v", 1, "One.", None), ("w", 1, "Two!", None)], CHUNKS)
    made = summarise_videos(chunks, model=model, tasks=2, system="", instruction="").summaries
    text = f"{len('SYSTEM: \nUSER: One.')} characters. Done."
    assert rows(made) == [("v", text, "https://youtu.be/v"), ("w", text, "https://youtu.be/w")]


def test_summarise_needs_its_columns(spark):
    with pytest.raises(ValueError, match="chunk_id"):
        summarise_videos(spark.createDataFrame([("v", "t")], "video_id string, text string"))


def test_model_sees_prompts(spark):
    @F.pandas_udf("string")
    def model(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: None if p is None else "### 요약: Seen " + p.replace("\n", " ") + "\nassistant: x")

    contexts = spark.createDataFrame([("v", "Text."), ("b", " ")], "video_id string, context string")
    got = rows(summarise(contexts, model, system="S.", instruction="Do. "))
    assert got == [
        ("b", "(내용 없음)", "https://youtu.be/b"),
        ("v", "Seen SYSTEM: S. USER: Do. Text.", "https://youtu.be/v"),
    ]


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="\\%_a", max_size=6))
def test_search_never_fails(spark, q):
    """Any text can be searched for; it matches as a database's LIKE does."""
    titles = ["a", "", "\\", "%", "_a", "a\\%", "\\\\_"]
    frame = spark.createDataFrame([(t,) for t in titles], "title string")
    got = {r.title for r in frame.filter(serving.title_matches(F.col("title"), q)).collect()}
    tokens = re.findall(r"\\.|.", f"%{q}%", re.DOTALL)
    want = re.compile("".join(".*" if t == "%" else "." if t == "_" else re.escape(t[-1]) for t in tokens), re.DOTALL)
    assert got == {t for t in titles if want.fullmatch(t)}


def test_latest_per_title_keeps_texts_that_are_no_dates(spark):
    rows_in = [("v", "t", "2025"), ("v", "t", "2024-01-01"), ("w", "t", "soon"), ("w", "t", "2024-01-01"), ("x", "t", None), ("y", "t", "2024-02-01"), ("y", "t", "2024-01-31")]
    got = serving.latest_per_title(spark.createDataFrame(rows_in, "video_id string, title string, upload_date string"))
    assert {r.video_id: r.upload_date for r in got.collect()} == {"v": "2025", "w": "soon", "x": None, "y": "2024-02-01"}


def test_videos_are_summaries_or_rejects(spark):
    chunks = spark.createDataFrame([("v", 1, "One.", "[1, 0]"), ("v", 2, "Two.", "[1]"), ("w", 1, "Three.", "[1]"), (None, 1, "Four.", None)], CHUNKS)
    made = summarise_videos(chunks)
    assert [r.video_id for r in made.rejects.collect()] == ["v"]
    assert {r.video_id for r in made.summaries.collect()} == {"w", None}
