"""Column functions on literal values; expected results are worked out by hand or by plain Python."""

import datetime
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom.functions import batches, dates, prompts, text, urls, vectors
from tests.helpers import values

_FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_strip(spark):
    data = [" a b\t", "　가 \xa0", " \n", "", "\x1fx\x85", None]
    assert values(spark, data, text.strip) == [s if s is None else s.strip() for s in data]


def test_whitespace_is_complete():
    assert set(fv.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_normalise(spark):
    data = ["Hello, World_1!", "안녕 하세요!", "É_é", "²½", "", None]
    assert values(spark, data, text.normalise) == ["helloworld1", "안녕하세요", "éé", "²½", "", None]


# Letters that are younger than the JVM are none to it.
_KNOWN = st.characters().filter(lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn")


@_FEW
@given(st.lists(st.text(_KNOWN, max_size=30), min_size=1, max_size=40))
def test_normalise_and_strip_follow_python(spark, data):
    data = [s for s in data if "\ud800" not in s]
    expected = [re.sub(r"[\W_]+", "", s).lower() for s in data]
    assert values(spark, data, text.normalise) == expected
    assert values(spark, expected, text.normalise) == [re.sub(r"[\W_]+", "", s).lower() for s in expected]
    assert values(spark, data, text.strip) == [s.strip() for s in data]


@pytest.mark.parametrize(
    "phrases, said, hit",
    [
        (["like"], "unLIKEly", True),
        (["알림 설정"], "알림설정 해요", True),
        (["알림설정"], "알림, 설정", True),
        (["???"], "what?", False),
        (["???"], "what???", True),
        (["???"], "plain", False),
        ([], "anything", False),
        (["구독"], None, False),
        (["구독"], "", False),
        (["함께", "공유"], "공유 함", True),
        (["함께공유"], "공유 함", False),
    ],
)
def test_stop_phrases(spark, phrases, said, hit):
    assert values(spark, [said], lambda c: text.has_stop_phrase(c, phrases)) == [hit]


ECHO = [
    ("no marker. Here.", "no marker. Here."),
    ("intro ### 요약: One. Two! ", "One. Two!"),
    ("### 요약: a ### 요약: b", "a"),
    ("### 답변: gone\nkept.", "kept."),
    ("### 답변\nswallowed\nkept.", "kept."),
    ("system: all of it\nand this", ""),
    ("Kept.\n user  rest\nlost. Lost.", "Kept."),
    ("first.\n사용user 가", "first. 사용user 가"),
    ("first.\n가user said", "first. 가user said"),
    ("a <|im_start|>x\ny<|im_end|>b. c?", "a b. c?"),
    ("1. 2. 3. 4. 5. 6. 7.", "1. 2. 3. 4. 5. 6. 7."),
    ("1. 2. 3. 4. 5. 6. 7. 8.", "1. 2. 3. 4. 5. 6. 7."),
    ("no end", "no end"),
    ("one.　two", "one. two"),
    ("", ""),
    (None, None),
]


def test_strip_echo(spark):
    assert values(spark, [a for a, _ in ECHO], text.strip_echo) == [b for _, b in ECHO]


def test_second_pass_sees_what_the_first_bared(spark):
    raw = ["<|im_start|>x<|im_end|>user gone. Kept?"]
    once = values(spark, raw, text.strip_echo)
    assert once == ["user gone. Kept?"]
    assert values(spark, once, text.strip_echo) == [""]


def test_parse_compact_date(spark):
    data = ["20250711", "2025711", "20250231", "2000-01-01", "20000101", "00000101", "202507110", "", None, "2025111"]
    expected = ["2025-07-11", "2025-07-11", None, None, "2000-01-01", None, None, None, None, "2025-11-01"]
    assert values(spark, data, dates.parse_compact_date) == expected


def test_midpoint(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (10.0, 4.0), (1.0, 3.0), (-5.0, -4.0)], "s double, e double")
    got = [r[0] for r in frame.select(dates.midpoint(F.col("s"), F.col("e"))).collect()]
    assert got == [0.2, 10.2, 2.0, 0.2]


def test_time_of_day(spark):
    data = [0.0, 5.5, 86400.25, 3661.0000004, 59.9999996, -0.5, 0.0000005, 0.0000015, 1e9 + 0.125]
    utc = [datetime.datetime.fromtimestamp(s, datetime.UTC).time() for s in data]
    assert values(spark, data, dates.time_of_day, "double") == [str(t) for t in utc]
    assert values(spark, [None], dates.time_of_day, "double") == [None]


@_FEW
@given(st.lists(st.floats(min_value=-1e7, max_value=4e9), min_size=1, max_size=60))
def test_time_of_day_follows_python(spark, data):
    utc = [str(datetime.datetime.fromtimestamp(s, datetime.UTC).time()) for s in data]
    assert values(spark, data, dates.time_of_day, "double") == utc


def test_since(spark):
    data = ["2025-07-04", "2025-07-03", "2026-01-01", None, "soon"]
    got = values(spark, data, lambda c: dates.since(c, F.to_date(F.lit("2025-07-11"))))
    assert [bool(g) for g in got] == [True, False, True, False, False]


EMBED = [
    ("https://youtu.be/abc?t=1", "https://www.youtube.com/embed/abc"),
    ("https://www.youtube.com/watch?v=abc&list=1", "https://www.youtube.com/embed/abc"),
    ("https://www.youtube.com/watch?list=1&v=a%2Bb+c", "https://www.youtube.com/embed/a+b c"),
    ("https://www.youtube.com/watch?list=1", ""),
    ("https://example.com/#v=1", ""),
    ("https://example.com/?vv=1&xv=2", ""),
    ("HTTPS://YOUTU.BE/abc", "https://www.youtube.com/embed/abc"),
    ("https://youtu.be", ""),
    ("https://www.youtube.com/watch?v=%zz", "https://www.youtube.com/embed/%zz"),
    ("https://www.youtube.com/watch?q=가 나&v=x", "https://www.youtube.com/embed/x"),
    ("not a url", ""),
    ("", ""),
    (None, ""),
]


def test_embed_url(spark):
    assert values(spark, [a for a, _ in EMBED], urls.embed_url) == [b for _, b in EMBED]


def test_paths(spark):
    assert values(spark, ["v1", None], lambda c: urls.image_path("d/", c, F.lit(3))) == ["d/v1/3.jpg", None]
    assert values(spark, ["v1", None], urls.video_url) == ["https://youtu.be/v1", None]


def test_prompts(spark):
    plain = values(spark, ["가나다"], lambda c: prompts.render(c, "S", "I: ", max_chars=2))
    assert plain == ["SYSTEM: S\nUSER: I: 가나"]
    template = prompts.ChatTemplate("[{role}|{content}]", "[assistant|")
    assert values(spark, ["x"], lambda c: prompts.render(c, "S", "I ", template)) == ["[system|S][user|I x][assistant|"]


TEXTS = ["[1, 2.5]", "[1, null]", "[1, NaN]", "(1, 2)", "7", "[]", "[[1]]", "x", "", None, "[1e400]", "[0.0]"]
PARSED = [[1.0, 2.5]] + [None] * 10 + [[0.0]]


def test_parse_vector_text(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, emb string")
    got = frame.orderBy("i").select(batches.usable(vectors.as_array(frame, "emb"))).collect()
    assert [r[0] for r in got] == PARSED


def test_parse_vector_types(spark):
    frame = spark.sql(
        "select array(1f, 2f) f, array(1, 2) i, array(1.5d, double('nan')) n, array(1d, null) x, 3 s, cast(array() as array<double>) e"
    )
    got = frame.select(*[batches.usable(vectors.as_array(frame, c)).alias(c) for c in frame.columns]).first()
    assert list(got) == [[1.0, 2.0], [1.0, 2.0], None, None, None, None]


@_FEW
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=5), min_size=1, max_size=20))
def test_vector_survives_json(spark, data):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v array<double>")
    stored = frame.select("i", vectors.to_json_text(F.col("v")).alias("v"))
    got = stored.orderBy("i").select(batches.usable(vectors.as_array(stored, "v"))).collect()
    assert [r[0] for r in got] == data


def test_json_of_odd_vectors(spark):
    frame = spark.sql("select array(double('nan'), 1d) a, cast(null as array<double>) b")
    assert tuple(frame.select(vectors.to_json_text(F.col("a")), vectors.to_json_text(F.col("b"))).first()) == ('["NaN",1.0]', None)


def test_unit(spark):
    frame = spark.sql("select array(3f, 4f) a, array(0d, 0d) z, cast(array() as array<double>) e, array(1d, null) x")
    assert list(frame.select(*[batches.unit(c) for c in "azex"]).first()) == [[0.6, 0.8], [0.0, 0.0], None, None]
