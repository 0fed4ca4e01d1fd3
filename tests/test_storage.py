"""Readers and writers on scratch folders."""

import json

import pytest
from pyspark.sql import functions as F

from chunkloom import schemas
from chunkloom.__main__ import main
from chunkloom.plans.export import export_chunks
from chunkloom.session import scratch_path
from chunkloom.sources import database, readers, writers
from querybook import storage
from tests.helpers import rows

ROWS = [("007", 1, 'a "quoted"\nline'), ("v", 2, None)]
SCHEMA = "video_id string, chunk_id int, text string"


def test_load_any_parquet(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("folder", "x.parquet", "x.PARQUET"):
        frame.write.parquet(str(tmp_path / name))
        assert rows(readers.load_any(spark, f"  '{tmp_path}/./{name}/' ")) == rows(frame)
    assert rows(readers.load_any(spark, f"file://{tmp_path}/folder")) == rows(frame)


def test_load_any_json(spark, tmp_path):
    records = [{"video_id": v, "chunk_id": c, "text": t} for v, c, t in ROWS]
    (tmp_path / "lines.json").write_text("\n" + "\n".join(json.dumps(r) for r in records))
    (tmp_path / "array.JSON").write_text("\n [" + ",\n".join(json.dumps(r) for r in records) + "]")
    (tmp_path / "pretty.json").write_text(json.dumps(records, indent=2, ensure_ascii=False))
    for name in ("lines.json", "array.JSON", "pretty.json"):
        loaded = readers.load_any(spark, f'"{tmp_path / name}"')
        assert rows(loaded.select("video_id", "chunk_id", "text")) == sorted(ROWS, key=repr)
        typed = readers.load_any(spark, str(tmp_path / name), schemas.CHUNKS)
        assert typed.schema.fieldNames() == schemas.CHUNKS.fieldNames() and typed.count() == 2


def test_load_any_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('video_id,chunk_id,text,embedding\nv,1,"a ""b""\nc","[1, 2]"\nw,2,,\n')
    assert rows(readers.load_any(spark, str(tmp_path / "x.csv"))) == [("v", 1, 'a "b"\nc', "[1, 2]"), ("w", 2, None, None)]


@pytest.mark.parametrize("arrays_larger", [True, False])
def test_json_layout_is_told_by_file(spark, tmp_path, arrays_larger):
    folder = tmp_path / "mixed"
    folder.mkdir()
    n = (40, 3) if arrays_larger else (3, 40)
    (folder / "a.json").write_text(json.dumps([{"video_id": "a", "chunk_id": i} for i in range(n[0])], indent=1))
    (folder / "b.json").write_text("\n".join(json.dumps({"video_id": "b", "text": "[x"}) for _ in range(n[1])))
    loaded = readers.load_any(spark, f"{folder}/*.json")
    assert {r["video_id"]: r["count"] for r in loaded.groupBy("video_id").count().collect()} == {"a": n[0], "b": n[1]}


@pytest.mark.parametrize(
    "name, content",
    [
        ("x.json", '{"video_id": "v"}\n{"video_id": "w", "te'),
        ("y.json", '[{"video_id": "v"}, {"video_id": "w"'),
        ("z.csv", "video_id,chunk_id\nv,1\nw\n"),
        ("q.csv", "video_id,chunk_id\nv,1,2\n"),
    ],
)
@pytest.mark.parametrize("schema", [None, "video_id string, chunk_id int"])
def test_broken_records_end_the_run(spark, tmp_path, name, content, schema):
    from pyspark.sql.types import _parse_datatype_string

    (tmp_path / name).write_text(content)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|corrupt"):
        readers.load_any(spark, str(tmp_path / name), _parse_datatype_string(schema) if schema else None).collect()


def test_folders_are_parquet_whatever_their_name(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    frame.write.parquet(str(tmp_path / "chunks.v2"))
    for path in (f"file://{tmp_path}/chunks.v2", f"{tmp_path}/chunks.v2", f'\' {tmp_path}/chunks.v2/ \''):
        assert rows(readers.load_any(spark, path)) == rows(frame)


def test_csv_in_several_tasks(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n" + "1,2\n" * 50)
    assert readers.load_any(spark, str(tmp_path / "x.csv"), multi_line=False).count() == 50


def test_load_any_other(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        readers.load_any(spark, str(tmp_path / "x.xlsx"))


def write_segment_files(folder):
    folder.mkdir()
    good = [{"id": 0, "start": 0.0, "end": 1.5, "text": "가", "tokens": [1]}, {"id": 1, "start": "x", "end": 2, "text": None}]
    (folder / "a_b_segments.json").write_text(json.dumps(good, ensure_ascii=False, indent=2), encoding="utf-8")
    (folder / "empty_segments.json").write_text("[]")
    (folder / "broken_segments.json").write_text("[{")
    (folder / "other.json").write_text("[{}]")


def test_segment_files(spark, tmp_path):
    write_segment_files(tmp_path / "s")
    read = readers.read_segment_files(spark, str(tmp_path / "s"))
    assert rows(read.filter("not broken").drop("broken")) == [("a_b", "0", "0.0", "1.5", "가"), ("a_b", "1", "x", "2", None)]
    assert [r.video_id for r in read.filter("broken").collect()] == ["broken"]


def test_segment_store(spark, tmp_path):
    frame = spark.createDataFrame([("007", "0", "0.0", "1.5", "가")], "video_id string, id string, start string, end string, text string")
    writers.write_segments(frame, str(tmp_path / "s"))
    assert rows(readers.read_segments(spark, str(tmp_path / "s"))) == rows(frame)


def test_listing(spark, tmp_path):
    listing = {"entries": [{"id": "a", "title": "T", "upload_date": "20250711", "x": 1}, None, {"id": "b"}]}
    (tmp_path / "l.json").write_text(json.dumps(listing))
    read = readers.read_listing(spark, str(tmp_path / "l.json")).filter("id is not null")
    assert rows(read) == [("a", "T", "20250711"), ("b", None, None)]


def write_images(folder):
    (folder / "v").mkdir(parents=True)
    for name in ("1.jpg", "x.jpg", "2.png"):
        (folder / "v" / name).write_bytes(b"x")


def test_images(spark, tmp_path):
    write_images(tmp_path / "img")
    folder = str(tmp_path / "img")
    assert rows(readers.list_images(spark, folder)) == [("v", 1, f"{folder}/v/1.jpg")]


SUMMARY = "video_id string, summary_text string, video_url string"


@pytest.mark.parametrize("buckets", [None, 3])
def test_summary_rerun(spark, tmp_path, buckets):
    path = str(tmp_path / "s")
    first = [("007", "old", "u"), ("v/1", "old", "u"), (None, "old", None)] + [(f"x{i}", "old", "u") for i in range(20)]
    writers.write_summaries(spark.createDataFrame(first, SUMMARY), path, buckets)
    again = [("007", "new", "u"), ("added", "new", "u"), (None, "new", None)]
    for _ in range(2):
        writers.write_summaries(spark.createDataFrame(again, SUMMARY), path, buckets)
        expected = again + [r for r in first if r[0] not in ("007", None)]
        assert rows(readers.read_summaries(spark, path)) == sorted(expected, key=repr)


def test_export_without_database(spark, tmp_path):
    source, target = str(tmp_path / "c"), str(tmp_path / "d")
    chunks = spark.createDataFrame([("v", "1", [1.0])], "video_id string, chunk_id string, embedding array<double>")
    empty = {name: F.lit(None) for name in schemas.CHUNKS.fieldNames() if name not in chunks.columns}
    writers.write_chunks(chunks.withColumns(empty), source)
    writers.write_chunks(chunks.withColumns(empty), source)
    export_chunks(spark, source, target)
    export_chunks(spark, source, target)
    stored = database.to_relational(readers.read_chunks(spark, target))
    assert [(r.video_id, r.chunk_id, r.embedding) for r in stored.collect()] == [("v", 1, "[1.0]")]
    assert stored.columns == schemas.CHUNKS.fieldNames()
    assert database.without_existing(stored, stored).count() == 0


def test_database_options():
    assert database.write_options("jdbc:x", "t", user="u", isolation="NONE", connections=4) == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "batchsize": "1000",
        "isolationLevel": "NONE", "numPartitions": "4",
    }
    assert database.write_options("jdbc:x", "t")["isolationLevel"] == "READ_COMMITTED"


def test_scratch_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root + "/x-") and first != second


def test_command_line(spark, tmp_path, capsys):
    write_segment_files(tmp_path / "s")
    write_images(tmp_path / "img")
    (tmp_path / "l.json").write_text(json.dumps({"entries": [{"id": "a_b", "title": "T", "upload_date": "20250711"}]}))
    (tmp_path / "stop.txt").write_text("나\n")
    at = lambda name: str(tmp_path / name)
    main(["build", "--listing", at("l.json"), "--segments", at("s"), "--images", at("img"), "--phrases", at("stop.txt"),
          "--output", at("chunks"), "--rejects", at("rejects"), "--resume"])  # on the first day nothing is there
    main(["export", "--input", at("chunks"), "--copy-to", at("copy")])
    main(["summarise", "--input", at("copy"), "--output", at("summaries"), "--top-k", "3"])
    assert rows(readers.read_summaries(spark, at("summaries"))) == [("a_b", "가", "https://youtu.be/a_b")]
    assert [r.video_id for r in spark.read.parquet(at("rejects")).collect()] == ["broken"]
    again = ["build", "--listing", at("l.json"), "--segments", at("s"), "--images", at("img"), "--output", at("chunks"), "--resume"]
    before = readers.read_chunks(spark, at("chunks")).count()
    main(again)
    assert readers.read_chunks(spark, at("chunks")).count() == before
    main(["summarise", "--input", at("copy"), "--output", at("summaries"), "--resume", "--rejects", at("unfit"), "--chat-turn", "{role}:{content}"])
    assert readers.read_summaries(spark, at("summaries")).count() == 1 and spark.read.parquet(at("unfit")).count() == 0
    for job in (["recent", "--as-of", "2025-07-12"], ["search", "--q", "T"]):
        main([*job, "--chunks", at("copy"), "--summaries", at("summaries")])
        assert "2025-07-11" in capsys.readouterr().out
    main(["summary", "--summaries", at("summaries"), "--video-id", "a_b"])
    assert "embed/a_b" in capsys.readouterr().out


def conversation_table(spark, folder, turns):
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    frame.write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_arrays_of_the_scans_hold_so_many_records(spark, tmp_path):
    """Neither a file for each video nor an array that grows with the table."""
    folder = conversation_table(spark, tmp_path, [(i, i % 5, "user", f"text {i}") for i in range(16_000)])
    for larger, most in ((True, 5000), (False, 500)):
        files = spark.read.text(storage._mixed_files(spark, folder, larger).replace("/*/", "/arrays/"), wholetext=True)
        sizes = [len(json.loads(r.value)) for r in files.collect()]
        assert sum(sizes) == 8000 and len(sizes) == -(-8000 // most) and max(sizes) < 2 * most
    found = storage.json_mixed_scan(spark, folder)
    assert found.groupBy("larger").agg(F.count("*"), F.countDistinct("video_id", "turn", "text")).orderBy("larger").collect() == [
        ("arrays", 16_000, 16_000),
        ("lines", 16_000, 16_000),
    ]


def test_listings_of_the_scan_hold_so_many_entries(spark, tmp_path, monkeypatch):
    frame = spark.range(12_000).selectExpr(
        "id * 1000 as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "1D as o_totalprice",
        "timestamp_ntz'2024-05-06 00:00:00' as o_orderdate", "'x' as o_orderpriority",
    )
    frame.write.parquet(str(tmp_path / "orders.parquet"))
    written = []
    monkeypatch.setattr(storage, "scratch_path", lambda spark, name: written.append(str(tmp_path / name)) or written[-1])
    found = storage.listing_scan(spark, str(tmp_path))
    assert found.count() == found.distinct().count() == 12_000
    assert found.agg(F.min("upload_date"), F.max("id")).first() == ("20240506", "9999000")
    assert spark.read.text(written[0]).count() == 3


def test_segments_of_many_videos_lie_in_few_folders(spark, tmp_path):
    names = "video_id string, id string, start string, end string, text string"
    frame = spark.createDataFrame([(f"{i:05d}", str(i), "0.0", None, f"가 {i}") for i in range(900)], names)
    store = tmp_path / "s"
    for part in (frame.filter("id < 400"), frame.filter("id >= 400")):
        writers.write_segments(part, str(store))
    assert rows(readers.read_segments(spark, str(store))) == rows(frame)
    folders = [f for f in store.iterdir() if f.is_dir()]
    assert len(folders) == writers.BUCKETS and sum(len(list(f.glob("part*"))) for f in folders) < 300


def test_a_folder_for_each_video_stays_as_it_is(spark, tmp_path):
    names = "video_id string, id string, start string, end string, text string"
    old, new = (spark.createDataFrame([(v, "0", "0.0", "1.0", v)], names) for v in ("007", "8"))
    old.write.partitionBy("video_id").json(str(tmp_path / "s"))
    writers.write_segments(new, str(tmp_path / "s"))
    assert rows(readers.read_segments(spark, str(tmp_path / "s"))) == rows(old.union(new))
    assert (tmp_path / "s" / "video_id=8").is_dir()
