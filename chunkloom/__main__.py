"""Command line: `spark-submit chunkloom/__main__.py <job> ...` or `python -m chunkloom <job> ...`."""

import argparse
import importlib
import os

from chunkloom import fixed_values as fv
from chunkloom.functions.prompts import ChatTemplate
from chunkloom.plans import build, export, listings, summarise
from chunkloom.session import build_session, drop_stored, stored
from chunkloom.sources import readers, writers


def _model(spec: str | None):
    """The pandas UDF named 'module:attribute'."""
    if spec is None:
        return None
    module, name = spec.split(":")
    return getattr(importlib.import_module(module), name)


def _phrases(path: str | None) -> list[str]:
    if path is None:
        return []
    with open(path, encoding="utf-8") as lines:
        return [line.rstrip("\n") for line in lines if line.strip()]


def _source(spark, path: str | None):
    return None if path is None else readers.load_any(spark, path)


def _inventory(spark, path: str):
    """A Parquet table in place of a folder of single files, or None."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else None


def _prompt(args) -> dict:
    """The prompt options that were given; a turn template holds {role} and {content}."""
    given = {"system": args.system, "instruction": args.instruction}
    if args.chat_turn:
        given["template"] = ChatTemplate(args.chat_turn, args.chat_opening)
    return {key: value for key, value in given.items() if value is not None}


def build_chunks(spark, args) -> None:
    # A daily job finds no table on its first day.
    done = readers.read_chunks(spark, args.output) if args.resume and readers.exists(spark, args.output) else None
    built = build.build_chunks(
        readers.read_listing(spark, args.listing),
        _inventory(spark, args.segments) or readers.read_segment_files(spark, args.segments),
        _inventory(spark, args.images) or readers.list_images(spark, args.images),
        _phrases(args.phrases),
        _source(spark, args.first_source),
        _source(spark, args.second_source),
        args.images,
        _model(args.model),
        args.partitions,
        None if done is None else stored(done.select("video_id").distinct(), "done"),
        with_rejects=args.rejects is not None,
    )
    writers.write_chunks(built.chunks, args.output, keep=args.resume)
    if args.rejects:
        built.rejects.write.mode("overwrite").parquet(args.rejects)


def export_chunks(spark, args) -> None:
    jdbc = None
    if args.jdbc_url:
        jdbc = {"url": args.jdbc_url, "table": args.table, "isolation": args.isolation}
        given = {
            "driver": args.driver,
            "connections": args.connections,
            "user": os.environ.get("CHUNKLOOM_DB_USER"),
            "password": os.environ.get("CHUNKLOOM_DB_PASSWORD"),
        }
        jdbc |= {key: value for key, value in given.items() if value is not None}
    export.export_chunks(spark, args.input, args.copy_to, jdbc, args.skip_stored)


def summarise_chunks(spark, args) -> None:
    chunks = readers.load_any(spark, args.input)
    done = writers.stored_summaries(spark, args.output) if args.resume else None
    done = None if done is None else stored(done.select("video_id").distinct(), "done")
    made = summarise.summarise_videos(chunks, args.top_k, _model(args.model), tasks=args.tasks, done=done, **_prompt(args))
    writers.write_summaries(made.summaries, args.output, args.buckets)
    if args.rejects:
        made.rejects.write.mode("overwrite").parquet(args.rejects)


def _tables(spark, args):
    return readers.read_chunks(spark, args.chunks), readers.read_summaries(spark, args.summaries)


def recent(spark, args) -> None:
    listings.recent(*_tables(spark, args), as_of=args.as_of, n=args.n).show(args.n, truncate=False)


def search(spark, args) -> None:
    listings.search(*_tables(spark, args), args.q, args.n, args.collation).show(args.n, truncate=False)


def summary(spark, args) -> None:
    found = readers.read_summaries_of(spark, args.summaries, args.video_id)
    listings.summary_of(found, args.video_id).show(1, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="chunkloom")
    jobs = parser.add_subparsers(required=True)

    def job(name, run, *required, **optional):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            kind = int if isinstance(default, int) and not isinstance(default, bool) else str
            sub.add_argument(f"--{option.replace('_', '-')}", default=default, type=kind)
        return sub

    build_job = job("build", build_chunks, "listing", "segments", "images", "output",
                    phrases=None, first_source=None, second_source=None, model=None, rejects=None)
    build_job.add_argument("--partitions", type=int)
    build_job.add_argument("--resume", action="store_true", help="leave out videos that the output holds, and add the others")
    export_job = job("export", export_chunks, "input", "copy-to",
                     jdbc_url=None, table="chunks", driver=None, isolation="READ_COMMITTED")
    export_job.add_argument("--connections", type=int)
    export_job.add_argument("--skip-stored", action="store_true")
    summarise_job = job("summarise", summarise_chunks, "input", "output", model=None, top_k=fv.TOP_K, rejects=None,
                        system=None, instruction=None, chat_turn=None, chat_opening="")
    summarise_job.add_argument("--resume", action="store_true", help="leave out videos that have a summary")
    summarise_job.add_argument("--buckets", type=int)
    summarise_job.add_argument("--tasks", type=int)
    job("recent", recent, "chunks", "summaries", as_of=None, n=fv.RECENT_LIMIT)
    job("search", search, "chunks", "summaries", q="", n=fv.CATALOGUE_LIMIT, collation=None)
    job("summary", summary, "summaries", "video-id")
    return parser


def main(argv=None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("chunkloom")
    try:
        args.run(spark, args)
    finally:
        drop_stored(spark)


if __name__ == "__main__":
    main()
