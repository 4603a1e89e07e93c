"""Command line: ``python -m townads <job> ...`` or the same through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from townads.operators import crawl
from townads.plans import files
from townads.session import build_session
from townads.sources import jsonl, pages, topics
from townads.streaming import apps, runs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="townads", description="Jobs over classified ads")
    job = top.add_subparsers(dest="job", required=True)
    for name in files.FILE_JOBS:
        file_job = job.add_parser(name, help="JSONL file of ads to change lines")
        file_job.add_argument("--input", required=True)
        file_job.add_argument("--output", required=True)
        file_job.add_argument("--quarantine", help="folder for ads that cannot be used; without it they fail the job")
    extract = job.add_parser("extract", help="stored pages to a JSONL file of ads")
    extract.add_argument("--input", required=True)
    extract.add_argument("--output", required=True)
    ingest = job.add_parser("ingest", help="stored pages, as they arrive, to a JSONL folder and a topic of ads")
    ingest.add_argument("--pages", required=True)
    ingest.add_argument("--output", required=True)
    ingest.add_argument("--servers", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--target", default=apps.ADS_TOPIC)
    ingest.add_argument("--spider", default=apps.SPIDER)
    ingest.add_argument("--files", type=int, default=apps.FILES, help="files of pages in a micro-batch")
    ingest.add_argument("--every", default=apps.EVERY, help="time between micro-batches")
    for name in apps.LIVE:
        live = job.add_parser(name, help="topic of ads to topic of counts")
        live.add_argument("--servers", required=True)
        live.add_argument("--checkpoint", required=True)
        live.add_argument("--source", default=apps.ADS_TOPIC)
        live.add_argument("--target", default=apps.LIVE[name][0])
        live.add_argument("--quarantine", help="folder for messages that cannot be used; needed unless strict")
        live.add_argument("--strict", action="store_true", help="fail on such messages instead")
        live.add_argument("--max-records", type=int, default=apps.MAX_RECORDS, help="records in a micro-batch")
        live.add_argument("--every", default=apps.EVERY, help="time between micro-batches")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"townads {args.job}")
    if args.job in files.FILE_JOBS:
        files.run(spark, args.job, args.input, args.output, args.quarantine)
    elif args.job == "extract":
        found = crawl.extract_ads(pages.read_pages(spark, args.input), F.current_timestamp())
        jsonl.write_ads(found, args.output)
    elif args.job == "ingest":
        send = runs.send_to_topic(topics.write_options(args.servers, args.target))
        stored = pages.stream_pages(spark, args.pages, args.files)
        query = apps.start_ingest(stored, args.output, args.checkpoint, send, args.spider, every=args.every)
        apps.await_all(spark, [query])
    else:
        queries = apps.start_live(
            spark,
            args.job,
            args.servers,
            args.checkpoint,
            source=args.source,
            target=args.target,
            quarantine=args.quarantine,
            strict=args.strict,
            max_records=args.max_records,
            every=args.every,
        )
        apps.await_all(spark, queries)


if __name__ == "__main__":
    main()
