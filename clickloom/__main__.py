"""Command line entry to each job.

    python -m clickloom ingest --bootstrap-servers host:9092 --raw-path R --checkpoint-path C
    python -m clickloom silver --raw-path R --base-path B
    python -m clickloom gold --base-path B
    python -m clickloom stream-gold --bootstrap-servers host:9092 --base-path B --checkpoint-path C
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import functions as F

from clickloom import schemas, session
from clickloom.operators import health
from clickloom.operators.attribution_log import BASE_DATETIME
from clickloom.operators.fanout import KINDS, observed, split
from clickloom.operators.stats import for_display
from clickloom.plans import compact, gold, prepare, silver
from clickloom.sinks import messages as message_sink
from clickloom.sinks import scratch, tables
from clickloom.sources import files, segments, streams
from clickloom.streaming import gold as streaming_gold
from clickloom.streaming import ingest, relink


def _table_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--base-path", help="folder of parquet tables; leave out to use a catalog")
    parser.add_argument("--catalog-mode", choices=["local", "glue"], default="local")
    parser.add_argument("--catalog-name", default="local")
    parser.add_argument("--warehouse")
    parser.add_argument("--database", default="ad_lakehouse")


def _window_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--merge-window-days", type=int, default=7)
    parser.add_argument("--as-of", type=date.fromisoformat, help="default: today")


def _assumptions(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--assume-fixed-dates", action="store_true")
    parser.add_argument(
        "--assume-ingested-later",
        action="store_true",
        help="events land on their own date or later: skip earlier raw partitions",
    )


def _csv_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--by-time", action="store_true", help="number events by time, not as given")
    parser.add_argument("--multi-line", action="store_true", help="quoted fields may hold line breaks")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--id-prefix", default="evt_")


# Names and defaults of options are the public interface.
def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom", description=__doc__.splitlines()[0])
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="message topic to raw files")
    _source_options(job)
    job.add_argument("--raw-path", required=True)
    job.add_argument("--output-format", choices=["parquet", "json"], default="parquet")
    job.add_argument("--once-within", metavar="TIME", help="land a message once, if its copy comes within such as '1 day'")
    job.add_argument("--once-by", choices=["content", "position"], default="content")

    job = jobs.add_parser("stream-gold", help="message topic to processed_events and campaign_summary")
    _source_options(job)
    job.add_argument("--within-days", type=int, help="an event's date never moves further")
    job.add_argument("--processed-table", default="versioned_events")
    job.add_argument("--summary-table", default="campaign_summary")
    job.add_argument("--base-path", required=True)

    job = jobs.add_parser("relink", help="impression, click and conversion topics to linked rows")
    _source_options(job, topic=False)
    job.add_argument("--output-path", required=True)
    job.add_argument("--click-within", default=relink.CLICK_WITHIN)
    job.add_argument("--convert-within", default=relink.CONVERT_WITHIN)
    job.add_argument("--late", default=relink.LATE)

    job = jobs.add_parser("smoke", help="rate source to parquet files")
    job.add_argument("--output-path", required=True)
    job.add_argument("--checkpoint-path", required=True)
    job.add_argument("--duration-sec", type=float, default=6)
    job.add_argument("--rows-per-second", type=int, default=5)

    job = jobs.add_parser("silver", help="raw files to processed_events")
    job.add_argument("--raw-path", required=True)
    job.add_argument("--raw-format", choices=["parquet", "json"], default="parquet")
    job.add_argument("--table", default="processed_events")
    job.add_argument("--mode", choices=["merge", "full-refresh"], default="merge")
    job.add_argument("--truncate", action="store_true")
    _assumptions(job)
    _table_options(job)
    _window_options(job)

    job = jobs.add_parser("backfill", help="merge a range of event dates again")
    job.add_argument("--raw-path", required=True)
    job.add_argument("--raw-format", choices=["parquet", "json"], default="parquet")
    job.add_argument("--table", default="processed_events")
    job.add_argument("--first", type=date.fromisoformat, required=True)
    job.add_argument("--last", type=date.fromisoformat, required=True)
    _assumptions(job)
    _table_options(job)

    job = jobs.add_parser("gold", help="processed_events to campaign_summary")
    job.add_argument("--processed-table", default="processed_events")
    job.add_argument("--summary-table", default="campaign_summary")
    job.add_argument("--retract", action="store_true")
    _table_options(job)
    _window_options(job)

    job = jobs.add_parser("prepare", help="attribution log to event CSVs")
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--sample", type=int, default=1_000_000)
    job.add_argument("--keep-cats", action="store_true")
    job.add_argument("--seed", type=int, default=42)
    job.add_argument("--base-datetime", default=BASE_DATETIME)
    job.add_argument("--preserve-relative-timestamps", action="store_true")
    job.add_argument("--read-partitions", type=int, help="spread a single gzip file over these")

    job = jobs.add_parser("split", help="event CSV to impression, click and conversion CSVs")
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    _csv_options(job)

    job = jobs.add_parser("publish", help="event CSV to messages")
    job.add_argument("--csv", required=True)
    job.add_argument("--bootstrap-servers", default="localhost:9092")
    job.add_argument("--output-path", help="write message files here instead of to a broker")
    job.add_argument("--max-events", type=int)
    job.add_argument("--realistic", action="store_true", help="three topics instead of one")
    _csv_options(job)

    job = jobs.add_parser("health", help="freshness, rows per day, duplicates and files")
    job.add_argument("--base-path", required=True)
    job.add_argument("--table", default="processed_events")
    job.add_argument("--output", help="also write the results whole, as parquet folders in this one")

    job = jobs.add_parser("compact", help="rewrite partitions of small files")
    job.add_argument("--base-path")
    job.add_argument("--table", default="processed_events")
    job.add_argument("--summary", action="store_true", help="the table is a campaign summary")
    job.add_argument("--raw-path", help="copy this raw zone to --raw-output instead")
    job.add_argument("--raw-output")
    job.add_argument("--target-bytes", type=int, default=schemas.TARGET_FILE_BYTES)
    return parser


def _source_options(job, topic: bool = True) -> None:
    job.add_argument("--bootstrap-servers", default="localhost:9092")
    if topic:
        job.add_argument("--topic", default=schemas.TOPICS["ad_event"])
    job.add_argument("--starting-offsets", default="earliest")
    job.add_argument(
        "--source-option",
        action="append",
        default=[],
        metavar="KEY=VALUE",
        help="such as maxOffsetsPerTrigger=1000000",
    )
    job.add_argument("--messages-path", help="read message files from here instead of a broker")
    if topic:
        job.add_argument(
            "--by-position",
            action="store_true",
            help="the message files lie in folders by position; starting offsets may then be latest or such as 0:100,2:250",
        )
    job.add_argument("--checkpoint-path", required=True)
    job.add_argument("--interval", help="time between batches, such as '5 minutes'")
    job.add_argument("--available-now", action="store_true")
    job.add_argument("--duration-sec", type=float)


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _conf(args) -> dict[str, str]:
    conf = _pairs(args.conf)
    if "catalog_name" in args and not args.base_path:
        if not args.warehouse:
            raise SystemExit("give --base-path, or --warehouse for a catalog")
        conf = session.catalog_conf(args.catalog_name, args.warehouse, args.catalog_mode) | conf
    return conf


def _processed(args, name: str):
    if args.base_path:
        return tables.processed_events(args.base_path, name)
    return tables.processed_events_in(args.catalog_name, args.database, name)


def _summary(args, name: str):
    if args.base_path:
        return tables.campaign_summary(args.base_path, name)
    return tables.campaign_summary_in(args.catalog_name, args.database, name)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = session.get(f"clickloom-{args.job}", _conf(args))
    try:
        _JOBS[args.job](spark, args)
    finally:
        scratch.clear(spark)


def _source(spark, args, topic: str, folder: str = ""):
    options = _pairs(args.source_option)
    if not args.messages_path:
        return streams.kafka_messages(spark, args.bootstrap_servers, topic, args.starting_offsets, options)
    if getattr(args, "by_position", False):
        start = args.starting_offsets
        if ":" in start:
            start = {int(p): int(offset) for p, offset in (pair.split(":") for pair in start.split(","))}
        return segments.messages(spark, args.messages_path, start, args.checkpoint_path)
    return streams.file_messages(spark, args.messages_path + folder, options=options)


def _ingest(spark, args) -> None:
    source = _source(spark, args, args.topic)
    if args.once_within:
        source = ingest.once(source, args.once_within, args.once_by)
    query = ingest.land(
        ingest.to_raw(source),
        args.raw_path,
        args.checkpoint_path,
        args.output_format,
        available_now=args.available_now,
        interval=args.interval,
    )
    ingest.run_for(query, args.duration_sec)


def _stream_gold(spark, args) -> None:
    query = streaming_gold.maintain(
        _source(spark, args, args.topic),
        tables.versioned_events(args.base_path, args.processed_table),
        tables.campaign_summary(args.base_path, args.summary_table),
        args.checkpoint_path,
        available_now=args.available_now,
        interval=args.interval,
        within_days=args.within_days,
    )
    ingest.run_for(query, args.duration_sec)


def _relink(spark, args) -> None:
    """The folders of message files are named like the topics."""
    feeds = [
        relink.feed(_source(spark, args, topic, f"/{topic}"), args.late)
        for topic in (schemas.TOPICS[kind] for kind in KINDS)
    ]
    query = ingest.land(
        relink.relinked(*feeds, args.click_within, args.convert_within),
        args.output_path,
        args.checkpoint_path,
        partition_by=(),
        available_now=args.available_now,
        interval=args.interval,
    )
    ingest.run_for(query, args.duration_sec)


def _smoke(spark, args) -> None:
    rows = ingest.with_ingest_time(streams.rate(spark, args.rows_per_second))
    query = ingest.land(rows, args.output_path, args.checkpoint_path, partition_by=())
    ingest.run_for(query, args.duration_sec)


def _silver(spark, args) -> None:
    silver.run(
        files.read_raw(spark, args.raw_path, args.raw_format),
        _processed(args, args.table),
        args.mode,
        args.merge_window_days,
        args.as_of,
        args.truncate,
        args.assume_fixed_dates,
        assume_ingested_later=args.assume_ingested_later,
    )


def _backfill(spark, args) -> None:
    raw = files.read_raw(spark, args.raw_path, args.raw_format)
    silver.backfill(
        raw,
        _processed(args, args.table),
        args.first,
        args.last,
        assume_fixed_dates=args.assume_fixed_dates,
        assume_ingested_later=args.assume_ingested_later,
    )


def _gold(spark, args) -> None:
    processed = _processed(args, args.processed_table).read(spark)
    summary = _summary(args, args.summary_table)
    gold.run(processed, summary, args.merge_window_days, args.as_of, args.retract)


def _prepare(spark, args) -> None:
    stats = prepare.convert_log(
        spark,
        args.input,
        args.output,
        args.sample,
        args.seed,
        args.base_datetime,
        args.preserve_relative_timestamps,
        args.keep_cats,
        args.read_partitions,
    )
    for_display(stats).show(truncate=False, vertical=True)


def _split(spark, args) -> None:
    events = files.read_events_csv(spark, args.input, position=True, multi_line=args.multi_line)
    summary = prepare.split_csv(events, args.output, args.seed, args.id_prefix, args.by_time)
    for_display(summary).show(truncate=False, vertical=True)


def _publish(spark, args) -> None:
    rows = files.read_events_csv(spark, args.csv, position=True, multi_line=args.multi_line)
    events = prepare.numbered_csv(rows, args.id_prefix, args.by_time, args.max_events)
    counters = None
    if args.realistic:
        feed, counters = observed(split(events, args.seed, "has_timestamp"))
        out = message_sink.encode_feed(feed)
    else:
        out = message_sink.encode_events(events)
    if args.output_path:
        message_sink.publish_files(out, args.output_path)
    else:
        message_sink.publish_kafka(out, args.bootstrap_servers)
    if counters:
        print(counters.get)


def _health(spark, args) -> None:
    table = tables.processed_events(args.base_path, args.table)
    rows = table.read(spark)
    found = {
        "freshness": health.freshness(rows),
        "rows_per_day": health.rows_per_day(rows).orderBy("event_date"),
        "duplicate_keys": health.duplicate_keys(rows).orderBy("event_id"),
        "files": health.file_layout(spark, table.path).orderBy("event_date"),
    }
    for name, result in found.items():
        if args.output:
            result.write.mode("overwrite").parquet(f"{args.output}/{name}")
            result = spark.read.schema(result.schema).parquet(f"{args.output}/{name}")
        print(f"{name}: {result.count()}")
        # All of them, a partition of the result at a time; as text, which holds any date.
        if name != "duplicate_keys" or not args.output:
            text = result.select(*(F.col(column).cast("string") for column in result.columns))
            for row in text.toLocalIterator():
                print("  " + ", ".join(f"{k}={v}" for k, v in row.asDict().items()))


def _compact(spark, args) -> None:
    if args.raw_path:
        count = compact.raw_copy(spark, args.raw_path, args.raw_output, args.target_bytes)
        print(f"{count} partitions copied")
        return
    of = tables.campaign_summary if args.summary else tables.processed_events
    table = of(args.base_path, args.table)
    print(f"{compact.run(spark, table, args.target_bytes)} partitions rewritten")


_JOBS = {
    "ingest": _ingest,
    "stream-gold": _stream_gold,
    "relink": _relink,
    "smoke": _smoke,
    "silver": _silver,
    "backfill": _backfill,
    "gold": _gold,
    "prepare": _prepare,
    "split": _split,
    "publish": _publish,
    "health": _health,
    "compact": _compact,
}


if __name__ == "__main__":
    main()
