"""Attribution logs and CSV files to event sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import attribution_log as log
from clickloom.operators import fanout, ranking, sampling, stats
from clickloom.sinks import files, scratch
from clickloom.sources.files import FILE_ORDER, read_tsv, typed_events

HEAD_ROWS = 1000
TAIL_FROM = 0.8


@dataclass(frozen=True)
class Slices:
    """All rows in time order, the first thousand, and the last fifth."""

    main: DataFrame
    head: DataFrame
    tail: DataFrame


def in_time_order(df: DataFrame, ties: Sequence[str]) -> DataFrame:
    return df.orderBy("timestamp", *ties)


def slices(df: DataFrame, ties: Sequence[str]) -> Slices:
    """``timestamp`` must be a BIGINT without NULLs; ``ties`` tells rows of equal time apart."""
    order = ["timestamp", *ties]
    _, tail = ranking.split_at(df, order, lambda rows: int(rows * TAIL_FROM))
    return Slices(
        main=in_time_order(df, ties),
        head=in_time_order(ranking.first_n(df, order, HEAD_ROWS), ties),
        tail=in_time_order(tail, ties),
    )


def first_events(df: DataFrame, n: int | None, ties: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in time order; None or 0 means all."""
    return ranking.first_n(df, ["timestamp", *ties], n) if n else df


def sampled_log(
    spark: SparkSession,
    path: str,
    size: int = 1_000_000,
    seed: int = 42,
    base_datetime: str = log.BASE_DATETIME,
    preserve_relative: bool = False,
    keep_categories: bool = False,
    read_partitions: int | None = None,
) -> DataFrame:
    """A converted sample of a log, with the original ``_line`` and its number ``_row``.

    The log is parsed into a written table first: it is read several times, and
    a single gzip file could be read by one task only, each time. Its rows get
    their numbers there, by which they are drawn, so that equal lines are drawn
    one by one. The same files read with the same settings give the same sample.
    """
    parsed = read_tsv(spark, path, read_partitions)
    lines = scratch.written(parsed.withColumn("_row", F.monotonically_increasing_id()), "log")
    leading = lines.columns[0]
    scan = stats.scan_stats(lines, leading).first()
    base = log.choose_base(scan.max_ts, base_datetime, preserve_relative)
    sample = sampling.sample_exact(lines, size, "_row", seed)
    return log.convert(sample, base, keep_categories, carry=("_line", "_row"))


def convert_log(
    spark: SparkSession,
    path: str,
    output: str,
    size: int = 1_000_000,
    seed: int = 42,
    base_datetime: str = log.BASE_DATETIME,
    preserve_relative: bool = False,
    keep_categories: bool = False,
    read_partitions: int | None = None,
) -> DataFrame:
    """Write the sample as three CSV folders and return its statistics."""
    columns = schemas.AD_EVENT_COLUMNS + (schemas.CATEGORY_COLUMNS if keep_categories else ())
    sample = sampled_log(
        spark,
        path,
        size,
        seed,
        base_datetime,
        preserve_relative,
        keep_categories,
        read_partitions,
    )
    sample = scratch.written(sample, "sample")
    # Equal lines differ in nothing but their number, which lets a sort split them.
    parts = slices(sample, ["_line", "_row"])
    files.write_csv(parts.main, f"{output}/ad_events", columns)
    files.write_csv(parts.head, f"{output}/ad_events_sample", columns)
    files.write_csv(parts.tail, f"{output}/ad_events_batch2", columns)
    return stats.dataset_stats(sample)


def identified(
    df: DataFrame,
    order: Sequence[str] | None,
    prefix: str = "evt_",
    max_events: int | None = None,
) -> DataFrame:
    """Typed events with ids numbered in ``order``, or in scan order without one.

    Ids start at 0 in every set: give sets that will be merged different
    prefixes. ``max_events`` keeps the first ones; None or 0 means all.
    """
    rows = ranking.with_row_index(df, order)
    if max_events:
        rows = rows.filter(F.col("row_idx") < max_events)
    return log.envelope(rows, prefix=prefix)


def numbered_csv(
    events: DataFrame,
    prefix: str = "evt_",
    by_time: bool = False,
    max_events: int | None = None,
    campaign_text: bool = False,
) -> DataFrame:
    """String-typed CSV rows as events numbered in the order given, or in time order.

    The order given is by file and position if the rows carry them (``position`` of
    ``read_events_csv``), else as scanned; in time order it decides between equal times.
    """
    typed = typed_events(events, campaign_text)
    order = [name for name in FILE_ORDER if name in events.columns]
    if not order:
        typed, order = typed.withColumn("_scan", F.monotonically_increasing_id()), ["_scan"]
    if by_time:
        order = ["timestamp", *order]
    return identified(scratch.written(typed, "typed"), order, prefix, max_events)


def split_csv(
    events: DataFrame, output: str, seed: int = 42, prefix: str = "evt_", by_time: bool = False
) -> DataFrame:
    """Write the three feeds of a string-typed event CSV and return their summary.

    The campaign is written as it was read, whatever it is.
    """
    numbered = numbered_csv(events, prefix, by_time, campaign_text=True)
    feed = scratch.written(fanout.split(numbered, seed), "feed")
    for kind, columns in (
        ("impression", schemas.IMPRESSION_COLUMNS),
        ("click", schemas.CLICK_COLUMNS),
        ("conversion", schemas.CONVERSION_COLUMNS),
    ):
        rows = fanout.in_time_order(fanout.of_kind(feed, kind))
        files.write_csv(rows, f"{output}/events_{kind}s", columns)
    return fanout.summary(feed)
