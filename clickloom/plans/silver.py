"""Raw events to the processed event table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import events as E
from clickloom.operators import dedup, merge
from clickloom.operators.summary import recent

_VERSION = ("kafka_timestamp", "kafka_partition", "kafka_offset")

# Days by which a message's stated time may be ahead of the clock that lands it.
CLOCK_DAYS = 1


def project(raw: DataFrame, run_at: datetime | None = None) -> DataFrame:
    """The processed columns of each raw row, with the message position kept."""
    updated_at = F.current_timestamp() if run_at is None else F.lit(run_at)
    return raw.select(
        "event_id",
        F.to_date("event_timestamp").alias("event_date"),
        "uid",
        F.col("campaign").try_cast("int").alias("campaign"),
        F.col("click").try_cast("int").alias("click"),
        F.col("conversion").try_cast("int").alias("conversion"),
        E.conversion_delay(
            F.col("timestamp"), F.col("conversion"), F.col("conversion_timestamp")
        ).alias("conversion_delay_sec"),
        F.col("cost").try_cast("double").alias("cost"),
        updated_at.alias("updated_at"),
        *_VERSION,
    )


def transform(
    raw: DataFrame,
    keep: str = "latest",
    run_at: datetime | None = None,
    versioned: bool = False,
) -> DataFrame:
    """Processed rows, one per ``event_id``: the newest message, or with ``any`` some message.

    ``versioned`` adds the message's position as a ``version`` that can be compared.
    """
    rows = project(raw, run_at)
    if keep == "latest":
        rows = dedup.latest_row(rows, ["event_id"], dedup.message_order())
    elif keep == "any":
        rows = dedup.any_row(rows, ["event_id"])
    else:
        raise ValueError(f"keep must be latest or any, not {keep!r}")
    if versioned:
        return rows.withColumn("version", _version()).select(schemas.VERSIONED_EVENTS.names)
    return rows.select(schemas.PROCESSED_EVENTS.names)


def with_id(processed: DataFrame) -> DataFrame:
    """Rows that can be merged: without an id there is nothing to match."""
    return processed.filter(F.col("event_id").isNotNull())


def transform_recent(
    raw: DataFrame,
    days: int = 7,
    as_of: date | None = None,
    assume_fixed_dates: bool = False,
    assume_ingested_later: bool = False,
    run_at: datetime | None = None,
) -> DataFrame:
    """``transform`` and then the recent window, reading only that window in full.

    Filtering before the deduplication lets the filter reach the scan. It would
    resurrect an old version of an event whose newest version has a date
    outside the window, so those events are removed again, by a join with ids
    and message positions of the other rows sent since the window's first
    message. ``assume_fixed_dates`` leaves that join out where an event never
    changes its date.
    ``assume_ingested_later`` also skips raw partitions: of the window's rows
    those of earlier days, where no event arrives before its own time, and of
    the others those from before the window's first message was sent, less
    CLOCK_DAYS.

    Finding that first message runs one job over the window when the plan is
    made. A raw zone that takes long to read should be handed in written.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    first = F.date_sub(today, days)
    return _newest_inside(
        raw, _from_day(first), first, assume_fixed_dates, assume_ingested_later, run_at
    )


def transform_between(
    raw: DataFrame,
    first: date,
    last: date,
    assume_fixed_dates: bool = False,
    assume_ingested_later: bool = False,
    run_at: datetime | None = None,
) -> DataFrame:
    """As ``transform_recent`` for the event dates ``first`` to ``last`` inclusive."""
    inside = _from_day(F.lit(first)) & ~_from_day(F.lit(last + timedelta(days=1)))
    # Nearly all later messages are of later events: their versions are of no use, and
    # without them the grouping is as small as the range.
    return _newest_inside(
        raw, inside, F.lit(first), assume_fixed_dates, assume_ingested_later, run_at, only_own=True
    )


def _from_day(day: Column) -> Column:
    # On the stored timestamp rather than the derived date, so that it is pushed down.
    return F.col("event_timestamp") >= day.cast("timestamp")


def _newest_inside(
    raw: DataFrame,
    inside: Column,
    first: Column,
    assume_fixed_dates: bool,
    assume_ingested_later: bool,
    run_at: datetime | None,
    only_own: bool = False,
) -> DataFrame:
    chosen = raw.filter(inside & F.col("event_id").isNotNull())
    if assume_ingested_later:
        chosen = chosen.filter(F.col("raw_date") >= first)
    rows = project(chosen, run_at)
    newest = dedup.latest_row(rows, ["event_id"], dedup.message_order())
    if not assume_fixed_dates:
        elsewhere = raw.filter(~F.coalesce(inside, F.lit(False)) & F.col("event_id").isNotNull())
        # Only a later message can replace another, so what was sent before the
        # first one inside need not be read. One value, known when planning, it
        # is pushed into the scan.
        sent = rows.agg(
            F.min(F.unix_micros("kafka_timestamp")).alias("first"),
            F.count(F.when(F.col("kafka_timestamp").isNull(), True)).alias("unknown"),
        ).first()
        if sent["first"] is not None and not sent.unknown:
            since = F.timestamp_micros(F.lit(sent["first"]))
            elsewhere = elsewhere.filter(F.col("kafka_timestamp") >= since)
            if assume_ingested_later:
                landed = F.date_sub(since.cast("date"), CLOCK_DAYS)
                elsewhere = elsewhere.filter(F.col("raw_date") >= landed)
        if only_own:
            elsewhere = merge.semi_join(elsewhere, rows, ["event_id"])
        versions = elsewhere.groupBy("event_id").agg(F.max(_version()).alias("_version"))
        same_and_newer = (F.col("n.event_id") == F.col("v.event_id")) & (
            F.col("v._version") > F.col("n._version")
        )
        newest = (
            newest.withColumn("_version", _version())
            .alias("n")
            .join(versions.alias("v"), same_and_newer, "left_anti")
        )
    return newest.select(schemas.PROCESSED_EVENTS.names)


def _version() -> Column:
    # The same order as dedup.message_order, as one comparable value.
    return F.struct(
        F.col("kafka_timestamp"), (-F.col("kafka_partition")).alias("partition"), F.col("kafka_offset")
    )


def run(
    raw: DataFrame,
    table,
    mode: str = "merge",
    merge_window_days: int = 7,
    as_of: date | None = None,
    truncate: bool = False,
    assume_fixed_dates: bool = False,
    run_at: datetime | None = None,
    assume_ingested_later: bool = False,
) -> None:
    """Bring the processed table up to date with the raw zone.

    ``merge`` upserts the recent window. ``full-refresh`` replaces every
    partition the raw zone has events for, and with ``truncate`` all others too.
    """
    table.ensure(raw.sparkSession)
    if mode == "full-refresh":
        table.overwrite_partitions(transform(raw, run_at=run_at), truncate)
    elif mode == "merge":
        rows = transform_recent(
            raw, merge_window_days, as_of, assume_fixed_dates, assume_ingested_later, run_at
        )
        table.upsert(rows, unique=True, keys_move=not assume_fixed_dates)
    else:
        raise ValueError(f"mode must be merge or full-refresh, not {mode!r}")


def backfill(
    raw: DataFrame,
    table,
    first: date,
    last: date,
    run_at: datetime | None = None,
    assume_fixed_dates: bool = False,
    assume_ingested_later: bool = False,
) -> None:
    """Merge the events of a date range again; running it twice changes nothing more."""
    table.ensure(raw.sparkSession)
    rows = transform_between(raw, first, last, assume_fixed_dates, assume_ingested_later, run_at)
    table.upsert(rows, unique=True, keys_move=not assume_fixed_dates)


def recent_rows(processed: DataFrame, days: int = 7, as_of: date | None = None) -> DataFrame:
    return processed.filter(recent("event_date", days, as_of))


def merged(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    """The processed table after a merge, as a DataFrame and without writing it."""
    return merge.merge_upsert(target, source, ["event_id"], **options)
