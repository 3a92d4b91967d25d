"""Processed events to the daily campaign summary."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators.summary import campaign_days, recent


def summarize(
    processed: DataFrame,
    days: int = 7,
    as_of: date | None = None,
    run_at: datetime | None = None,
) -> DataFrame:
    """Summary rows of the recent window; the filter prunes ``event_date`` partitions."""
    updated_at = F.current_timestamp() if run_at is None else F.lit(run_at)
    window = processed.filter(recent("event_date", days, as_of))
    return campaign_days(window).withColumn("updated_at", updated_at).select(
        schemas.CAMPAIGN_SUMMARY.names
    )


def run(
    processed: DataFrame,
    table,
    merge_window_days: int = 7,
    as_of: date | None = None,
    retract: bool = False,
    run_at: datetime | None = None,
) -> None:
    """Merge the recent window's summary; ``retract`` also drops groups that ceased to exist."""
    table.ensure(processed.sparkSession)
    gone = recent("summary_date", merge_window_days, as_of) if retract else None
    # One row per group by construction, and the date is part of the key.
    table.upsert(
        summarize(processed, merge_window_days, as_of, run_at),
        unique=True,
        keys_move=False,
        delete_unmatched=gone,
    )
