"""Rows of an attribution log to combined events."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import events as E

# The public log counts seconds from its own start; anything
# below the threshold is such a relative time and is moved to the base.
RELATIVE_BELOW = 1_000_000_000
BASE_DATETIME = "2026-04-01T00:00:00"


def choose_base(
    max_ts: int | None, base_datetime: str = BASE_DATETIME, preserve_relative: bool = False
) -> int | None:
    """Seconds to add to every time, or None if the log's times stay as they are.

    ``max_ts`` must be the maximum over the whole log, not over a sample of it.
    """
    if preserve_relative or max_ts is None or max_ts >= RELATIVE_BELOW:
        return None
    base = datetime.fromisoformat(base_datetime)
    if base.tzinfo is None:
        base = base.replace(tzinfo=timezone.utc)
    return int(base.timestamp())


def convert(
    df: DataFrame,
    base: int | None = None,
    keep_categories: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The seven event columns (and nine categories) of string rows, and those to ``carry``.

    A conversion time of 0 or less means none. ``uid``, ``campaign`` and
    ``cost`` pass through as text; a blank cost becomes "0.0". Columns the log
    does not have are blank.
    """

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")

    converted = E.safe_int(text("conversion_timestamp"))
    columns = {
        "timestamp": E.rebase(E.safe_int(text("timestamp")), base),
        "uid": text("uid"),
        "campaign": text("campaign"),
        "click": E.safe_int(text("click")),
        "conversion": E.safe_int(text("conversion")),
        "conversion_timestamp": F.when(converted > 0, E.rebase(converted, base)),
        "cost": F.coalesce(E.blank_to_null(text("cost")), F.lit("0.0")),
    }
    if keep_categories:
        columns |= {name: text(name) for name in schemas.CATEGORY_COLUMNS}
    return df.select(*[column.alias(name) for name, column in columns.items()], *carry)


def envelope(df: DataFrame, index: str = "row_idx", prefix: str = "evt_") -> DataFrame:
    """Typed combined events as messages carry them: with an id, a kind and a readable time."""
    return df.select(
        E.event_id(F.col(index), prefix).alias("event_id"),
        F.lit("ad_event").alias("event_type"),
        "timestamp",
        E.iso_time(F.col("timestamp")).alias("event_time"),
        "uid",
        "campaign",
        "click",
        "conversion",
        "conversion_timestamp",
        F.coalesce("cost", F.lit(0.0)).alias("cost"),
    )
