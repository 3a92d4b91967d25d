"""Combined event rows to impression, click and conversion events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import events as E
from clickloom.operators import merge

KINDS = ("impression", "click", "conversion")


def _fields(kind: str, seed: int = 42) -> dict[str, Column]:
    """One kind of event from the columns of a combined row."""
    seconds, converted_at = F.col("timestamp"), F.col("conversion_timestamp")
    none = F.lit(None)
    at, impression_at, cost, delay = {
        "impression": (seconds, none, F.coalesce("cost", F.lit(0.0)), none),
        "click": (F.try_add(seconds, E.click_delay(F.col("event_id"), seed)), seconds, none, none),
        "conversion": (converted_at, seconds, none, F.try_subtract(converted_at, seconds)),
    }[kind]
    return {
        "event_id": F.col("event_id"),
        "event_type": F.lit(kind),
        "timestamp": at.cast("bigint"),
        "impression_timestamp": impression_at.cast("bigint"),
        "event_time": E.iso_time(at),
        "uid": F.col("uid"),
        "campaign": F.col("campaign"),
        "cost": cost.cast("double"),
        "conversion_delay_sec": delay.cast("bigint"),
    }


def _named(fields: dict[str, Column], columns=None) -> list[Column]:
    return [fields[name].alias(name) for name in columns or fields]


def _converts(rule: str) -> Column:
    return E.is_conversion(
        rule, F.col("conversion"), F.col("conversion_timestamp"), F.col("timestamp")
    )


def split(df: DataFrame, seed: int = 42, rule: str = "positive_delay") -> DataFrame:
    """One to three rows per combined event, from one scan and without a shuffle.

    Every row gives an impression, a clicked row a click some seconds later and
    a converted row (by ``rule``) a conversion at its own time. Columns a kind
    does not have are NULL. Only the kind is exploded; the columns are worked
    out afterwards, so those nobody selects cost nothing.
    """
    kinds = F.array(
        F.lit("impression"),
        F.when(E.is_click(F.col("click")), "click"),
        F.when(_converts(rule), "conversion"),
    )
    # A filter after the explode stays in generated code; array_compact would not.
    exploded = (
        df.drop("event_type")
        .withColumn("event_type", F.explode(kinds))
        .filter(F.col("event_type").isNotNull())
    )
    fields = {kind: _fields(kind, seed) for kind in ("impression", "click", "conversion")}

    def of_kind(name: str) -> Column:
        is_kind = {kind: F.col("event_type") == kind for kind in fields}
        return (
            F.when(is_kind["impression"], fields["impression"][name])
            .when(is_kind["click"], fields["click"][name])
            .otherwise(fields["conversion"][name])
        )

    feed = exploded.select(
        "event_id",
        "event_type",
        of_kind("timestamp").alias("timestamp"),
        of_kind("impression_timestamp").alias("impression_timestamp"),
        "uid",
        "campaign",
        of_kind("cost").alias("cost"),
        of_kind("conversion_delay_sec").alias("conversion_delay_sec"),
    )
    return feed.withColumn("event_time", E.iso_time(F.col("timestamp")))


def impressions(df: DataFrame) -> DataFrame:
    """The impressions of combined events alone."""
    return df.select(_named(_fields("impression"), schemas.IMPRESSION_COLUMNS))


def clicks(df: DataFrame, seed: int = 42) -> DataFrame:
    """The clicks of combined events alone: a filter the scan can use."""
    clicked = df.filter(E.is_click(F.col("click")))
    return clicked.select(_named(_fields("click", seed), schemas.CLICK_COLUMNS))


def conversions(df: DataFrame, rule: str = "positive_delay") -> DataFrame:
    """The conversions of combined events alone."""
    converted = df.filter(_converts(rule))
    return converted.select(_named(_fields("conversion"), schemas.CONVERSION_COLUMNS))


def of_kind(feed: DataFrame, kind: str) -> DataFrame:
    """One kind's rows and columns of a feed made by ``split``."""
    columns = {
        "impression": schemas.IMPRESSION_COLUMNS,
        "click": schemas.CLICK_COLUMNS,
        "conversion": schemas.CONVERSION_COLUMNS,
    }[kind]
    return feed.filter(F.col("event_type") == kind).select(*columns)


def in_time_order(events: DataFrame) -> DataFrame:
    """Sorted over the whole table by range, ties by id."""
    return events.orderBy("timestamp", "event_id")


def together(*feeds: DataFrame) -> DataFrame:
    """Separate feeds as one; columns a feed lacks become NULL."""
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed, allowMissingColumns=True)
    return union


def counts() -> list[Column]:
    """Events of each kind, as aggregates."""

    def of(kind: str) -> Column:
        return F.count(F.when(F.col("event_type") == kind, True))

    return [
        of("impression").alias("impressions"),
        of("click").alias("clicks"),
        of("conversion").alias("conversions"),
    ]


def summary(feed: DataFrame) -> DataFrame:
    """Events of each kind, their rates, and the mean conversion delay in hours."""
    totals = feed.agg(
        *counts(),
        F.coalesce(F.avg("conversion_delay_sec") / 3600, F.lit(0.0)).alias("avg_delay_hours"),
    )
    return totals.withColumns(
        {
            "ctr": E.percent(F.col("clicks"), F.col("impressions")),
            "cvr": E.percent(F.col("conversions"), F.col("clicks")),
        }
    )


def observed(feed: DataFrame, name: str = "sent") -> tuple[DataFrame, Observation]:
    """The feed, and its counts per kind once it has been written: no second pass."""
    counters = Observation(name)
    return feed.observe(counters, *counts()), counters


def relink(
    impressions: DataFrame, clicks: DataFrame, conversions: DataFrame, check: bool = False
) -> DataFrame:
    """The three feeds joined again on ``event_id``, which each must hold once.

    The feeds share their key, so once they are shuffled on it no further
    shuffle is needed for the second join. ``check`` refuses feeds that repeat an
    id, which would multiply rows; it costs a job for each feed.
    """
    if check:
        for feed in (impressions, clicks, conversions):
            merge.require_unique(feed, ["event_id"])
    clicked = clicks.select("event_id", F.col("timestamp").alias("click_timestamp"))
    converted = conversions.select(
        "event_id",
        F.col("timestamp").alias("conversion_timestamp"),
        "conversion_delay_sec",
    )
    return (
        impressions.select("event_id", "timestamp", "uid", "campaign", "cost")
        .join(clicked, "event_id", "left")
        .join(converted, "event_id", "left")
    )
