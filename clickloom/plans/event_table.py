"""A generic event table (id, time, user, type, value, JSON props) as advertising events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import events as E
from clickloom.session import pin_utc

# Fixed values of the mapping: conversions come 60 to 259,200 seconds later.
_DELAY_STEP, _DELAY_SPAN, _DELAY_LEAST = 7919, 259_141, 60


def ad_events(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """Combined events: a click or purchase is a click, a purchase a conversion.

    A narrow projection of the scan, which reads only the columns still needed
    and, given ``since``, skips row groups of earlier days.
    """
    pin_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    clicked = F.col("event_type").isin("click", "purchase")
    purchased = F.col("event_type") == "purchase"
    delay = _DELAY_LEAST + F.pmod(F.col("event_id") * _DELAY_STEP, F.lit(_DELAY_SPAN))
    return events.select(
        E.event_id(F.col("event_id")).alias("event_id"),
        F.lit("ad_event").alias("event_type"),
        seconds.alias("timestamp"),
        E.iso_time(seconds).alias("event_time"),
        E.padded("user_", F.col("user_id"), 6).alias("uid"),
        F.get_json_object("props", "$.k").try_cast("int").alias("campaign"),
        clicked.cast("int").alias("click"),
        purchased.cast("int").alias("conversion"),
        F.when(purchased, seconds + delay).alias("conversion_timestamp"),
        F.when(clicked, F.col("value")).otherwise(F.lit(0.0)).alias("cost"),
    )


def number(events: DataFrame) -> Column:
    """The event table's own number, from the id."""
    return F.substring("event_id", 5, 20).cast("bigint")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON messages of a topic with three partitions."""
    return as_messages(ad_events(spark, sf_dir))


def as_messages(events: DataFrame, sent: Column | None = None) -> DataFrame:
    """Combined events as messages, sent at their own time or at ``sent`` seconds."""
    n = number(events)
    return events.select(
        E.blank_to_null(F.col("uid")).alias("key"),
        F.to_json(F.struct(*schemas.EVENT.names), {"ignoreNullFields": "false"}).alias("value"),
        F.lit(schemas.TOPICS["ad_event"]).alias("topic"),
        F.pmod(n, F.lit(3)).cast("int").alias("partition"),
        F.floor(n / 3).cast("bigint").alias("offset"),
        E.epoch_to_timestamp(F.col("timestamp") if sent is None else sent).alias("timestamp"),
    )
