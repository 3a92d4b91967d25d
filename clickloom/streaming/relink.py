"""Impressions, clicks and conversions of separate topics joined again as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions import events as E

#: How much later a click and a conversion may happen than their impression, how late
#: a message may arrive, and how far its event may lie ahead of the message.
CLICK_WITHIN = "1 hour"
CONVERT_WITHIN = "30 days"
LATE = "1 day"
AHEAD = "1 day"

_FIELDS = T.StructType(
    [f for f in schemas.EVENT if f.name in schemas.IMPRESSION_MESSAGE]
    + [T.StructField("conversion_delay_sec", T.LongType())]
)


def feed(messages: DataFrame, late: str = LATE, ahead: str = AHEAD) -> DataFrame:
    """Events of one topic's messages, with their time ``at`` as watermark.

    Messages without id or time are left out: nothing can be linked to them.
    So are those whose event lies further ahead of the message than ``ahead``; one
    absurd time would otherwise move the watermark past everything that is to come.
    """
    read = F.from_json(F.col("value").cast("string"), _FIELDS)
    events = messages.select(F.col("timestamp").alias("_sent"), F.inline(F.array(read)))
    events = events.withColumn("at", E.epoch_to_timestamp(F.col("timestamp")))
    sane = F.col("at") <= F.col("_sent") + F.expr(f"INTERVAL {ahead}")
    return events.filter(F.col("event_id").isNotNull() & sane).drop("_sent").withWatermark("at", late)


def relinked(
    impressions: DataFrame,
    clicks: DataFrame,
    conversions: DataFrame,
    click_within: str = CLICK_WITHIN,
    convert_within: str = CONVERT_WITHIN,
) -> DataFrame:
    """Three feeds (``feed``) to one row for each impression, with its click and its conversion.

    The same rows as the batch ``relink`` of feeds that hold each id once. A row
    comes out when both partners are there or, without them, when the watermark, that
    of the slowest topic, is so far past the impression that none can come any more. Until then it
    is state, which is all that is kept: of an impression for both intervals at most.
    After a restart the watermark moves on once every topic has brought a message.
    What arrives behind the watermark is dropped and counted in the query's progress; the raw
    zone has it, and the batch form links it.
    """
    clicked = clicks.select(
        F.col("event_id").alias("click_id"),
        F.col("timestamp").alias("click_timestamp"),
        F.col("at").alias("clicked_at"),
    )
    converted = conversions.select(
        F.col("event_id").alias("conversion_id"),
        F.col("timestamp").alias("conversion_timestamp"),
        "conversion_delay_sec",
        F.col("at").alias("converted_at"),
    )

    def follows(at: str, key: str, within: str):
        return (
            (F.col("event_id") == F.col(key))
            & (F.col(at) >= F.col("at"))
            & (F.col(at) <= F.col("at") + F.expr(f"INTERVAL {within}"))
        )

    return (
        impressions.select("event_id", "timestamp", "uid", "campaign", "cost", "at")
        .join(clicked, follows("clicked_at", "click_id", click_within), "left")
        .join(converted, follows("converted_at", "conversion_id", convert_within), "left")
        .select(
            "event_id",
            "timestamp",
            "uid",
            "campaign",
            "cost",
            "click_timestamp",
            "conversion_timestamp",
            "conversion_delay_sec",
        )
    )
