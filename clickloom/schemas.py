"""Declared schemas of every message, file and table."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names and types of the public event and table formats.
EVENT = StructType(
    [
        StructField("event_id", StringType()),
        StructField("event_type", StringType()),
        StructField("timestamp", LongType()),
        StructField("event_time", StringType()),
        StructField("uid", StringType()),
        StructField("campaign", IntegerType()),
        StructField("click", IntegerType()),
        StructField("conversion", IntegerType()),
        StructField("conversion_timestamp", LongType()),
        StructField("cost", DoubleType()),
    ]
)

# What a message stream delivers, whichever connector it comes from.
MESSAGE = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

RAW = StructType(
    [
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("kafka_timestamp", TimestampType()),
        StructField("event_id", StringType()),
        StructField("event_type", StringType()),
        StructField("timestamp", LongType()),
        StructField("event_time", StringType()),
        StructField("uid", StringType()),
        StructField("campaign", IntegerType()),
        StructField("click", IntegerType()),
        StructField("conversion", IntegerType()),
        StructField("conversion_timestamp", LongType()),
        StructField("cost", DoubleType()),
        StructField("event_timestamp", TimestampType()),
        StructField("ingest_ts", TimestampType()),
        StructField("raw_date", DateType()),
        StructField("raw_hour", IntegerType()),
    ]
)
RAW_PARTITIONS = ("raw_date", "raw_hour")

PROCESSED_EVENTS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("event_date", DateType()),
        StructField("uid", StringType()),
        StructField("campaign", IntegerType()),
        StructField("click", IntegerType()),
        StructField("conversion", IntegerType()),
        StructField("conversion_delay_sec", LongType()),
        StructField("cost", DoubleType()),
        StructField("updated_at", TimestampType()),
    ]
)

# Compares like the order of messages: time, then the lower partition, then offset.
VERSION = StructType(
    [
        StructField("kafka_timestamp", TimestampType()),
        StructField("partition", IntegerType()),
        StructField("kafka_offset", LongType()),
    ]
)

VERSIONED_EVENTS = StructType([*PROCESSED_EVENTS.fields, StructField("version", VERSION)])

CAMPAIGN_SUMMARY = StructType(
    [
        StructField("summary_date", DateType()),
        StructField("campaign", IntegerType()),
        StructField("impressions", LongType()),
        StructField("clicks", LongType()),
        StructField("conversions", LongType()),
        StructField("total_cost", DoubleType()),
        StructField("ctr", DoubleType()),
        StructField("cvr", DoubleType()),
        StructField("cpa", DoubleType()),
        StructField("updated_at", TimestampType()),
    ]
)

# Column lists of the public files and messages.
AD_EVENT_COLUMNS = (
    "timestamp",
    "uid",
    "campaign",
    "click",
    "conversion",
    "conversion_timestamp",
    "cost",
)
CATEGORY_COLUMNS = tuple(f"cat{i}" for i in range(1, 10))

IMPRESSION_COLUMNS = ("event_id", "event_type", "timestamp", "uid", "campaign", "cost")
CLICK_COLUMNS = (
    "event_id",
    "event_type",
    "timestamp",
    "impression_timestamp",
    "uid",
    "campaign",
)
CONVERSION_COLUMNS = CLICK_COLUMNS + ("conversion_delay_sec",)

# The same three kinds as messages: with a readable time, without the impression's.
IMPRESSION_MESSAGE = (
    "event_id",
    "event_type",
    "timestamp",
    "event_time",
    "uid",
    "campaign",
    "cost",
)
CLICK_MESSAGE = ("event_id", "event_type", "timestamp", "event_time", "uid", "campaign")
CONVERSION_MESSAGE = CLICK_MESSAGE + ("conversion_delay_sec",)

TOPICS = {
    "ad_event": "ad-events",
    "impression": "ad-impressions",
    "click": "ad-clicks",
    "conversion": "ad-conversions",
}

TARGET_FILE_BYTES = 134_217_728


def strings(columns) -> StructType:
    """A schema of string columns, for headered text files."""
    return StructType([StructField(name, StringType()) for name in columns])
