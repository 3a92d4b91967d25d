"""Rows to keyed JSON messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import events as E

_FIELDS = {
    "ad_event": tuple(schemas.EVENT.names),
    "impression": schemas.IMPRESSION_MESSAGE,
    "click": schemas.CLICK_MESSAGE,
    "conversion": schemas.CONVERSION_MESSAGE,
}


def _json(columns) -> Column:
    # The default would leave NULL fields out of the message.
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def encode_events(df: DataFrame) -> DataFrame:
    """Combined events as messages of one topic, keyed by user."""
    return df.select(
        E.blank_to_null(F.col("uid")).alias("key"),
        _json(schemas.EVENT.names).alias("value"),
        F.lit(schemas.TOPICS["ad_event"]).alias("topic"),
    )


def encode_feed(df: DataFrame, *more: Column) -> DataFrame:
    """A mixed feed as messages, each row with its own kind's fields and topic, and ``more`` columns of the feed."""
    kinds = ("impression", "click", "conversion")

    def by_kind(value) -> Column:
        return reduce(
            lambda built, kind: built.when(F.col("event_type") == kind, value(kind)), kinds, F
        )

    return df.select(
        E.blank_to_null(F.col("uid")).alias("key"),
        by_kind(lambda kind: _json(_FIELDS[kind])).alias("value"),
        by_kind(lambda kind: F.lit(schemas.TOPICS[kind])).alias("topic"),
        *more,
    )


def publish_kafka(df: DataFrame, bootstrap_servers: str) -> None:
    """Needs Spark's own Kafka connector on the classpath."""
    df.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()


def publish_files(df: DataFrame, path: str, mode: str = "append") -> None:
    """The same messages as JSON lines, for clusters without a broker."""
    df.write.mode(mode).json(path)


def publish_topics(df: DataFrame, path: str, mode: str = "append") -> None:
    """``publish_files`` of several topics from one pass, each into its ``topic_path``."""
    df.withColumn("to", F.col("topic")).write.mode(mode).partitionBy("to").json(path)


def topic_path(path: str, topic: str) -> str:
    return f"{path}/to={topic}"
