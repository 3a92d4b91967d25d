"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom import schemas


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = "ad-events",
    starting_offsets: str = "earliest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of a topic; needs Spark's own Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    return reader.options(**(options or {})).load()


def file_messages(
    spark: SparkSession, path: str, fmt: str = "json", options: dict[str, str] | None = None
) -> DataFrame:
    """The same columns from a folder of message files, each file taken once."""
    return (
        spark.readStream.format(fmt)
        .schema(schemas.MESSAGE)
        .options(**(options or {}))
        .load(path)
    )


def rate(spark: SparkSession, rows_per_second: int = 5) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
