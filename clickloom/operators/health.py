"""Checks an operator of the tables runs every day."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import merge


def freshness(
    processed: DataFrame, now: datetime | None = None, today: date | None = None
) -> DataFrame:
    """Newest update and event date, and how old they are."""
    at = F.current_timestamp() if now is None else F.lit(now)
    day = F.current_date() if today is None else F.lit(today)
    return processed.agg(
        F.max("updated_at").alias("newest_update"), F.max("event_date").alias("newest_event_date")
    ).withColumns(
        {
            "update_age_sec": F.unix_timestamp(at) - F.unix_timestamp("newest_update"),
            "event_age_days": F.datediff(day, "newest_event_date"),
        }
    )


def rows_per_day(processed: DataFrame) -> DataFrame:
    return processed.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


def rows_per_day_from_footers(spark: SparkSession, path: str, partition: str = "event_date") -> DataFrame:
    """``rows_per_day`` of a folder table from the row counts in its files' footers: no column is read.

    Its own session lets Spark push the counting into the files, which the reader of
    the other plans does not do. The newest event date is the largest date in it.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session.read.parquet(path).groupBy(partition).agg(F.count(F.lit(1)).alias("rows"))


def duplicate_keys(processed: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys that are not unique, with their number of rows; empty for a healthy table."""
    return merge.duplicate_keys(processed, [key])


def file_layout(spark: SparkSession, path: str, *partitions: str) -> DataFrame:
    """Files per partition and their sizes, from the listing alone: no data is read."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    )
    return listing.groupBy(*(partitions or ("event_date",))).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.avg("length").alias("mean_bytes"),
        F.max("length").alias("largest_bytes"),
    )
