"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Some row of each key; which one may differ from run to run."""
    return df.dropDuplicates(list(keys))


def latest_row(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key and task before the shuffle, so a key that
    holds most of the table costs no more than any other.
    """
    newest = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def message_order(prefix: str = "kafka_") -> list[Column]:
    """Newest message first: by broker time, then offset within the lower partition."""
    return [
        F.col(f"{prefix}timestamp").desc(),
        F.col(f"{prefix}partition").asc_nulls_last(),
        F.col(f"{prefix}offset").desc(),
    ]
