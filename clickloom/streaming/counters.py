"""Counts of what a running stream has sent, kept by batch."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from clickloom.operators.fanout import counts
from clickloom.sinks import files

_SCHEMA = "query string, batch bigint, kind string, events bigint"


def observed(feed: DataFrame, name: str = "sent") -> DataFrame:
    """A feed that reports, with each batch's progress, how many events of each kind passed."""
    return feed.observe(name, *counts())


class BatchCounters(StreamingQueryListener):
    """Writes the counts of each batch to a file of its own, named by query and batch.

    A batch repeated after a failure overwrites its file, so it counts once. The
    query's id comes from its checkpoint: a restart goes on under the same one.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "sent") -> None:
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        # A trigger without a batch reports again, with nothing counted.
        if found is None or not progress.numInputRows:
            return
        lines = [
            {"query": str(progress.id), "batch": progress.batchId, "kind": kind, "events": n}
            for kind, n in found.asDict().items()
        ]
        text = "".join(json.dumps(line) + "\n" for line in lines)
        files.write_text(self.spark, f"{self.path}/{progress.id}-{progress.batchId}.json", text)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def wait_for(spark: SparkSession, path: str, query: StreamingQuery, seconds: float = 60) -> None:
    """Until the last batch of a query that has ended is counted: listeners hear of a batch a little later."""
    reported = [p for p in query.recentProgress if p.numInputRows]
    if not reported:
        return
    last = f"{path}/{reported[-1].id}-{reported[-1].batchId}.json"
    end = time.monotonic() + seconds
    while not files.exists(spark, last):
        if time.monotonic() > end:
            raise TimeoutError(f"no counts at {last}")
        time.sleep(0.05)


def by_batch(spark: SparkSession, path: str) -> DataFrame:
    """query, batch, kind and events."""
    return spark.read.schema(_SCHEMA).json(path)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Events of each kind over all batches."""
    return by_batch(spark, path).groupBy("kind").agg(F.sum("events").alias("events"))


def uncounted(spark: SparkSession, path: str, query: str, last_batch: int) -> DataFrame:
    """Batches of a query up to ``last_batch`` without a count: empty ones, or those whose driver died right after the commit."""
    known = by_batch(spark, path).filter(F.col("query") == query).select("batch").distinct()
    return spark.range(last_batch + 1).withColumnRenamed("id", "batch").join(known, "batch", "left_anti")
