"""Written intermediate tables, in the folder the cluster shares for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from clickloom.sinks import files

_local_roots: dict[str, str] = {}
_written: list[str] = []


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in local mode without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="clickloom-")
    return _local_roots[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of it: short lineage, fixed rows, prunable columns.

    It stays, as a checkpoint does, until ``clear``.
    """
    path = new_path(df.sparkSession, label)
    _written.append(path)
    return _write(df, path)


def clear(spark: SparkSession) -> None:
    """Delete what ``written`` wrote in this process; frames built on it are void then."""
    while _written:
        files.delete(spark, _written.pop())


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``written`` for the length of a block; kept for inspection if the block fails."""
    path = new_path(df.sparkSession, label)
    yield _write(df, path)
    files.delete(df.sparkSession, path)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
