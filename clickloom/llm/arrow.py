"""Python on the executors, one bounded slice of rows at a time."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows handed to a function, or returned by it, at a time.
ROWS = 512


#: Bytes Spark hands to a Python worker at a time, unless the session says otherwise: long texts make
#: batches of few rows, and neither side of the pipe holds many at once.
BYTES = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did, and keep their batches small.

    Clusters without that folder get the package by ``--py-files``.
    """
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, BYTES)
    environment = spark.sparkContext.environment
    top = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if top not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [top, *paths]))


def map_rows(
    df: DataFrame,
    function: Callable[[list[dict]], list[dict]],
    schema: str | StructType,
    rows: int = ROWS,
) -> DataFrame:
    """``function`` over slices of at most ``rows`` rows: lists of dicts in, lists of dicts out.

    Any number of rows may come back for a slice. It is a narrow step: no shuffle, and a lost task is
    simply run again.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(wanted)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for start in range(0, batch.num_rows, rows):
                made = function(batch.slice(start, rows).to_pylist())
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=target)

    importable(df.sparkSession)
    return df.mapInArrow(batches, wanted)


def map_groups(
    df: DataFrame,
    keys: list[str],
    function: Callable[[list[dict]], list[dict]],
    schema: str | StructType,
    unique: str | None = None,
) -> DataFrame:
    """``function`` over the rows of each group, as a list of dicts.

    Like a grouped map, but thousands of small groups cost little: a task gets its groups sorted and cuts
    them apart itself. One group is in memory at a time, so groups must be bounded. Of a group's rows with the same value in
    the column ``unique`` only the first is held.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(wanted)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        group: list[dict] = []
        held: set = set()
        current = None
        for batch in source:
            for start in range(0, batch.num_rows, ROWS):
                for row in batch.slice(start, ROWS).to_pylist():
                    key = [row[name] for name in keys]
                    if key != current:
                        if group:
                            made += function(group)
                        group, held, current = [], set(), key
                        if len(made) >= ROWS:
                            yield pa.RecordBatch.from_pylist(made, schema=target)
                            made = []
                    if unique is not None:
                        if row[unique] in held:
                            continue
                        held.add(row[unique])
                    group.append(row)
        if group:
            made += function(group)
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=target)

    importable(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(batches, wanted)


def map_sorted(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    function: Callable[[Iterator[dict]], Iterator[dict]],
    schema: str | StructType,
) -> DataFrame:
    """``function`` over all rows of a task, dicts that come one by one each way.

    Rows with equal ``keys`` are in one task, sorted by ``keys`` and then ``order``. Nothing is gathered here but a slice.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(wanted)

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in source:
            for start in range(0, batch.num_rows, ROWS):
                yield from batch.slice(start, ROWS).to_pylist()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        for row in function(rows(source)):
            made.append(row)
            if len(made) >= ROWS:
                yield pa.RecordBatch.from_pylist(made, schema=target)
                made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=target)

    importable(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(batches, wanted)


#: Keys a task remembers in looking for repeated rows.
REMEMBERED = 500_000


def without_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` without most rows whose ``keys`` an earlier row of the same task has.

    A narrow step ahead of a shuffle, so that a row that is repeated many times arrives once from each task. A task remembers REMEMBERED
    keys at a time: what must be unique in the end is still to be made so.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in source:
            fresh = []
            for key in zip(*(batch.column(name).to_pylist() for name in keys), strict=True):
                fresh.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(fresh, pa.bool_()))
            if len(seen) > REMEMBERED:
                seen.clear()

    importable(df.sparkSession)
    return df.mapInArrow(batches, df.schema)
