"""Positions in an order over the whole table, without a single-task window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sinks import scratch

# Rows one task may order by itself.
SMALL = 10_000
# Counters a selection step brings to the driver.
BUCKETS = 16_384
# A limit up to here is Spark's own top-k, in which one task sorts that many
# rows of every other task; more would not do over a million input splits.
TOP_K = 100

# The low bits of monotonically_increasing_id count rows within a partition.
_POSITION_MASK = (1 << 33) - 1


def laid_out(df: DataFrame, order: Sequence[str] | None) -> DataFrame:
    """``df`` written in order, each row with its part ``_part`` and place in it ``_pos``.

    Parts are ranges of the whole sort key, so a hot leading value is split as
    long as ``order`` ends in something unique. Without an order the rows stay
    as scanned and nothing is shuffled. The table is written because a range
    partitioning worked out twice need not come out the same.
    """
    rows = df
    if order:
        rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)),
        }
    )
    return scratch.written(rows, "laid-out")


def with_row_index(df: DataFrame, order: Sequence[str] | None, name: str = "row_idx") -> DataFrame:
    """Add the exact 0-based position of each row in ``order`` (or in scan order)."""
    rows = laid_out(df, order)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part of the layout: small by construction, whatever the data.
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        rows.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )


def first_n(
    df: DataFrame, order: Sequence[str], n: int, bounds: tuple[int, int] | None = None
) -> DataFrame:
    """The first ``n`` rows in ``order`` (not sorted): a top-k, or else a ``split_at``.

    NULLs in the leading column are refused either way, unless its ``bounds`` say there are none.
    """
    if n <= TOP_K:
        if not bounds and not df.filter(F.col(order[0]).isNull()).isEmpty():
            raise ValueError(f"{order[0]} holds NULLs, which have no place in the order")
        return df.orderBy(*order).limit(n)
    return split_at(df, order, n, bounds)[0]


def split_at(
    df: DataFrame,
    order: Sequence[str],
    n: int | Callable[[int], int],
    bounds: tuple[int, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows in ``order`` and the rest, as two filters.

    ``n`` may be worked out from the number of rows. The leading column must be
    a BIGINT without NULLs; where its ``bounds`` are known, they need not be
    looked for.

    Only the sort key at the cut is looked for: histograms of the leading
    column narrow it down to one value or a few rows, so the rows themselves
    are neither sorted nor shuffled. The key need not be unique: copies of the
    row at the cut are divided by their place in the scan.
    """
    lead = order[0]
    if bounds:
        (low, high), total = bounds, df.count()
    else:
        low, high, total, ranked = df.agg(
            F.min(lead), F.max(lead), F.count(F.lit(1)), F.count(lead)
        ).first()
        if ranked < total:
            raise ValueError(f"{lead} holds NULLs, which have no place in the order")
    if callable(n):
        n = n(total)
    if n <= 0:
        return df.limit(0), df
    if n >= total:
        return df, df.limit(0)

    reach = _narrow(df, lead, n, low, high, total)
    inside = F.col(lead).between(reach.low, reach.high)
    cut = _cut(df.filter(inside), order, n - reach.below, reach.rows)

    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.struct(*[F.col(name) for name in order])
    at = F.struct(*[F.lit(cut.key[name]).cast(types[name]).alias(name) for name in order])
    lead_at = F.lit(cut.key[lead]).cast(types[lead])
    # The tests on the leading column alone can be pushed into the scan.
    if cut.taken == cut.copies:
        return (
            df.filter((F.col(lead) <= lead_at) & (key <= at)),
            df.filter((F.col(lead) >= lead_at) & (key > at)),
        )
    below = df.filter((F.col(lead) <= lead_at) & (key < at))
    above = df.filter((F.col(lead) >= lead_at) & (key > at))
    copies = with_row_index(df.filter((F.col(lead) == lead_at) & (key == at)), None, "_copy")
    taken = copies.filter(F.col("_copy") < cut.taken).drop("_copy")
    left = copies.filter(F.col("_copy") >= cut.taken).drop("_copy")
    return below.unionByName(taken), above.unionByName(left)


@dataclass(frozen=True)
class _Reach:
    """A range of the leading column that holds the cut: rows before it and in it."""

    low: int
    high: int
    below: int
    rows: int


@dataclass(frozen=True)
class _Cut:
    """The key of the last row of the first part, and how its copies divide."""

    key: dict
    copies: int
    taken: int


def _narrow(df: DataFrame, lead: str, n: int, low: int, high: int, rows: int) -> _Reach:
    below = 0
    while rows > SMALL and low < high:
        shift = 0
        while (high >> shift) - (low >> shift) >= BUCKETS:
            shift += 1
        counts = (
            df.filter(F.col(lead).between(low, high))
            .groupBy(F.shiftright(lead, shift).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .orderBy("bucket")
            .collect()
        )
        for bucket, size in counts:
            if n <= below + size:
                low, high = max(low, bucket << shift), min(high, ((bucket + 1) << shift) - 1)
                rows = size
                break
            below += size
    return _Reach(low, high, below, rows)


def _cut(group: DataFrame, order: Sequence[str], n: int, rows: int) -> _Cut:
    """Find the ``n``-th row's key (1-based) in a group known to hold ``rows`` rows."""
    # Copies of one key become one row here, so none is left to be hot.
    keys = group.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    if rows > SMALL:
        parts = laid_out(keys, order)
        for part, size in (
            parts.groupBy("_part").agg(F.sum("_copies")).orderBy("_part").collect()
        ):
            if n <= size:
                keys = parts.filter(F.col("_part") == part)
                break
            n -= size
        # A part is one shuffle task's load; runs of SMALL places in it narrow it down further.
        run = F.floor(F.col("_pos") / SMALL)
        for at, size in keys.groupBy(run.alias("run")).agg(F.sum("_copies")).orderBy("run").collect():
            if n <= size:
                keys = keys.filter(run == at)
                break
            n -= size
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        keys.withColumn("_upto", F.sum("_copies").over(running))
        .filter(F.col("_upto") >= n)
        .orderBy("_upto")
        .first()
    )
    key = {name: found[name] for name in order}
    return _Cut(key, found["_copies"], n - (found["_upto"] - found["_copies"]))
