"""Time since the previous event of the same group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators import ranking

# A group is hot if it holds more than this share of all rows; there can be
# no more hot groups than this, so their list is always small.
SHARES = 20_000
# Fewer rows than this are never worth splitting.
HOT_ROWS = 5_000_000


def with_gap(
    df: DataFrame,
    group: str = "uid",
    time: str = "timestamp",
    tie: str = "event_id",
    name: str = "gap_sec",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the difference to the previous ``time`` in the group (NULL for its first row, or beyond BIGINT).

    ``tie`` must make (group, time, tie) unique. Ordinary groups take one
    window. A hot group is laid out over many tasks in its own order, and only
    the last row of each part is carried to the next.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = sizes.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(hot_rows, (total or 0) // SHARES)
    if (largest or 0) <= limit:
        return _by_window(df, group, time, tie, name)

    hot = [row[0] for row in sizes.filter(F.col("_rows") > limit).select(group).collect()]
    listed = df.sparkSession.createDataFrame([(value,) for value in hot], df.select(group).schema)
    is_hot = F.col(f"e.{group}").eqNullSafe(F.col(f"h.{group}"))
    names = F.broadcast(listed.alias("h"))
    cold_rows = df.alias("e").join(names, is_hot, "left_anti")
    hot_part = df.alias("e").join(names, is_hot, "left_semi")
    return _by_window(cold_rows, group, time, tie, name).unionByName(
        _by_layout(hot_part, group, time, tie, name)
    )


def _by_window(df: DataFrame, group: str, time: str, tie: str, name: str) -> DataFrame:
    ordered = Window.partitionBy(group).orderBy(time, tie)
    return df.withColumn(name, F.try_subtract(F.col(time), F.lag(time).over(ordered)))


def _by_layout(df: DataFrame, group: str, time: str, tie: str, name: str) -> DataFrame:
    rows = ranking.laid_out(df, [group, time, tie])
    here = F.struct(F.col(group).alias("group"), F.col(time).alias("time"))
    last = rows.groupBy("_part").agg(F.max_by(here, "_pos").alias("_last"))
    # One row per part of the layout.
    carried = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_carried"))
    within = Window.partitionBy("_part").orderBy("_pos")
    previous = F.coalesce(F.lag(here).over(within), F.col("_carried"))
    same_group = F.col("_previous.group").eqNullSafe(F.col(group))
    return (
        rows.join(F.broadcast(carried), "_part")
        .withColumn("_previous", previous)
        .withColumn(
            name,
            F.when(
                F.col("_previous").isNotNull() & same_group,
                F.try_subtract(F.col(time), F.col("_previous.time")),
            ),
        )
        .drop("_part", "_pos", "_carried", "_previous")
    )
