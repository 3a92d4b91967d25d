"""Statistics kept by day as sketches, merged over any period without reading events again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import events as E
from clickloom.functions.exact import exact_sum

#: log2 of a distinct count's registers: three standard errors are 1.04 / sqrt(2**14) * 3.
REGISTERS = 14
ERROR = 0.025
#: Size of a quantile sketch; the rank of a quantile is off by less than RANK_ERROR, with 99 % confidence.
QUANTILES = 200
RANK_ERROR = 0.0133


def by_day(events: DataFrame) -> DataFrame:
    """One row for each day (NULL for events without time): exact sums, and sketches of users, campaigns and conversion delays.

    Partial sketches are made in tasks, so a hot day sends no more to the shuffle than any other.
    """
    day = F.to_date(E.epoch_to_timestamp(F.col("timestamp")))
    delay = F.try_subtract(F.col("conversion_timestamp"), F.col("timestamp"))
    counts = (F.col("conversion") != 0) & (delay > 0)
    return events.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum("click"), F.lit(0)).alias("clicks"),
        F.coalesce(F.sum("conversion"), F.lit(0)).alias("conversions"),
        exact_sum("cost").alias("total_cost"),
        F.hll_sketch_agg("uid", REGISTERS).alias("user_sketch"),
        F.hll_sketch_agg("campaign", REGISTERS).alias("campaign_sketch"),
        F.kll_sketch_agg_bigint(F.when(counts, delay), QUANTILES).alias("delay_sketch"),
    )


def over(daily: DataFrame, first: date | None = None, last: date | None = None, at=(0.5, 0.9, 0.99)) -> DataFrame:
    """The period's sums, numbers of users and campaigns, and delays at the ranks ``at`` (NULL without conversions).

    Distinct counts are off by less than ERROR three times out of a thousand; merging in another
    order changes nothing in them.
    """
    rows = daily
    if first is not None:
        rows = rows.filter(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("day") <= F.lit(last))
    merged = rows.agg(
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("events", "clicks", "conversions")),
        F.coalesce(exact_sum("total_cost"), F.lit(0.0)).alias("total_cost"),
        F.hll_union_agg("user_sketch").alias("user_sketch"),
        F.hll_union_agg("campaign_sketch").alias("campaign_sketch"),
        F.kll_merge_agg_bigint("delay_sketch").alias("delay_sketch"),
    )
    held = F.kll_sketch_get_n_bigint("delay_sketch") > 0
    ranks = F.array(*map(F.lit, at))
    return merged.select(
        "events",
        "clicks",
        "conversions",
        "total_cost",
        F.hll_sketch_estimate("user_sketch").alias("users"),
        F.hll_sketch_estimate("campaign_sketch").alias("campaigns"),
        F.when(held, F.kll_sketch_get_quantile_bigint("delay_sketch", ranks)).alias("delays"),
    )
