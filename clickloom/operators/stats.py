"""One-row statistics of an event set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clickloom.functions import events as E


def scan_stats(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Rows, and the range of ``column`` over those rows where it is a whole number."""
    seconds = E.number_in(df, column)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(seconds).alias("min_ts"),
        F.max(seconds).alias("max_ts"),
    )


def dataset_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Totals, rates, mean conversion delay, number of campaigns and period.

    A conversion's delay counts only if it came after the impression. The
    distinct count is exact unless ``approximate``.
    """
    click, conversion, seconds, converted = (
        F.coalesce(E.number_in(df, name), F.lit(0))
        for name in ("click", "conversion", "timestamp", "conversion_timestamp")
    )
    cost = df["cost"]
    if isinstance(df.schema["cost"].dataType, StringType):
        cost = E.safe_float(cost)
    delay = F.when((conversion != 0) & (converted > seconds), converted - seconds)
    campaign = F.coalesce(F.col("campaign").cast("string"), F.lit(""))
    campaigns = F.approx_count_distinct(campaign) if approximate else F.count_distinct(campaign)
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(click), F.lit(0)).alias("clicks"),
        F.coalesce(F.sum(conversion), F.lit(0)).alias("conversions"),
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("total_cost"),
        F.coalesce(F.avg(delay) / 3600, F.lit(0.0)).alias("avg_delay_hours"),
        campaigns.alias("campaigns"),
        F.min(seconds).alias("min_ts"),
        F.max(seconds).alias("max_ts"),
    )
    return totals.withColumns(
        {
            "ctr": E.percent(F.col("clicks"), F.col("total")),
            "cvr": E.percent(F.col("conversions"), F.col("clicks")),
            "cpa": E.per_unit(F.col("total_cost"), F.col("conversions")),
            "period": E.period(F.col("min_ts"), F.col("max_ts")),
        }
    )


def for_display(stats: DataFrame) -> DataFrame:
    """The figures as they are shown: two decimals, one for hours."""
    two = {name: F.round(name, 2) for name in ("total_cost", "ctr", "cvr", "cpa") if name in stats.columns}
    return stats.withColumns({**two, "avg_delay_hours": F.round("avg_delay_hours", 1)})
