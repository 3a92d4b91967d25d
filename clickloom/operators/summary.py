"""Daily campaign metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import events as E
from clickloom.functions.exact import exact_sum


def recent(column: str, days: int, as_of: date | None = None) -> Column:
    """On or after the day ``days`` before ``as_of`` (today unless given).

    Inclusive at that end and open at the other, so 7 keeps eight dates and
    whatever lies in the future; NULL dates drop. A literal once planned, so it
    prunes partitions.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.col(column) >= F.date_sub(today, days)


def campaign_days(events: DataFrame) -> DataFrame:
    """Counts and ratios per date and campaign; every row is one impression.

    Costs add up to the same bits in any order, so that summing again gives what is there.
    Rows are summed within each task first, so a campaign with most of the
    traffic sends no more to the shuffle than any other.
    """
    totals = events.groupBy(F.col("event_date").alias("summary_date"), "campaign").agg(
        F.count(F.lit(1)).alias("impressions"),
        F.sum("click").alias("clicks"),
        F.sum("conversion").alias("conversions"),
        exact_sum("cost").alias("total_cost"),
    )
    return with_ratios(totals)


def with_ratios(totals: DataFrame) -> DataFrame:
    """CTR and CVR in percent, 0 without a base; CPA, NULL without a conversion."""
    return totals.withColumns(
        {
            "ctr": E.percent(F.col("clicks"), F.col("impressions")),
            "cvr": E.percent(F.col("conversions"), F.col("clicks")),
            "cpa": E.per_unit(F.col("total_cost"), F.col("conversions")),
        }
    )
