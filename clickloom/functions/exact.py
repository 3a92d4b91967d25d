"""Sums of doubles that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers below this size are summed exactly; each of the three sums holds 2**37 of them.
LIMIT = 2.0**25
_MIDDLE, _LOW = 2.0**26, 2.0**52


def exact_sum(column: Column | str) -> Column:
    """The sum of a double column as an aggregate; the same bits whatever the partitioning.

    Every number becomes three whole numbers, of units, 2**-26 and 2**-52 (what is finer is
    cut off), whose sums have no order. Should a group hold a number of LIMIT or more, or
    none at all such as NaN, its sum is Spark's ordinary one. NULLs are skipped; only NULLs give NULL.
    """
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    fits = F.abs(value) < LIMIT
    safe = F.when(fits, value)
    high = F.floor(safe)
    rest = (safe - high) * _MIDDLE
    middle = F.floor(rest)
    low = F.floor((rest - middle) * _MIDDLE)
    exact = F.sum(high) + F.sum(middle) / _MIDDLE + F.sum(low) / _LOW
    return F.when(F.count(value) == F.count(safe), exact).otherwise(F.sum(value))
