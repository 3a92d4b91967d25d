"""Column expressions for event fields. All are built-in, so they stay in codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clickloom import schemas

# The last second whose microseconds still fit a BIGINT.
_MAX_SECOND = 9_223_372_036_854


def safe_int(text: Column, default: int | None = 0) -> Column:
    """A whole number from text, or ``default`` for anything that is not one ("1.0" is not).

    The pattern is tested first because a failing try_cast costs an exception,
    many times the price of the row; what is left for it are overlong numbers.
    """
    number = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast("bigint"))
    return number if default is None else F.coalesce(number, F.lit(default).cast("bigint"))


def safe_float(text: Column, default: float = 0.0) -> Column:
    number = F.when(F.trim(text) != "", text.try_cast("double"))
    return F.coalesce(number, F.lit(float(default)))


def number_in(df: DataFrame, name: str) -> Column:
    """A column that may be typed or still text as a whole number, NULL where it is none."""
    column = df[name]
    if isinstance(df.schema[name].dataType, StringType):
        return safe_int(column, None)
    return column.cast("bigint")


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def epoch_to_timestamp(seconds: Column) -> Column:
    """NULL where the instant cannot be held, so one absurd message cannot stop a stream."""
    return F.when(seconds.between(-_MAX_SECOND, _MAX_SECOND), F.timestamp_seconds(seconds))


def iso_time(seconds: Column) -> Column:
    return F.date_format(epoch_to_timestamp(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def period(first: Column, last: Column) -> Column:
    def label(seconds: Column) -> Column:
        return F.date_format(epoch_to_timestamp(seconds), "yyyy-MM-dd HH:mm")

    return F.coalesce(F.concat(label(first), F.lit(" ~ "), label(last)), F.lit("N/A"))


def padded(prefix: str, number: Column, digits: int) -> Column:
    """``prefix`` and the number with leading zeros; longer numbers stay whole.

    Several times as fast as format_string, which starts a formatter per row.
    """
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0")))


def event_id(index: Column, prefix: str = "evt_") -> Column:
    return padded(prefix, index, 8)


def seeded_md5(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def hex_prefix(digest: Column, digits: int) -> Column:
    """The leading hex digits of a digest as a number (15 of them still fit a BIGINT)."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def click_delay(key: Column, seed: int) -> Column:
    """1 to 30 seconds drawn from the event's own id, so no row depends on another."""
    return F.pmod(hex_prefix(seeded_md5(key, seed), 8), F.lit(30)) + 1


def rebase(seconds: Column, base: int | None) -> Column:
    """Moved by ``base``; NULL beyond BIGINT, so that one absurd time cannot stop a job."""
    return seconds if base is None else F.try_add(seconds, F.lit(base).cast("bigint"))


def conversion_delay(df_timestamp: Column, conversion: Column, conversion_timestamp: Column) -> Column:
    return F.when(conversion == 1, F.try_subtract(conversion_timestamp, df_timestamp))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def per_unit(total: Column, units: Column) -> Column:
    return F.when(units > 0, total / units)


def is_click(click: Column) -> Column:
    return F.coalesce(click, F.lit(0)) != 0


def is_conversion(
    rule: str, conversion: Column, conversion_timestamp: Column, timestamp: Column
) -> Column:
    """The three ways a row may count as a conversion.

    ``flag``: the flag is set. ``positive_delay``: it also happened after the
    impression. ``has_timestamp``: it also carries any time at all.
    """
    flagged = F.coalesce(conversion, F.lit(0)) != 0
    if rule == "flag":
        return flagged
    if rule == "positive_delay":
        return flagged & F.coalesce(conversion_timestamp > timestamp, F.lit(False))
    if rule == "has_timestamp":
        return flagged & conversion_timestamp.isNotNull()
    raise ValueError(f"unknown conversion rule {rule!r}")


def parse_ok(df: DataFrame) -> Column:
    """False for a raw row in which no field of the payload could be read."""
    return reduce(lambda a, b: a | b, [df[name].isNotNull() for name in schemas.EVENT.names])
