"""Field expressions on literal rows."""

import pytest
from pyspark.sql import functions as F

from clickloom.functions import events as E


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "text, number",
    [("12", 12), (" 12 ", 12), ("+5", 5), ("-7", -7), ("1.0", 0), ("", 0), ("x", 0), (None, 0), ("1e3", 0)],
)
def test_safe_int(spark, text, number):
    assert value(spark, E.safe_int(F.lit(text).cast("string"))) == number


def test_safe_int_without_default(spark):
    assert value(spark, E.safe_int(F.lit("x"), None)) is None


@pytest.mark.parametrize("text, number", [("1.5", 1.5), ("", 0.0), ("x", 0.0), (None, 0.0)])
def test_safe_float(spark, text, number):
    assert value(spark, E.safe_float(F.lit(text).cast("string"))) == number


def test_epoch_to_timestamp_survives_absurd_values(spark):
    shown = E.epoch_to_timestamp(F.lit(1_704_067_200)).cast("string")
    assert value(spark, shown) == "2024-01-01 00:00:00"
    assert value(spark, E.epoch_to_timestamp(F.lit(2**63 - 1))) is None
    assert value(spark, E.epoch_to_timestamp(F.lit(None).cast("bigint"))) is None


def test_times_as_text(spark):
    assert value(spark, E.iso_time(F.lit(1_704_067_261))) == "2024-01-01T00:01:01"
    start, end = F.lit(1_704_067_200), F.lit(1_704_153_660)
    assert value(spark, E.period(start, end)) == "2024-01-01 00:00 ~ 2024-01-02 00:01"
    assert value(spark, E.period(F.lit(None).cast("bigint"), end)) == "N/A"


def test_event_id(spark):
    assert value(spark, E.event_id(F.lit(42))) == "evt_00000042"
    assert value(spark, E.event_id(F.lit(123456789), "b2_")) == "b2_123456789"


def test_conversion_delay_keeps_its_sign(spark):
    def delay(conversion):
        return value(spark, E.conversion_delay(F.lit(100), F.lit(conversion), F.lit(40)))

    assert delay(1) == -60
    assert delay(0) is None
    assert delay(2) is None


def test_ratios_without_a_base(spark):
    zero, one = F.lit(0), F.lit(1)
    assert value(spark, E.percent(one, zero)) == 0
    assert value(spark, E.percent(one, F.lit(8))) == 12.5
    assert value(spark, E.per_unit(F.lit(3.0), zero)) is None


@pytest.mark.parametrize(
    "conversion, converted, flag, positive, present",
    [
        (1, 110, True, True, True),
        (1, 100, True, False, True),
        (1, None, True, False, False),
        (0, 110, False, False, False),
        (None, 110, False, False, False),
        (2, 110, True, True, True),
    ],
)
def test_conversion_rules(spark, conversion, converted, flag, positive, present):
    def holds(rule):
        return value(
            spark,
            E.is_conversion(
                rule, F.lit(conversion).cast("int"), F.lit(converted).cast("bigint"), F.lit(100)
            ),
        )

    assert (holds("flag"), holds("positive_delay"), holds("has_timestamp")) == (
        flag,
        positive,
        present,
    )


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        E.is_conversion("some", F.lit(1), F.lit(1), F.lit(1))


def test_click_delay_is_seeded_and_in_range(spark):
    ids = spark.range(2000).select(E.event_id(F.col("id")).alias("id"))
    delays = ids.select(E.click_delay(F.col("id"), 42).alias("a"), E.click_delay(F.col("id"), 7).alias("b"))
    low, high, same = delays.agg(F.min("a"), F.max("a"), F.sum((F.col("a") == F.col("b")).cast("int"))).first()
    assert (low, high) == (1, 30)
    assert same < 200
