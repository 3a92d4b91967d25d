"""Merges that skip row groups by key, sums without order, and sketches by day."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickloom.functions.exact import exact_sum
from clickloom.operators import sketches
from clickloom.operators.summary import campaign_days
from clickloom.plans import event_table
from clickloom.sinks import tables

SF = "/root/testdata/sf0.01"


def processed(spark, n, cost=1.0):
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("event_id"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
        F.lit("u").alias("uid"), F.lit(1).alias("campaign"), F.lit(0).alias("click"), F.lit(0).alias("conversion"),
        F.lit(None).cast("bigint").alias("conversion_delay_sec"), F.lit(cost).alias("cost"),
        F.lit("2024-02-01").cast("timestamp").alias("updated_at"),
    )


def scanned(df):
    """Rows the scans of a plan gave, once it has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture()
def many_row_groups(spark, folder):
    table = tables.processed_events(folder)
    table.ensure(spark)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    try:
        table.append(processed(spark, 200_000))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    return table


def test_keys_in_no_order_skip_row_groups(spark, many_row_groups):
    rows = processed(spark, 20).withColumn("cost", F.lit(7.0))
    near = many_row_groups.read(spark).filter(many_row_groups._listed(rows))
    assert near.count() == 20
    by_range = many_row_groups.read(spark).filter(many_row_groups._arriving(rows)[1])
    assert scanned(near.select("event_id")) < 0.5 * scanned(by_range.select("event_id"))
    absent = spark.range(20).select(F.md5(F.concat(F.lit("x"), "id")).alias("event_id"))
    assert scanned(many_row_groups.read(spark).filter(many_row_groups._listed(absent)).select("event_id")) < 100_000


@pytest.mark.parametrize("most", [0, 10, tables.MOST_KEYS])
def test_results_do_not_depend_on_how_keys_are_found(spark, folder, monkeypatch, most):
    monkeypatch.setattr(tables, "MOST_KEYS", most)
    table = tables.processed_events(folder)
    table.ensure(spark)
    table.append(processed(spark, 3000))
    # more keys than one list holds, another day, and one without an id
    source = processed(spark, 4000, 2.0).filter("substring(event_id, 1, 1) < '8'").withColumn(
        "event_date", F.lit("2024-01-02").cast("date")
    )
    source = source.unionByName(processed(spark, 1, 3.0).withColumn("event_id", F.lit(None).cast("string")))
    for _ in range(2):
        table.upsert(source)
    rows = table.read(spark).collect()
    ids = [r.event_id for r in rows]
    assert len(set(ids)) == len(ids)
    moved = {r.event_id for r in rows if r.cost == 2.0}
    assert {str(r.event_date) for r in rows if r.event_id in moved} == {"2024-01-02"}
    assert len(moved) == source.count() - 1 and None in ids


def test_sums_have_the_same_bits_in_any_order(spark):
    rng = random.Random(1)
    values = [rng.choice([1e-9, 0.1, 3.3, 1e6]) * rng.uniform(-1, 1) for _ in range(20_000)]
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3 + 5 * seed)
        found.add(df.agg(exact_sum("v").alias("s")).first().s)
    assert len(found) == 1
    assert found.pop() == pytest.approx(math.fsum(values), abs=len(values) * 2.0**-52, rel=1e-15)


@pytest.mark.parametrize(
    ("values", "expected"),
    [([], None), ([None], None), ([None, 1.5], 1.5), ([2.0**25, 0.5], 2.0**25 + 0.5), ([-0.25, -2.5], -2.75), ([1e300, 1.0], 1e300),
     ([math.inf, 1.0], math.inf)],
)
def test_sums_of_few(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(exact_sum("v").alias("s")).first().s == expected
    if values:
        mixed = spark.createDataFrame([(v,) for v in [*values, math.nan]], "v double")
        assert math.isnan(mixed.agg(exact_sum("v").alias("s")).first().s)


def test_the_summary_has_the_same_bits_in_any_order(spark):
    rows = event_table.ad_events(spark, SF).select(
        F.to_date(F.timestamp_seconds("timestamp")).alias("event_date"), "campaign", "click", "conversion",
        (F.col("cost") / 7).alias("cost"),
    )
    def bits(df):
        return sorted((str(r.summary_date), r.campaign, r.total_cost, r.cpa) for r in campaign_days(df).collect())
    assert bits(rows) == bits(rows.repartition(13)) == bits(rows.orderBy(F.desc("cost")).repartition(5, "click"))


def test_sketches_by_day(spark, folder):
    events = event_table.ad_events(spark, SF)
    sketches.by_day(events).write.parquet(f"{folder}/days")
    days = spark.read.parquet(f"{folder}/days")
    day = F.to_date(F.timestamp_seconds("timestamp"))
    for first, last in ((None, None), (date(2024, 1, 5), date(2024, 1, 9))):
        mine = events if first is None else events.filter(day.between(F.lit(first), F.lit(last)))
        delays = sorted(
            r[0] for r in mine.filter("conversion = 1").select(F.col("conversion_timestamp") - F.col("timestamp")).collect()
        )
        exact = mine.agg(
            F.count(F.lit(1)).alias("n"), F.sum("click").alias("clicks"), F.count_distinct("uid").alias("users"),
            F.count_distinct("campaign").alias("campaigns"), exact_sum("cost").alias("cost"),
        ).first()
        found = sketches.over(days, first, last).first()
        assert (found.events, found.clicks, found.conversions) == (exact.n, exact.clicks, len(delays))
        assert found.total_cost == pytest.approx(exact.cost, rel=1e-12)
        assert abs(found.users - exact.users) <= sketches.ERROR * exact.users + 0.5
        assert abs(found.campaigns - exact.campaigns) <= sketches.ERROR * exact.campaigns + 0.5
        for rank, delay in zip((0.5, 0.9, 0.99), found.delays, strict=True):
            below = sum(d < delay for d in delays) / len(delays)
            upto = sum(d <= delay for d in delays) / len(delays)
            assert below - sketches.RANK_ERROR <= rank <= upto + sketches.RANK_ERROR
        shuffled = sketches.over(days.orderBy(F.rand(3)), first, last).first()
        assert (shuffled.users, shuffled.campaigns) == (found.users, found.campaigns)


def test_sketches_of_nothing(spark):
    none = event_table.ad_events(spark, SF).filter("false")
    found = sketches.over(sketches.by_day(none)).first()
    assert (found.events, found.clicks, found.total_cost, found.users, found.delays) == (0, 0, 0.0, 0, None)
    clicks = event_table.ad_events(spark, SF).filter("conversion = 0")
    assert sketches.over(sketches.by_day(clicks)).first().delays is None
