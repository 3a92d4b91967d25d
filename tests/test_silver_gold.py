"""Raw to processed to summary on small hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.events import parse_ok
from clickloom.operators import summary
from clickloom.plans import gold, silver
from clickloom.sinks import tables
from clickloom.streaming import ingest

DAY = 86_400
JAN_20 = 1_705_708_800
AS_OF = date(2024, 1, 20)


def raw(spark, rows):
    """(offset, sent, event_id, timestamp, campaign, click, conversion, conversion_ts, cost)"""
    names = [
        "kafka_offset", "sent", "event_id", "timestamp", "campaign", "click", "conversion",
        "conversion_timestamp", "cost",
    ]
    types = "kafka_offset BIGINT, sent BIGINT, event_id STRING, timestamp BIGINT, campaign INT, click INT, conversion INT, conversion_timestamp BIGINT, cost DOUBLE"
    full = spark.createDataFrame([dict(zip(names, row)) for row in rows], types)
    return full.select(
        F.lit(0).alias("kafka_partition"),
        "kafka_offset",
        F.timestamp_seconds("sent").alias("kafka_timestamp"),
        "event_id",
        F.lit("ad_event").alias("event_type"),
        "timestamp",
        F.lit("").alias("event_time"),
        F.concat(F.lit("u_"), "event_id").alias("uid"),
        "campaign",
        "click",
        "conversion",
        "conversion_timestamp",
        "cost",
        F.timestamp_seconds("timestamp").alias("event_timestamp"),
        F.timestamp_seconds("sent").alias("ingest_ts"),
        F.to_date(F.timestamp_seconds("sent")).alias("raw_date"),
        F.lit(0).alias("raw_hour"),
    )


def ids(df):
    return sorted(row.event_id for row in df.select("event_id").collect())


def test_newest_message_wins(spark):
    rows = raw(
        spark,
        [
            (1, 100, "a", JAN_20, 1, 0, 0, None, 1.0),
            (2, 100, "a", JAN_20, 1, 1, 1, JAN_20 + 60, 2.0),
            (3, 50, "a", JAN_20, 1, 0, 0, None, 9.0),
            (4, 100, None, None, None, None, None, None, None),
            (5, 100, None, None, None, None, None, None, None),
        ],
    )
    kept = {row.event_id: row for row in silver.transform(rows).collect()}
    assert set(kept) == {"a", None}
    assert (kept["a"].cost, kept["a"].conversion_delay_sec) == (2.0, 60)
    assert kept["a"].event_date == date(2024, 1, 20)
    assert silver.transform(rows).columns == schemas.PROCESSED_EVENTS.names
    assert silver.transform(rows, keep="any").count() == 2
    with pytest.raises(ValueError):
        silver.transform(rows, keep="first")


def test_window_is_inclusive_and_open_to_the_future(spark):
    days = spark.createDataFrame(
        [(date(2024, 1, d),) for d in range(10, 25)] + [(None,)], "event_date DATE"
    )
    kept = days.filter(summary.recent("event_date", 7, AS_OF)).collect()
    assert sorted(row.event_date.day for row in kept) == list(range(13, 25))
    today = spark.sql("SELECT date_sub(current_date(), 7) AS event_date UNION SELECT date_sub(current_date(), 8)")
    assert today.filter(summary.recent("event_date", 7)).count() == 1


STRADDLING = [
    (1, JAN_20, "old", JAN_20 - 20 * DAY, 1, 0, 0, None, 1.0),
    (2, JAN_20, "stays", JAN_20, 1, 0, 0, None, 1.0),
    (3, JAN_20, "leaves", JAN_20, 1, 0, 0, None, 1.0),
    (4, JAN_20 + 9, "leaves", JAN_20 - 20 * DAY, 1, 0, 0, None, 2.0),
    (5, JAN_20, "comes", JAN_20 - 20 * DAY, 1, 0, 0, None, 1.0),
    (6, JAN_20 + 9, "comes", JAN_20, 1, 0, 0, None, 2.0),
    (7, JAN_20, "loses date", JAN_20, 1, 0, 0, None, 1.0),
    (8, JAN_20 + 9, "loses date", None, 1, 0, 0, None, 1.0),
]


def test_filtering_first_equals_filtering_last(spark):
    rows = raw(spark, STRADDLING)
    plain = silver.recent_rows(silver.with_id(silver.transform(rows)), 7, AS_OF)
    assert ids(plain) == ["comes", "stays"]
    assert ids(silver.transform_recent(rows, 7, AS_OF)) == ["comes", "stays"]
    assert ids(silver.transform_recent(rows, 7, AS_OF, assume_ingested_later=True)) == ["comes", "stays"]
    # the assumption does not hold for these rows, and it shows
    trusting = silver.transform_recent(rows, 7, AS_OF, assume_fixed_dates=True)
    assert ids(trusting) == ["comes", "leaves", "loses date", "stays"]


def test_filtering_first_with_unknown_send_times(spark):
    rows = raw(spark, STRADDLING).withColumn("kafka_timestamp", F.lit(None).cast("timestamp"))
    assert ids(silver.transform_recent(rows, 7, AS_OF)) == ["comes", "stays"]


def test_a_hot_id_is_one_row(spark):
    hot = [(i, i, "hot", JAN_20, 1, 0, 0, None, float(i)) for i in range(3000)]
    other = [(i, i, f"e{i}", JAN_20, 1, 0, 0, None, 1.0) for i in range(1000)]
    rows = raw(spark, hot + other)
    kept = silver.transform(rows)
    assert kept.count() == 1001
    assert kept.filter("event_id = 'hot'").first().cost == 2999.0


def test_summary_metrics(spark):
    rows = spark.createDataFrame(
        [
            (date(2024, 1, 20), 1, 1, 1, 2.0),
            (date(2024, 1, 20), 1, 1, 0, 1.0),
            (date(2024, 1, 20), 1, 0, 0, 0.0),
            (date(2024, 1, 20), 2, 0, 0, 0.0),
            (date(2024, 1, 20), None, 0, 0, 0.5),
        ],
        "event_date DATE, campaign INT, click INT, conversion INT, cost DOUBLE",
    )
    found = {row.campaign: row for row in summary.campaign_days(rows).collect()}
    one = found[1]
    assert (one.impressions, one.clicks, one.conversions, one.total_cost) == (3, 2, 1, 3.0)
    assert one.ctr == pytest.approx(200 / 3) and one.cvr == 50.0 and one.cpa == 3.0
    assert (found[2].ctr, found[2].cvr, found[2].cpa) == (0.0, 0.0, None)
    assert found[None].impressions == 1


def test_jobs_end_to_end_and_again(spark, folder):
    processed, campaign = tables.processed_events(folder), tables.campaign_summary(folder)
    rows = raw(spark, STRADDLING)
    for _ in range(2):
        silver.run(rows, processed, as_of=AS_OF)
        gold.run(processed.read(spark), campaign, as_of=AS_OF)
        assert ids(processed.read(spark)) == ["comes", "stays"]
        assert [row.impressions for row in campaign.read(spark).collect()] == [2]

    silver.backfill(rows, processed, date(2023, 12, 1), date(2024, 1, 10))
    assert ids(processed.read(spark)) == ["comes", "leaves", "old", "stays"]

    silver.run(rows, processed, mode="full-refresh")
    assert processed.read(spark).count() == 5
    with pytest.raises(ValueError):
        silver.run(rows, processed, mode="replace")


def test_full_refresh_keeps_other_partitions_unless_truncating(spark, folder):
    table = tables.processed_events(folder)
    first = silver.transform(raw(spark, [(1, 0, "a", JAN_20, 1, 0, 0, None, 1.0)]))
    second = silver.transform(raw(spark, [(1, 0, "b", JAN_20 + DAY, 1, 0, 0, None, 1.0)]))
    table.overwrite_partitions(first)
    table.overwrite_partitions(second)
    assert ids(table.read(spark)) == ["a", "b"]
    table.overwrite_partitions(second, truncate=True)
    assert ids(table.read(spark)) == ["b"]


def test_retraction(spark, folder):
    processed, campaign = tables.processed_events(folder), tables.campaign_summary(folder)
    both = raw(
        spark,
        [
            (1, 0, "a", JAN_20, 1, 0, 0, None, 1.0),
            (2, 0, "b", JAN_20, 2, 0, 0, None, 1.0),
            (3, 0, "c", JAN_20 - DAY, 3, 0, 0, None, 1.0),
            (4, 0, "d", JAN_20 - 30 * DAY, 4, 0, 0, None, 1.0),
        ],
    )
    gold.run(silver.transform(both), campaign, 60, AS_OF)
    changed = silver.transform(both.filter("event_id = 'a'"))
    gold.run(changed, campaign, 7, AS_OF)
    assert campaign.read(spark).count() == 4
    gold.run(changed, campaign, 7, AS_OF, retract=True)
    assert sorted(row.campaign for row in campaign.read(spark).collect()) == [1, 4]


def test_null_campaign_is_updated_not_repeated(spark, folder):
    campaign = tables.campaign_summary(folder)
    rows = silver.transform(raw(spark, [(1, 0, "a", JAN_20, None, 0, 0, None, 1.0)]))
    for _ in range(2):
        gold.run(rows, campaign, 7, AS_OF)
    assert campaign.read(spark).count() == 1


def test_parse_ok_separates_unreadable_rows(spark):
    messages = spark.createDataFrame(
        [('{"event_id": "a"}',), ("text",), ("[1]",), ("{}",), (None,), ('{"timestamp": "x", "cost": 1}',)],
        "value STRING",
    ).selectExpr("value", "0 AS partition", "0L AS offset", "timestamp_seconds(0) AS timestamp")
    parsed = ingest.parse(messages)
    assert parsed.count() == 6
    assert parsed.filter(parse_ok(parsed)).count() == 2
    dead = ingest.dead_letters(messages)
    assert dead.count() == 4
    assert {row.payload for row in dead.collect()} == {"text", "[1]", "{}", None}
