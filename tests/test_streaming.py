"""Streams from files and the rate source; bounded runs only."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.plans import gold
from clickloom.sinks import tables
from clickloom.sources import files, streams
from clickloom.streaming import ingest


def message(offset, value, sent="2024-01-02T03:04:05Z"):
    return json.dumps(
        {"key": "u", "value": value, "topic": "ad-events", "partition": 0, "offset": offset, "timestamp": sent}
    )


def event(event_id, **fields):
    return json.dumps({"event_id": event_id, "timestamp": 1_704_067_200, "cost": 1.0, **fields})


def deliver(folder, name, *lines):
    os.makedirs(f"{folder}/topic", exist_ok=True)
    with open(f"{folder}/topic/{name}.json", "w") as out:
        out.write("\n".join(lines) + "\n")


def land(spark, folder, fmt="parquet", checkpoint="checkpoint", raw="raw"):
    stream = ingest.to_raw(streams.file_messages(spark, f"{folder}/topic"))
    query = ingest.land(stream, f"{folder}/{raw}", f"{folder}/{checkpoint}", fmt, available_now=True)
    ingest.run_for(query)
    return files.read_raw(spark, f"{folder}/{raw}", fmt)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_landing_and_resuming(spark, folder, fmt):
    deliver(folder, "one", message(0, event("a", campaign=3)), message(1, "not an event"))
    assert land(spark, folder, fmt).count() == 2
    assert land(spark, folder, fmt).count() == 2
    deliver(folder, "two", message(2, event("b", conversion_timestamp=1_704_067_300)))
    rows = land(spark, folder, fmt)
    assert rows.schema.names == schemas.RAW.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.RAW]
    found = {row.kafka_offset: row for row in rows.withColumn("ts", F.unix_timestamp("event_timestamp")).collect()}
    assert sorted(found) == [0, 1, 2]
    assert (found[0].event_id, found[0].campaign, found[0].ts) == ("a", 3, 1_704_067_200)
    assert found[1].event_id is None and found[1].event_timestamp is None
    assert found[0].ingest_ts is not None
    assert rows.filter(F.to_date("ingest_ts") == F.col("raw_date")).count() == 3

    layout = [path for path, _, names in os.walk(f"{folder}/raw") if any(n.endswith(fmt) for n in names)]
    assert layout and all("raw_date=" in path and "/raw_hour=" in path for path in layout)
    assert {"offsets", "commits", "sources"} <= set(os.listdir(f"{folder}/checkpoint"))


def test_replay_with_a_new_checkpoint(spark, folder):
    deliver(folder, "one", message(0, event("a")), message(1, event("b")))
    land(spark, folder)
    assert land(spark, folder, checkpoint="again", raw="raw2").count() == 2


def test_one_bad_field_nulls_only_itself(spark, folder):
    deliver(
        folder,
        "one",
        message(0, '{"event_id": "a", "timestamp": 1.5, "cost": 2}'),
        message(1, '{"event_id": "b", "campaign": 99999999999, "cost": 2}'),
        message(2, '{"event_id": "c", "timestamp": 9223372036854775807, "cost": 2, "more": [1]}'),
        message(3, '{"event_id": "d", "cost": '),
    )
    found = {row.kafka_offset: row for row in land(spark, folder).collect()}
    assert [found[i].event_id for i in range(4)] == ["a", "b", "c", None]
    assert found[0].timestamp is None and found[0].cost == 2.0
    assert found[1].campaign is None and found[1].cost == 2.0
    assert found[2].event_timestamp is None and found[2].timestamp == 2**63 - 1
    assert found[3].cost is None


def test_unknown_format(spark, folder):
    with pytest.raises(ValueError):
        ingest.land(streams.rate(spark), folder, folder, "orc")
    with pytest.raises(ValueError):
        files.read_raw(spark, folder, "orc")


@pytest.mark.parametrize("versioned", [False, True])
def test_stream_of_upserts(spark, folder, versioned):
    of = tables.versioned_events if versioned else tables.processed_events
    table = of(folder)

    def run(checkpoint="checkpoint"):
        stream = streams.file_messages(spark, f"{folder}/topic")
        ingest.run_for(ingest.upsert_stream(stream, table, f"{folder}/{checkpoint}", available_now=True))
        found = table.read(spark).collect()
        return sorted((row.event_id, row.cost, row.conversion_delay_sec) for row in found)

    deliver(
        folder,
        "one",
        message(0, event("a")),
        message(1, event("a", cost=2.0), "2024-01-02T03:04:06Z"),
        message(2, "lost"),
        message(3, event(None)),
    )
    assert run() == [("a", 2.0, None)]
    deliver(folder, "two", message(4, event("a", conversion=1, conversion_timestamp=1_704_067_260)), message(5, event("b")))
    # The later batch holds an older message of a: with versions it does not win.
    newest, latest = [("a", 2.0, None), ("b", 1.0, None)], [("a", 1.0, 60), ("b", 1.0, None)]
    assert run() == (newest if versioned else latest)
    # Replayed in one batch the newest message wins either way.
    assert run("replayed") == newest


def test_far_dates_do_not_stop_stream_or_summary(spark, folder):
    table = tables.processed_events(folder)
    deliver(folder, "one", message(0, event("a")), message(1, event("far", timestamp=1_706_572_800_000)))
    for checkpoint in ("one", "two"):
        stream = streams.file_messages(spark, f"{folder}/topic")
        ingest.run_for(ingest.upsert_stream(stream, table, f"{folder}/{checkpoint}", available_now=True))
    rows = table.read(spark).select("event_id", F.col("event_date").cast("string").alias("day"))
    assert sorted(map(tuple, rows.collect())) == [("a", "2024-01-01"), ("far", "+56049-02-20")]
    summary = tables.campaign_summary(folder)
    for _ in range(2):
        gold.run(table.read(spark), summary, as_of=date(2024, 1, 2), retract=True)
    days = summary.read(spark).select(F.col("summary_date").cast("string").alias("day"), "impressions")
    assert sorted(map(tuple, days.collect())) == [("+56049-02-20", 1), ("2024-01-01", 1)]
    # and a date that moves away leaves its folder empty, whatever it is called
    deliver(folder, "two", message(2, event("far"), "2024-01-03T00:00:00Z"))
    stream = streams.file_messages(spark, f"{folder}/topic")
    ingest.run_for(ingest.upsert_stream(stream, table, f"{folder}/one", available_now=True))
    assert table.read(spark).count() == 2
    assert not any("+56049" in name for name in os.listdir(table.path))


def test_rate_source_smoke(spark, folder):
    rows = ingest.with_ingest_time(streams.rate(spark, 50))
    query = ingest.land(rows, f"{folder}/out", f"{folder}/checkpoint", partition_by=(), interval="1 second")
    ingest.run_for(query, 6)
    assert not query.isActive
    landed = spark.read.parquet(f"{folder}/out")
    assert dict(landed.dtypes) == {"timestamp": "timestamp", "value": "bigint", "ingest_ts": "timestamp"}
    total, distinct, nulls = landed.agg(
        F.count("*"), F.count_distinct("value"), F.count(F.when(F.col("ingest_ts").isNull(), 1))
    ).first()
    assert total == distinct > 0 and nulls == 0


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_messages(spark, "localhost:9092")
