"""Landing once, and counting what a stream sends."""

import os

import pytest
from pyspark.sql import functions as F

from clickloom.operators import fanout
from clickloom.sinks import messages as message_sink
from clickloom.sources import files, streams
from clickloom.streaming import counters, ingest
from tests.test_streaming import deliver, event, message


def land(spark, folder, by="content", checkpoint="checkpoint", raw="raw"):
    stream = ingest.to_raw(ingest.once(streams.file_messages(spark, f"{folder}/topic"), by=by))
    ingest.run_for(ingest.land(stream, f"{folder}/{raw}", f"{folder}/{checkpoint}", available_now=True))
    rows = files.read_raw(spark, f"{folder}/{raw}")
    return sorted((r.kafka_offset, r.event_id, r.cost) for r in rows.collect())


def test_redelivered_content_lands_once(spark, folder):
    old = "1999-01-02T03:04:05Z"
    deliver(folder, "one", message(0, event("a")), message(1, event("a")), message(2, event("a", cost=2.0)), message(3, "bad"))
    first = land(spark, folder)
    assert len(first) == 3 and {row[1:] for row in first} == {("a", 1.0), ("a", 2.0), (None, None)}
    # restarted, everything is sent again and something old is new: no message is too old to land
    deliver(folder, "two", message(9, event("a")), message(10, "bad"), message(11, event("old", timestamp=0), old), message(12, event("b"), old))
    assert land(spark, folder)[3:] == [(11, "old", 1.0), (12, "b", 1.0)]


def test_redelivered_positions_land_once(spark, folder):
    deliver(folder, "one", message(0, event("a")), message(0, event("a")), message(1, event("a")))
    deliver(folder, "two", message(1, event("a")), message(2, event("b")))
    assert [row[0] for row in land(spark, folder, "position")] == [0, 1, 2]
    with pytest.raises(ValueError):
        ingest.once(streams.file_messages(spark, f"{folder}/topic"), by="chance")


def send(spark, folder):
    events = ingest.parse(streams.file_messages(spark, f"{folder}/topic"))
    feed = counters.observed(fanout.split(events))
    query = ingest.land(
        message_sink.encode_feed(feed), f"{folder}/sent", f"{folder}/checkpoint", "json", ("topic",), available_now=True
    )
    ingest.run_for(query)
    counters.wait_for(spark, f"{folder}/counts", query)
    return query


def test_batches_count_once(spark, folder):
    listener = counters.BatchCounters(spark, f"{folder}/counts")
    spark.streams.addListener(listener)
    try:
        deliver(folder, "one", message(0, event("a", click=1)), message(1, event("b")))
        query = send(spark, folder)
        deliver(folder, "two", message(2, event("c", click=1, conversion=1, conversion_timestamp=1_704_067_300)))
        send(spark, folder)
        expected = {"impressions": 3, "clicks": 2, "conversions": 1}
        assert {r.kind: r.events for r in counters.totals(spark, f"{folder}/counts").collect()} == expected
        # The last batch was not known to be done: it runs again.
        for name in os.listdir(f"{folder}/checkpoint/commits"):
            if name.strip(".").startswith("1"):
                os.unlink(f"{folder}/checkpoint/commits/{name}")
        send(spark, folder)
        assert {r.kind: r.events for r in counters.totals(spark, f"{folder}/counts").collect()} == expected
        batches = counters.by_batch(spark, f"{folder}/counts")
        assert batches.select("query", "batch").distinct().count() == 2
        missing = counters.uncounted(spark, f"{folder}/counts", str(query.id), 2)
        assert [r.batch for r in missing.collect()] == [2]
    finally:
        spark.streams.removeListener(listener)


def test_nothing_counted_without_messages(spark, folder):
    spark.createDataFrame([], counters._SCHEMA).write.json(f"{folder}/counts")
    assert counters.totals(spark, f"{folder}/counts").collect() == []
    assert counters.by_batch(spark, f"{folder}/counts").filter(F.col("batch") >= 0).count() == 0
