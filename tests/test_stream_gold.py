"""The summary kept by a stream: any order, moved rows, emptied groups, failures between its two writes."""

import os

import pytest
from pyspark.sql import functions as F

from clickloom.operators import merge
from clickloom.operators.summary import campaign_days
from clickloom.sinks import scratch, tables
from clickloom.sources import streams
from clickloom.streaming import gold, ingest
from tests.test_plans import plan
from tests.test_streaming import deliver, event, message

DAY = 86_400
FIRST = 1_704_067_200


def run(spark, folder, checkpoint="checkpoint"):
    processed, summary = tables.versioned_events(folder), tables.campaign_summary(folder)
    stream = streams.file_messages(spark, f"{folder}/topic")
    ingest.run_for(gold.maintain(stream, processed, summary, f"{folder}/{checkpoint}", available_now=True))
    kept = sorted(map(str, summary.read(spark).drop("updated_at").collect()))
    whole = sorted(map(str, campaign_days(processed.read(spark)).collect()))
    assert kept == whole
    return {(str(r.summary_date), r.campaign): r.impressions for r in summary.read(spark).collect()}


def sent(offset, event_id, minute, **fields):
    return message(offset, event(event_id, **fields), f"2024-01-02T03:{minute:02d}:05Z")


def test_moved_rows_and_emptied_groups(spark, folder):
    deliver(folder, "one", sent(0, "a", 1, campaign=1), sent(1, "b", 1, campaign=1), sent(2, "c", 1), sent(3, None, 1, campaign=1))
    assert run(spark, folder) == {("2024-01-01", 1): 2, ("2024-01-01", None): 1}
    # a moves to another campaign, c, the last of its group, to another day
    deliver(folder, "two", sent(4, "a", 2, campaign=2), sent(5, "c", 2, timestamp=FIRST + DAY))
    assert run(spark, folder) == {("2024-01-01", 1): 1, ("2024-01-01", 2): 1, ("2024-01-02", None): 1}
    # an older version changes nothing; b leaves, and with it the last group but one of that day
    deliver(folder, "three", sent(6, "a", 1, campaign=9), sent(7, "b", 3, timestamp=FIRST + DAY, campaign=5))
    moved = {("2024-01-01", 2): 1, ("2024-01-02", 5): 1, ("2024-01-02", None): 1}
    assert run(spark, folder) == moved
    # all of it again, in one batch
    assert run(spark, folder, "replayed") == moved


@pytest.mark.parametrize("step", ["sum_again", "upsert"])
def test_a_failure_between_merge_and_sum(spark, folder, monkeypatch, step):
    deliver(folder, "one", sent(0, "a", 1, campaign=1), sent(1, "b", 1, campaign=2))
    run(spark, folder)
    deliver(folder, "two", sent(2, "a", 2, campaign=2))

    def fails(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step == "sum_again":
            patch.setattr(gold, "sum_again", fails)
        else:
            patch.setattr(tables.PathTable, "upsert", fails)
        with pytest.raises(Exception, match="lost"):
            run(spark, folder)
    # The processed table may already hold a in its new group: the old one is known from the first attempt.
    assert run(spark, folder) == {("2024-01-01", 2): 2}
    assert not os.path.exists(f"{folder}/checkpoint/touched-groups/batch=1")


def test_only_touched_partitions_are_read(spark, folder):
    processed = tables.processed_events(folder)
    processed.ensure(spark)
    rows = spark.range(40).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("event_date"),
        F.lit("u").alias("uid"), (F.col("id") % 4).cast("int").alias("campaign"), F.lit(0).alias("click"),
        F.lit(0).alias("conversion"), F.lit(None).cast("bigint").alias("conversion_delay_sec"), F.lit(1.0).alias("cost"),
        F.current_timestamp().alias("updated_at"),
    )
    processed.append(rows)
    groups = spark.createDataFrame([("2024-01-03", 2)], "d string, campaign int").select(
        F.to_date("d").alias("event_date"), "campaign"
    )
    found = processed.within(processed.read(spark), groups.select("event_date"))
    text = plan(found)
    filters = text[text.index("PartitionFilters") :].split("]")[0]
    assert "2024-01-03" in filters or "19725" in filters
    assert {str(r.event_date) for r in found.collect()} == {"2024-01-03"}


def test_a_batch_is_staged_and_looked_up_once(spark, folder, monkeypatch):
    deliver(folder, "one", sent(0, "a", 1, campaign=1), sent(1, "b", 1, campaign=1))
    run(spark, folder)
    deliver(folder, "two", sent(2, "a", 2, campaign=2), sent(3, "b", 2, timestamp=FIRST + DAY))
    staged, matched = [], []
    write, look = scratch.staged, merge.matched
    monkeypatch.setattr(scratch, "staged", lambda df, label: staged.append(label) or write(df, label))
    monkeypatch.setattr(merge, "matched", lambda target, source, keys: matched.append(keys) or look(target, source, keys))
    assert run(spark, folder) == {("2024-01-01", 2): 1, ("2024-01-02", None): 1}
    # Of the processed table: the other source staged is the summary's.
    assert staged == ["batch", "upsert-source"] and matched == [("event_id",)]
