"""What Spark makes of the plans: pruning, pushdown, shuffles, no Python workers."""

from datetime import date

import pytest

import __spark_entry__ as contract
from clickloom.checks import queries as checks
from clickloom.operators import fanout, merge
from clickloom.plans import event_table, gold, silver

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def table(spark):
    return checks._loaded_table(spark, SF_DIR)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_summary_prunes_partitions_and_shuffles_once(spark, table):
    text = plan(gold.summarize(table.read(spark), 7, date(2024, 1, 24)))
    assert "PartitionFilters: [isnotnull(event_date" in text and "2024-01-17" in text
    assert text.count("Exchange") == 1
    assert "partial_sum" in text
    assert "ReadSchema: struct<campaign:int,click:int,conversion:int,cost:double>" in text


def test_recent_events_reach_the_raw_scan_as_a_filter(spark):
    raw = checks._stored_raw(checks._raw(spark, SF_DIR))
    text = plan(silver.transform_recent(raw, 7, date(2024, 1, 30)))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all("GreaterThanOrEqual(" in line for line in scans)
    assert "WindowGroupLimit" in text and "partial_max" in text


@pytest.mark.parametrize("job", ["recent", "between"])
def test_both_raw_scans_are_pruned_by_day_of_arrival(spark, job):
    raw = checks._with_corrections(spark, SF_DIR)
    if job == "recent":
        rows = silver.transform_recent(raw, 7, date(2024, 1, 30), assume_ingested_later=True)
        pruned = 2
    else:
        rows = silver.transform_between(raw, date(2024, 1, 10), date(2024, 1, 20), assume_ingested_later=True)
        pruned = 3  # and the ids of the range
    scans = [line for line in plan(rows).splitlines() if "FileScan" in line]
    filters = [line[line.index("PartitionFilters") :].split("]")[0] for line in scans]
    assert len(scans) == pruned and all("raw_date" in text and ">=" in text for text in filters)
    newest = silver.transform(raw).filter(
        "event_date >= '2024-01-23'" if job == "recent" else "event_date BETWEEN '2024-01-10' AND '2024-01-20'"
    )
    drop = lambda df: sorted(map(str, df.drop("updated_at").collect()))
    assert drop(rows) == drop(newest)


def test_a_stream_looks_only_at_partitions_near_its_batch(spark, table):
    source = checks._recent(spark, SF_DIR).filter("event_date = '2024-01-24'")
    near = table._near(source, 1)
    assert {str(row[0]) for row in near.collect()} == {"2024-01-23", "2024-01-24", "2024-01-25"}
    found = plan(merge.matched(table.within(table.read(spark), near), source, table.keys))
    filters = found[found.index("PartitionFilters") :].split("]")[0]
    assert "2024-01-23" in filters or "19745" in filters


def test_flagship_pushes_its_window(spark):
    assert "GreaterThanOrEqual(ts," in plan(contract.entry(spark))


def test_dedup_limits_each_key_before_the_shuffle(spark):
    text = plan(silver.transform(checks._raw(spark, SF_DIR)))
    assert text.count("Exchange") == 1
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_upsert_reads_only_touched_partitions(spark, table, no_broadcast):
    source = checks._recent(spark, SF_DIR)
    target = table.read(spark).filter(table.among({"2024-01-23", "2024-01-24"}))
    text = plan(merge.merge_upsert(target, source, table.keys))
    assert "LeftAnti" in text and "SortMergeJoin" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "event_date" in text[text.index("PartitionFilters") :]
    found = plan(merge.matched(table.read(spark), source, table.keys).select("event_date"))
    assert "ReadSchema: struct<event_id:string>" in found


def test_fanout_is_one_scan_without_a_shuffle(spark):
    text = plan(fanout.split(event_table.ad_events(spark, SF_DIR)))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_relink_shuffles_each_feed_once(spark, no_broadcast):
    text = plan(fanout.relink(*checks._three_feeds(spark, SF_DIR)))
    assert text.count("Exchange") == 3


LAZY = sorted(
    set(contract.queries())
    & {
        "ad_events_adapter", "raw_projection", "silver_transform", "campaign_summary", "dataset_stats",
        "scan_stats", "fanout_all", "fanout_summary", "message_encode_decode", "row_index",
        "sample_exact", "tail_slice", "interevent_gap", "health_duplicates", "merge_processed_plan",
        "tsv_prepare", "csv_roundtrip",
    }
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in text
