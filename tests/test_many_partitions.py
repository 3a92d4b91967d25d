"""Merges that touch more partitions than the driver takes values of."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType

from clickloom.sinks import tables

SCHEMA = StructType().add("id", LongType()).add("version", LongType()).add("day", DateType())


def _rows(spark, rows):
    start = dt.date(2024, 1, 1)
    days = [(i, v, None if d is None else start + dt.timedelta(days=d)) for i, v, d in rows]
    return spark.createDataFrame(days, SCHEMA)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"when_newer": "version"},
        {"within_days": 2},
        {"delete_unmatched": "id < 9"},
        {"delete_unmatched": "id < 9", "when_newer": "version"},
    ],
    ids=["plain", "newer", "near", "delete", "delete_newer"],
)
def test_as_with_few(spark, folder, monkeypatch, options):
    first = [(n, 1, n) for n in range(12)] + [(20, 5, 12), (21, 1, None)]
    # 3 leaves its day for another, 4 for no day, 20 is older, 21 gets a day, 30 is new.
    second = [(n, 2, n) for n in range(3)] + [(3, 2, 5), (4, 2, None), (20, 2, 13), (21, 2, 11), (30, 2, 40)]
    if "delete_unmatched" in options:
        options = options | {"delete_unmatched": F.expr(options["delete_unmatched"])}
    found, days = [], []
    for number, most in enumerate((tables.MOST_PARTITIONS, 2)):
        monkeypatch.setattr(tables, "MOST_PARTITIONS", most)
        table = tables.PathTable(f"{folder}/{number}", SCHEMA, "day", ("id",))
        table.ensure(spark)
        table.upsert(_rows(spark, first))
        table.upsert(_rows(spark, second), **options)
        found.append(sorted(map(str, table.read(spark).collect())))
        files = table.read(spark).select(F.regexp_extract(F.input_file_name(), "day=([^/]+)", 1)).distinct()
        days.append(sorted(r[0] for r in files.collect()))
    assert found[0] == found[1]
    assert days[0] == days[1]
    ids = [row.split(",")[0] for row in found[1]]
    assert len(ids) == len(set(ids)) == (11 if "delete_unmatched" in options else 15)


def _scanned(df):
    """Files read by each scan of the table, after ``df`` has run."""
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            waiting.append(node.plan())
        elif name.startswith("Scan parquet") and "version" in node.schema().simpleString():
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("with_null", [False, True])
def test_joined_partitions_prune_the_scan(spark, folder, with_null):
    table = tables.PathTable(f"{folder}/pruned", SCHEMA, "day", ("id",))
    table.ensure(spark)
    table.append(_rows(spark, [(n, 1, n) for n in range(30)] + [(99, 1, None)]))
    days = [3, 21] + [None] * with_null
    _rows(spark, [(0, 0, d) for d in days]).select("day").write.parquet(f"{folder}/known")
    found = table.joined(table.read(spark), spark.read.parquet(f"{folder}/known"))
    assert sorted(r["id"] for r in found.collect()) == [3, 21] + [99] * with_null
    # Two of the 19 days from the first to the last, and the folder without a day.
    assert sum(_scanned(found)) == 2 + with_null


def test_no_partitions_at_all(spark, folder):
    table = tables.PathTable(f"{folder}/none", SCHEMA, "day", ("id",))
    table.ensure(spark)
    table.append(_rows(spark, [(1, 1, 1), (2, 1, None)]))
    assert table.joined(table.read(spark), table.read(spark).select("day").limit(0)).count() == 0


def test_many_values_are_one_expression(spark, folder):
    table = tables.PathTable(f"{folder}/quick", SCHEMA, "day", ("id",))
    values = [str(r[0]) for r in spark.range(20_000).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int") * 900).cast("string")).collect()]
    began = time.monotonic()
    test = table.among({*values, None})
    # Values one by one took more than three milliseconds each.
    assert time.monotonic() - began < 10
    days = spark.createDataFrame([("+51301-01-30",), ("2024-01-02",), (values[7],), (values[-1],), (None,)], "day string")
    found = days.select(F.col("day").cast("date").alias("day")).filter(test).select(F.col("day").cast("string"))
    assert {r.day for r in found.collect()} == {values[7], values[-1], None}


def test_partition_values_of_any_text(spark, folder):
    schema = StructType().add("id", LongType()).add("day", StringType())
    table = tables.PathTable(f"{folder}/text", schema, "day", ("id",))
    values = ["plain", "it's", "a\\b", 'q"', "", "x y", "a`b"]
    rows = spark.createDataFrame([(n, v) for n, v in enumerate([*values, "other"])], schema)
    assert {r.day for r in rows.filter(table.among(set(values))).collect()} == set(values)


def test_folders_are_listed_once_and_in_few_tasks(spark, folder, monkeypatch):
    table = tables.PathTable(f"{folder}/listed", SCHEMA, "day", ("id",))
    table.ensure(spark)
    table.upsert(_rows(spark, [(n, 1, n) for n in range(200)]))
    read, tasks = tables.PathTable.read, []

    def counted(self, session):
        session.sparkContext.setJobGroup(f"listing-{folder}", "")
        try:
            return read(self, session)
        finally:
            tracker = session.sparkContext.statusTracker()
            jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"listing-{folder}")]
            tasks.append([tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds])
            session.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    before = spark.conf.get(tables._LISTING)
    monkeypatch.setattr(tables.PathTable, "read", counted)
    table.upsert(_rows(spark, [(n, 2, n + 1) for n in range(200)]))
    assert spark.conf.get(tables._LISTING) == before
    assert tasks == [[32]]
