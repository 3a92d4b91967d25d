"""Positions, cuts, samples and gaps against plain Python, with hot keys and copies."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import gaps, ranking, sampling
from clickloom.sinks import scratch


@pytest.fixture()
def tight(monkeypatch):
    """Limits so low that a few thousand rows go the way of a large table."""
    monkeypatch.setattr(ranking, "SMALL", 50)
    monkeypatch.setattr(ranking, "BUCKETS", 256)
    monkeypatch.setattr(ranking, "TOP_K", 0)


def skewed(n=4000, seed=1):
    """A third of all rows at one time, a third of them copies of one row."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        draw = rng.random()
        if draw < 1 / 3:
            rows.append((500, f"k{i:05d}"))
        elif draw < 2 / 3:
            rows.append((700, "copy"))
        else:
            rows.append((rng.randint(-(2**62), 2**62) if i % 50 == 0 else rng.randint(0, 1000), f"k{i:05d}"))
    return rows


def frame(spark, rows):
    """The rows as a scan of several files, which many passes read cheaply."""
    df = spark.createDataFrame(rows, "timestamp BIGINT, tie STRING")
    return scratch.written(df.repartition(4), "rows")


@pytest.fixture(scope="module")
def usual(spark):
    return frame(spark, skewed())


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def pairs(df):
    return sorted((row.timestamp, row.tie) for row in df.collect())


def test_row_index_is_the_position(usual):
    rows = sorted(skewed())
    indexed = ranking.with_row_index(usual, ["timestamp", "tie"])
    found = sorted((r.row_idx, r.timestamp, r.tie) for r in indexed.collect())
    assert found == [(i, *row) for i, row in enumerate(rows)]


def test_row_index_in_scan_order(spark, folder):
    path = f"{folder}/lines.txt"
    with open(path, "w") as out:
        out.writelines(f"line {i}\n" for i in range(500))
    indexed = ranking.with_row_index(spark.read.text(path), None)
    assert sorted((r.row_idx, r.value) for r in indexed.collect()) == [
        (i, f"line {i}") for i in range(500)
    ]


def test_hot_time_is_laid_out_over_many_parts(spark):
    rows = [(500, f"k{i:05d}") for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        parts = ranking.laid_out(frame(spark, rows), ["timestamp", "tie"]).groupBy("_part").count()
        sizes = [row["count"] for row in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 4000
    assert len(sizes) == 4 and max(sizes) < 2000


@pytest.mark.parametrize("n", [-1, 0, 1, 777, 1333, 2000, 2600, 3200, 3999, 4000, 5000])
def test_cut(usual, tight, n):
    rows = sorted(skewed())
    first, rest = ranking.split_at(usual, ["timestamp", "tie"], n)
    assert pairs(first) == rows[: max(n, 0)]
    assert pairs(rest) == rows[max(n, 0) :]


@pytest.mark.parametrize("seed", range(3))
def test_cut_at_random(spark, tight, seed):
    rng = random.Random(seed)
    rows = sorted(skewed(1500, seed))
    n = rng.randrange(1500)
    first, rest = ranking.split_at(frame(spark, rows), ["timestamp", "tie"], n)
    assert pairs(first) == rows[:n]
    assert pairs(rest) == rows[n:]


def test_cut_with_default_limits_and_a_share(usual):
    rows = sorted(skewed())
    first, rest = ranking.split_at(usual, ["timestamp", "tie"], lambda n: int(n * 0.8))
    assert pairs(first) == rows[:3200]
    assert pairs(rest) == rows[3200:]


def test_cut_refuses_nulls(spark):
    with pytest.raises(ValueError, match="NULL"):
        ranking.split_at(frame(spark, [(None, "a"), (1, "b")]), ["timestamp", "tie"], 1)


@pytest.mark.parametrize("n", [100, 101])
def test_first_n_refuses_nulls_at_any_size(spark, n):
    rows = frame(spark, [(None, "a")] + [(i, "b") for i in range(200)])
    with pytest.raises(ValueError, match="NULL"):
        ranking.first_n(rows, ["timestamp", "tie"], n).collect()


def test_cut_orders_null_ties_first(spark, tight):
    rows = [(1, None), (1, "a"), (1, "b"), (2, None)]
    first, rest = ranking.split_at(frame(spark, rows), ["timestamp", "tie"], 1)
    assert [(r.timestamp, r.tie) for r in first.collect()] == [(1, None)]
    assert rest.count() == 3


def test_first_n_both_ways(usual, monkeypatch):
    rows = sorted(skewed())
    monkeypatch.setattr(ranking, "TOP_K", 10_000)
    assert pairs(ranking.first_n(usual, ["timestamp", "tie"], 1500)) == rows[:1500]
    monkeypatch.setattr(ranking, "TOP_K", 10)
    assert pairs(ranking.first_n(usual, ["timestamp", "tie"], 1500)) == rows[:1500]


def test_sample_has_the_exact_size_and_ignores_partitioning(spark, tight):
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    one = {r.key for r in sampling.sample_exact(df.repartition(3), 1234, "key").collect()}
    two = {r.key for r in sampling.sample_exact(df.repartition(7), 1234, "key").collect()}
    other = {r.key for r in sampling.sample_exact(df, 1234, "key", seed=7).collect()}
    assert len(one) == 1234 and one == two
    assert other != one
    # every tenth of the ids is about equally represented
    tenths = [sum(int(key) // 500 == i for key in one) for i in range(10)]
    assert min(tenths) > 80 and max(tenths) < 170


def test_sample_of_copies(spark, tight):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("key"))
    for size in (1, 900, 1500, 2500):
        sample = sampling.sample_exact(df, size, "key")
        assert sample.count() == size
        repeated = sample.filter("key <> 'copy'")
        assert repeated.distinct().count() == repeated.count()
    assert sampling.sample_exact(df, 4000, "key").count() == 3000


def test_fast_sample_equals_large_sample(spark, monkeypatch):
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    monkeypatch.setattr(ranking, "TOP_K", 10_000)
    top_k = {r.key for r in sampling.sample_exact(df, 700, "key").collect()}
    monkeypatch.setattr(ranking, "TOP_K", 0)
    assert {r.key for r in sampling.sample_exact(df, 700, "key").collect()} == top_k


def visits(seed=3):
    rng = random.Random(seed)
    users = ["hot"] * 10 + [None] * 5 + [f"u{i}" for i in range(15)]
    return [(rng.choice(users), rng.randint(0, 400), f"e{i:05d}") for i in range(3000)]


def expected_gaps(rows):
    previous, expected = {}, {}
    for uid, time, event in sorted(rows, key=lambda row: (str(row[0]), row[1], row[2])):
        expected[event] = time - previous[uid] if uid in previous else None
        previous[uid] = time
    return expected


@pytest.mark.parametrize("hot_rows", [10_000, 700, 300, 1])
def test_gaps(spark, hot_rows):
    rows = visits()
    df = spark.createDataFrame(rows, "uid STRING, timestamp BIGINT, event_id STRING").repartition(5)
    found = gaps.with_gap(df, hot_rows=hot_rows)
    assert found.columns == ["uid", "timestamp", "event_id", "gap_sec"]
    assert {r.event_id: r.gap_sec for r in found.collect()} == expected_gaps(rows)


def test_gaps_of_nothing(spark):
    df = spark.createDataFrame([], "uid STRING, timestamp BIGINT, event_id STRING")
    assert gaps.with_gap(df).count() == 0
