"""Logs, CSVs, slices, fan-out and messages."""

import csv
import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import attribution_log as log
from clickloom.operators import fanout, sampling, stats
from clickloom.plans import prepare
from clickloom.sinks import files as sink_files
from clickloom.sinks import messages
from clickloom.sources import files

HEADER = "timestamp\tuid\tcampaign\tconversion\tconversion_timestamp\tclick\tcost\tcat1\textra"
LINES = [
    "5\tu1\t10\t1\t65\t1\t0.5\tx\ty",
    "3\tu2\t11",  # too short
    "4\tu3\t12\t0\t-1\t0\t\tx\ty\tz\tz",  # too long, blank cost
    "",
    "bad\tu4\t13\t1.0\t1e3\tyes\t0.1\tx\ty",
    "9\tu5\t14\t1\t0\t1\t0.2\t\t",
    " 7 \tu6\t\t0\t\t0\t0.3\tcafé\ty",
]


def write(path, lines, end="\n"):
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt", newline="") as out:
        out.write(end.join(lines) + (end if lines else ""))
    return path


def read_csvs(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, newline="") as lines:
            rows += list(csv.DictReader(lines))
    return rows


@pytest.mark.parametrize("name, end", [("a.tsv", "\n"), ("b.tsv", "\r\n"), ("c.tsv.gz", "\n")])
def test_read_tsv(spark, folder, name, end):
    path = write(f"{folder}/{name}", [HEADER, *LINES], end)
    rows = files.read_tsv(spark, path, partitions=3)
    assert rows.columns == [*HEADER.split("\t"), "_line"]
    found = {row.uid: row for row in rows.collect()}
    assert sorted(found) == ["u1", "u2", "u3", "u4", "u5", "u6"]
    assert found["u2"].campaign == "11" and found["u2"].click == "" and found["u2"].extra == ""
    assert found["u3"].extra == "y"
    assert found["u6"].timestamp == " 7 " and found["u6"].cat1 == "café"


def test_header_only_and_empty_files(spark, folder):
    assert files.read_tsv(spark, write(f"{folder}/header.tsv", [HEADER])).count() == 0
    with pytest.raises(ValueError, match="empty"):
        files.read_tsv(spark, write(f"{folder}/empty.tsv", []))


def test_convert(spark, folder):
    rows = files.read_tsv(spark, write(f"{folder}/a.tsv", [HEADER, *LINES]))
    found = {row.uid: row for row in log.convert(rows, 1000, keep_categories=True).collect()}
    one = found["u1"]
    assert (one.timestamp, one.conversion_timestamp, one.click, one.conversion) == (1005, 1065, 1, 1)
    assert (found["u2"].cost, found["u3"].cost) == ("0.0", "0.0")
    assert found["u3"].conversion_timestamp is None  # -1
    assert found["u5"].conversion_timestamp is None  # 0
    four = found["u4"]
    assert (four.timestamp, four.click, four.conversion, four.conversion_timestamp) == (1000, 0, 0, None)
    assert (found["u6"].timestamp, found["u6"].campaign, found["u6"].cat1) == (1007, "", "café")
    assert found["u1"].cat2 == ""
    assert log.convert(rows).columns == list(schemas.AD_EVENT_COLUMNS)


def test_scan_stats_ignore_what_is_no_number(spark, folder):
    rows = files.read_tsv(spark, write(f"{folder}/a.tsv", [HEADER, *LINES]))
    assert tuple(stats.scan_stats(rows).first()) == (6, 3, 9)


def test_choose_base():
    assert log.choose_base(999_999_999, "2026-04-01T00:00:00") == 1_775_001_600
    assert log.choose_base(1_000_000_000) is None
    assert log.choose_base(None) is None
    assert log.choose_base(5, preserve_relative=True) is None
    assert log.choose_base(5, "2026-04-01T00:00:00+09:00") == 1_775_001_600 - 9 * 3600


def test_convert_log(spark, folder):
    lines = [f"{(i * 37) % 1000}\tu{i % 50}\t{i % 7}\t{i % 2}\t{2000 + i}\t1\t0.25\tx\ty" for i in range(3000)]
    lines += ["500\tsame\t1\t0\t0\t0\t0\tx\ty"] * 1500
    source = write(f"{folder}/log.tsv.gz", [HEADER, *lines])
    report = prepare.convert_log(spark, source, f"{folder}/out", size=4000, read_partitions=4).first()
    rows = read_csvs(f"{folder}/out/ad_events")
    times = [int(row["timestamp"]) for row in rows]
    assert list(rows[0]) == list(schemas.AD_EVENT_COLUMNS)
    assert len(rows) == 4000 == report.total
    assert times == sorted(times) and times[0] >= 1_775_001_600
    head, tail = read_csvs(f"{folder}/out/ad_events_sample"), read_csvs(f"{folder}/out/ad_events_batch2")
    assert head == rows[:1000]
    assert len(tail) == 800 and sorted(map(str, tail)) == sorted(map(str, rows[3200:]))
    assert report.conversions == sum(int(row["conversion"]) for row in rows)
    assert report.campaigns == 7


def test_dataset_stats(spark):
    rows = spark.createDataFrame(
        [
            ("100", "1", "1", "1", "3700", "2.5"),
            ("200", "1", "1", "1", "200", ""),
            ("50", "", "0", "0", "", "x"),
            ("bad", None, "1", "0", None, "1.5"),
        ],
        "timestamp STRING, campaign STRING, click STRING, conversion STRING, conversion_timestamp STRING, cost STRING",
    )
    found = stats.dataset_stats(rows).first()
    assert (found.total, found.clicks, found.conversions, found.total_cost) == (4, 3, 2, 4.0)
    assert (found.avg_delay_hours, found.campaigns, found.min_ts, found.max_ts) == (1.0, 2, 0, 200)
    assert (found.ctr, found.cpa) == (75.0, 2.0) and found.cvr == pytest.approx(200 / 3)
    assert found.period == "1970-01-01 00:00 ~ 1970-01-01 00:03"
    assert stats.dataset_stats(rows, approximate=True).first().campaigns == 2
    assert stats.for_display(stats.dataset_stats(rows)).first().cvr == 66.67
    nothing = stats.dataset_stats(rows.limit(0)).first()
    assert (nothing.total, nothing.clicks, nothing.ctr, nothing.cpa, nothing.period) == (0, 0, 0, None, "N/A")


EVENTS = [
    # id, timestamp, uid, campaign, click, conversion, conversion_timestamp, cost
    ("e1", 100, "u1", 1, 1, 1, 400, 0.5),
    ("e2", 100, "u2", 1, 1, 0, None, 0.25),
    ("e3", 200, "", 2, 0, 1, 150, None),
    ("e4", 300, "é", 2, 0, 1, None, 0.0),
    ("e5", 300, None, 2, None, None, None, 0.0),
]


@pytest.fixture()
def events(spark):
    return spark.createDataFrame(
        EVENTS,
        "event_id STRING, timestamp BIGINT, uid STRING, campaign INT, click INT, conversion INT, "
        "conversion_timestamp BIGINT, cost DOUBLE",
    )


def test_split(spark, events):
    feed = fanout.split(events)
    kinds = {(r.event_id, r.event_type): r for r in feed.collect()}
    assert len(kinds) == feed.count() == 8
    click = kinds["e1", "click"]
    assert 1 <= click.timestamp - 100 <= 30 and click.impression_timestamp == 100 and click.cost is None
    conversion = kinds["e1", "conversion"]
    assert (conversion.timestamp, conversion.conversion_delay_sec) == (400, 300)
    assert kinds["e3", "impression"].cost == 0.0
    assert ("e3", "conversion") not in kinds

    timed = {r.event_id for r in fanout.split(events, rule="has_timestamp").filter("event_type = 'conversion'").collect()}
    assert timed == {"e1", "e3"}
    assert {r.event_id for r in fanout.conversions(events, "flag").collect()} == {"e1", "e3", "e4"}


@pytest.mark.parametrize("kind", ["impression", "click", "conversion"])
def test_direct_projections_equal_the_feed(events, kind):
    direct = {"impression": fanout.impressions, "click": fanout.clicks, "conversion": fanout.conversions}[kind](events)
    from_feed = fanout.of_kind(fanout.split(events), kind)
    assert direct.columns == from_feed.columns
    assert sorted(map(str, direct.collect())) == sorted(map(str, from_feed.collect()))


def test_summary_and_observed_counters(spark, events):
    feed = fanout.split(events)
    found = fanout.summary(feed).first()
    assert (found.impressions, found.clicks, found.conversions) == (5, 2, 1)
    assert (found.ctr, found.cvr, found.avg_delay_hours) == (40.0, 50.0, 300 / 3600)
    watched, counters = fanout.observed(feed)
    watched.write.format("noop").mode("overwrite").save()
    assert counters.get == {"impressions": 5, "clicks": 2, "conversions": 1}


def test_relink(events):
    linked = {
        r.event_id: r
        for r in fanout.relink(
            fanout.impressions(events), fanout.clicks(events), fanout.conversions(events)
        ).collect()
    }
    assert len(linked) == 5
    assert linked["e1"].conversion_timestamp == 400 and linked["e1"].click_timestamp > 100
    assert linked["e3"].click_timestamp is None and linked["e3"].conversion_timestamp is None


def test_messages(events):
    sent = {(r.topic, json.loads(r.value)["event_id"]): r for r in messages.encode_feed(fanout.split(events)).collect()}
    assert len(sent) == 8
    impression = json.loads(sent["ad-impressions", "e1"].value)
    assert list(impression) == list(schemas.IMPRESSION_MESSAGE)
    assert list(json.loads(sent["ad-clicks", "e1"].value)) == list(schemas.CLICK_MESSAGE)
    assert list(json.loads(sent["ad-conversions", "e1"].value)) == list(schemas.CONVERSION_MESSAGE)
    assert sent["ad-impressions", "e3"].key is None  # blank user
    assert sent["ad-impressions", "e4"].key == "é" and "é" in sent["ad-impressions", "e4"].value

    combined = messages.encode_events(
        events.withColumns({"event_type": F.lit("ad_event"), "event_time": F.lit("t")})
    )
    first = [json.loads(r.value) for r in combined.collect() if '"e2"' in r.value][0]
    assert list(first) == schemas.EVENT.names and first["conversion_timestamp"] is None


def test_split_csv(spark, folder):
    rows = [
        {"timestamp": 300 - i, "uid": f"u{i}", "campaign": 1, "click": i % 2, "conversion": i % 2,
         "conversion_timestamp": 1000 + i if i % 4 == 1 else "", "cost": "" if i % 3 else 0.5}
        for i in range(100)
    ]
    with open(f"{folder}/in.csv", "w", newline="") as out:
        writer = csv.DictWriter(out, fieldnames=schemas.AD_EVENT_COLUMNS)
        writer.writeheader()
        writer.writerows(rows)
    source = files.read_events_csv(spark, f"{folder}/in.csv")
    found = prepare.split_csv(source, f"{folder}/out").first()
    assert (found.impressions, found.clicks, found.conversions) == (100, 50, 25)
    impressions = read_csvs(f"{folder}/out/events_impressions")
    # Numbered as given, written by time.
    assert [r["event_id"] for r in impressions] == [f"evt_{i:08d}" for i in reversed(range(100))]
    prepare.split_csv(source, f"{folder}/by_time", by_time=True)
    impressions = read_csvs(f"{folder}/by_time/events_impressions")
    assert [r["event_id"] for r in impressions] == [f"evt_{i:08d}" for i in range(100)]
    assert [int(r["timestamp"]) for r in impressions] == list(range(201, 301))
    clicks = [int(r["timestamp"]) for r in read_csvs(f"{folder}/out/events_clicks")]
    assert clicks == sorted(clicks)
    as_scanned = prepare.numbered_csv(source, by_time=False, max_events=10)
    assert {r.uid: r.event_id for r in as_scanned.collect()} == {f"u{i}": f"evt_{i:08d}" for i in range(10)}


def test_columns_are_found_by_name_and_quotes_are_standard(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["uid", "note", "cost", "timestamp"])
        writer.writerow(['a"b,c', "x, y", "1.5", "10"])
        writer.writerow(["uid", "note", "cost", "timestamp"])
    with open(f"{folder}/in/b.csv", "w", newline="") as out:
        writer = csv.writer(out, quoting=csv.QUOTE_ALL)
        writer.writerow(["timestamp", "campaign", "uid"])
        writer.writerow(["20", "99999999999", 'say ""hi""'])
    open(f"{folder}/in/c.csv", "w").close()
    read = files.read_events_csv(spark, f"{folder}/in")
    found = sorted(((r.timestamp, r.uid, r.campaign, r.cost) for r in read.collect()), key=str)
    assert found == sorted(
        [("10", 'a"b,c', None, "1.5"), ("timestamp", "uid", None, "cost"), ("20", 'say ""hi""', "99999999999", None)],
        key=str,
    )
    sink_files.write_csv(read, f"{folder}/out", ["uid", "timestamp"])
    assert {r["uid"] for r in read_csvs(f"{folder}/out")} == {'a"b,c', "uid", 'say ""hi""'}
    assert files.read_events_csv(spark, f"{folder}/in/c.csv", position=True).collect() == []

    with open(f"{folder}/lines.csv", "w", newline="") as out:
        csv.writer(out).writerows([["uid", "timestamp"], ["two\nlines", "1"]])
    rows = files.read_events_csv(spark, f"{folder}/lines.csv", multi_line=True).collect()
    assert [(r.uid, r.timestamp) for r in rows] == [("two\nlines", "1")]


def test_tsv_files_with_different_headers(spark, folder):
    os.makedirs(f"{folder}/in")
    write(f"{folder}/in/a.tsv", ["timestamp\tuid\tcost", "1\ta\t0.5", "timestamp\tuid\tcost"])
    write(f"{folder}/in/b.tsv", ["uid\ttimestamp\tcat1", "b\t2\tx"])
    rows = files.read_tsv(spark, f"{folder}/in")
    assert rows.columns == ["timestamp", "uid", "cost", "cat1", "_line"]
    assert sorted(tuple(r)[:4] for r in rows.collect()) == [
        ("1", "a", "0.5", ""), ("2", "b", "", "x"), ("timestamp", "uid", "cost", ""),
    ]


def test_tsv_lines_are_taken_as_they_are(spark, folder):
    lines = ['a\tb', '"q" x\t\\"', "'\t\\\\n", '"open\t\u0001', " lead\t trail ", '"\t"', "#c\t,"]
    rows = files.read_tsv(spark, write(f"{folder}/a.tsv", lines)).collect()
    assert sorted((r.a, r.b) for r in rows) == sorted(tuple(line.split("\t")) for line in lines[1:])
    assert sorted(r["_line"] for r in rows) == sorted(lines[1:])


def test_ids_and_limit_follow_the_files(spark, folder):
    os.makedirs(f"{folder}/in")
    for name, size in (("a", 300), ("b", 5), ("c", 900)):
        with open(f"{folder}/in/{name}.csv", "w") as out:
            out.write("timestamp,uid,campaign\n")
            out.writelines(f"{1000 - n},{name}{n},c{n}\n" for n in range(size))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        rows = files.read_events_csv(spark, f"{folder}/in", position=True)
        assert rows.rdd.getNumPartitions() > 5
        numbered = prepare.numbered_csv(rows).orderBy("event_id").collect()
        wanted = [f"{name}{n}" for name, size in (("a", 300), ("b", 5), ("c", 900)) for n in range(size)]
        assert [r.uid for r in numbered] == wanted
        first = prepare.numbered_csv(rows, max_events=307)
        assert sorted(r.uid for r in first.collect()) == sorted(wanted[:307])
        by_time = prepare.numbered_csv(rows, by_time=True).orderBy("event_id").first()
        assert by_time.timestamp == 101
        prepare.split_csv(rows, f"{folder}/out")
        assert {r["campaign"] for r in read_csvs(f"{folder}/out/events_impressions")} == {f"c{n}" for n in range(900)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_share_of_copies_in_a_sample_is_fair(spark, folder):
    lines = [HEADER.split("\t")] + [["7"] * 9 if n % 3 == 0 else [str(n)] * 9 for n in range(3000)]
    write(f"{folder}/log.tsv", ["\t".join(line) for line in lines])
    log_rows = files.read_tsv(spark, f"{folder}/log.tsv").withColumn("_row", F.monotonically_increasing_id()).cache()
    # Hypergeometric: 300 of 3000 rows, of which 1000 are alike.
    deviation = (300 * (1 / 3) * (2 / 3) * (2700 / 2999)) ** 0.5
    for seed in range(20):
        drawn = sampling.sample_exact(log_rows, 300, "_row", seed)
        total, copies = drawn.agg(F.count("*"), F.count(F.when(F.col("uid") == "7", 1))).first()
        assert total == 300 and abs(copies - 100) < 4 * deviation
    log_rows.unpersist()


def test_csv_roundtrip_keeps_blank_apart_from_zero(spark, folder):
    rows = spark.sql("SELECT 1L timestamp, '' uid, 2 campaign, 0 click, 0 conversion, CAST(NULL AS BIGINT) conversion_timestamp, 0.0D cost")
    sink_files.write_csv(rows, f"{folder}/x", schemas.AD_EVENT_COLUMNS)
    (part,) = glob.glob(f"{folder}/x/part-*.csv")
    with open(part) as lines:
        assert lines.read().splitlines() == [",".join(schemas.AD_EVENT_COLUMNS), "1,,2,0,0,,0.0"]
    back = files.typed_events(files.read_events_csv(spark, f"{folder}/x")).first()
    assert back.uid == "" and back.conversion_timestamp is None
    assert os.path.exists(f"{folder}/x/_SUCCESS")
