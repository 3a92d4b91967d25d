"""The command line, from log to summary, on local files."""

import json
import os
from datetime import datetime

import pytest

from clickloom import __main__ as cli
from clickloom import schemas, session
from clickloom.operators import health
from clickloom.sinks import scratch, tables
from clickloom.sources import segments


def test_from_log_to_summary(spark, folder, capsys):
    lines = ["\t".join(["timestamp", "uid", "campaign", "click", "conversion", "conversion_timestamp", "cost"])]
    lines += [f"{i * 3600}\tu{i % 9}\t{i % 4}\t{i % 2}\t{int(i % 6 == 1)}\t{i * 3600 + 90}\t0.5" for i in range(240)]
    with open(f"{folder}/log.tsv", "w") as out:
        out.write("\n".join(lines) + "\n")

    cli.main(["prepare", "--input", f"{folder}/log.tsv", "--output", f"{folder}/data"])
    assert "2026-04-01 00:00 ~ 2026-04-10 23:00" in capsys.readouterr().out
    cli.main(["split", "--input", f"{folder}/data/ad_events", "--output", f"{folder}/feeds"])
    assert sorted(os.listdir(f"{folder}/feeds")) == ["events_clicks", "events_conversions", "events_impressions"]

    cli.main(["publish", "--csv", f"{folder}/data/ad_events", "--realistic", "--output-path", f"{folder}/three"])
    assert "{'impressions': 240, 'clicks': 120, 'conversions': 40}" in capsys.readouterr().out
    cli.main(["publish", "--csv", f"{folder}/data/ad_events", "--max-events", "200", "--output-path", f"{folder}/published"])

    # what a broker would add to each message
    published = spark.read.json(f"{folder}/published")
    assert published.count() == 200
    stamped = published.selectExpr("*", "0 AS partition", "monotonically_increasing_id() AS offset", "current_timestamp() AS timestamp")
    stamped.write.json(f"{folder}/topic")
    ingest = ["ingest", "--messages-path", f"{folder}/topic", "--raw-path", f"{folder}/raw", "--checkpoint-path", f"{folder}/offsets", "--available-now", "--source-option", "maxFilesPerTrigger=3"]
    for _ in range(2):
        cli.main(ingest)

    base = ["--base-path", f"{folder}/tables"]
    window = ["--merge-window-days", "3", "--as-of", "2026-04-09"]
    for _ in range(2):
        cli.main(["silver", "--raw-path", f"{folder}/raw", *base, *window])
        cli.main(["gold", *base, *window])
    processed = tables.processed_events(f"{folder}/tables").read(spark)
    assert processed.count() == 200 - 5 * 24
    summary = tables.campaign_summary(f"{folder}/tables").read(spark)
    assert summary.agg({"impressions": "sum"}).first()[0] == 80

    cli.main(["backfill", "--raw-path", f"{folder}/raw", "--first", "2026-04-02", "--last", "2026-04-03", *base])
    assert processed.sparkSession.read.parquet(f"{folder}/tables/processed_events").count() == 80 + 48
    cli.main(["silver", "--raw-path", f"{folder}/raw", "--mode", "full-refresh", *base])
    cli.main(["compact", *base])
    cli.main(["health", *base])
    out = capsys.readouterr().out
    assert "partitions rewritten" in out and "newest_event_date" in out
    assert tables.processed_events(f"{folder}/tables").read(spark).count() == 200


def test_health_shows_everything(spark, folder, capsys):
    table = tables.processed_events(folder)
    rows = spark.range(1000).selectExpr(
        "concat('e', if(id < 150, id % 50, id)) AS event_id", "date_add(date'2024-01-01', cast(id % 100 AS int)) AS event_date",
        "'u' AS uid", "1 AS campaign", "0 AS click", "0 AS conversion", "cast(NULL AS bigint) AS conversion_delay_sec",
        "0d AS cost", "timestamp'2024-05-01' AS updated_at",
    )
    table.ensure(spark)
    table.append(rows)
    cli.main(["health", "--base-path", folder])
    out = capsys.readouterr().out
    assert "rows_per_day: 100" in out and "duplicate_keys: 50" in out and "files: 100" in out
    assert out.count("copies=3") == 50 and out.count("files=") == 100
    assert "event_date=2024-04-09, rows=10" in out
    cli.main(["health", "--base-path", folder, "--output", f"{folder}/report"])
    assert spark.read.parquet(f"{folder}/report/duplicate_keys").count() == 50
    assert spark.read.parquet(f"{folder}/report/files").count() == 100


def test_compact_jobs(spark, folder):
    table = tables.campaign_summary(folder)
    rows = spark.range(300).selectExpr(
        "date_add(date'2024-01-01', cast(id % 3 AS int)) AS summary_date", "cast(id AS int) AS campaign", "1L AS impressions",
        "0L AS clicks", "0L AS conversions", "0d AS total_cost", "0d AS ctr", "0d AS cvr", "0d AS cpa", "timestamp'2024-05-01' AS updated_at",
    )
    table.ensure(spark)
    for part in range(4):
        table.append(rows.filter(f"campaign % 4 = {part}"))
    cli.main(["compact", "--base-path", folder, "--table", "campaign_summary", "--summary"])
    assert {r.files for r in health.file_layout(spark, table.path, "summary_date").collect()} == {1}
    assert table.read(spark).count() == 300


def test_smoke_job(spark, folder):
    cli.main(["smoke", "--output-path", f"{folder}/out", "--checkpoint-path", f"{folder}/c", "--duration-sec", "5", "--rows-per-second", "20"])
    assert spark.read.parquet(f"{folder}/out").columns == ["timestamp", "value", "ingest_ts"]


def test_catalog_settings():
    conf = session.catalog_conf("lake", "s3://bucket/warehouse", "glue")
    assert conf["spark.sql.catalog.lake.warehouse"] == "s3://bucket/warehouse"
    assert "spark.sql.catalog.lake.catalog-impl" in conf
    assert session.catalog_conf("lake", "/w")["spark.sql.catalog.lake.type"] == "hadoop"
    with pytest.raises(ValueError):
        session.catalog_conf("lake", "/w", "other")
    with pytest.raises(SystemExit):
        cli.main(["silver", "--raw-path", "x"])


def test_scratch_is_the_shared_folder(spark):
    assert scratch.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    with scratch.staged(spark.range(3), "x") as rows:
        (path,) = {file.rsplit("/", 1)[0] for file in rows.inputFiles()}
        assert rows.count() == 3 and os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
    (path,) = {file.rsplit("/", 1)[0] for file in scratch.written(spark.range(3), "x").inputFiles()}
    scratch.clear(spark)
    assert not os.path.exists(path.removeprefix("file:"))


def _messages(spark, path, rows, topic):
    """(offset, fields) as message files, each sent at its own time."""
    lines = [(o, json.dumps(fields), datetime.fromtimestamp(fields["timestamp"])) for o, fields in rows]
    frame = spark.createDataFrame(lines, "offset long, value string, timestamp timestamp")
    frame.selectExpr("'k' AS key", "value", f"'{topic}' AS topic", "0 AS partition", "offset", "timestamp").write.mode("append").json(path)


def test_stream_jobs(spark, folder):
    start = 1_704_067_200
    events = [(n, {"event_id": f"e{n}", "timestamp": start + n, "campaign": n % 3, "click": n % 2, "conversion": 0, "cost": 1.0}) for n in range(30)]
    _messages(spark, f"{folder}/topic", events, "ad-events")
    _messages(spark, f"{folder}/topic", [(100 + n, fields) for n, fields in events], "ad-events")
    given = ["--messages-path", f"{folder}/topic", "--available-now"]
    cli.main(["ingest", *given, "--raw-path", f"{folder}/raw", "--checkpoint-path", f"{folder}/c1", "--once-within", "1 day"])
    assert spark.read.parquet(f"{folder}/raw").count() == 30

    cli.main(["stream-gold", *given, "--base-path", f"{folder}/tables", "--checkpoint-path", f"{folder}/c2"])
    summary = tables.campaign_summary(f"{folder}/tables").read(spark)
    assert sorted((r.campaign, r.impressions, r.clicks) for r in summary.collect()) == [(0, 10, 5), (1, 10, 5), (2, 10, 5)]

    far = start + 90 * 86_400
    for topic, shift in (("ad-impressions", 0), ("ad-clicks", 9), ("ad-conversions", 70)):
        rows = [(n, {"event_id": f"e{n}", "timestamp": start + n + shift}) for n in range(0, 30, 1 + shift // 9)]
        _messages(spark, f"{folder}/three/{topic}", [*rows, (99, {"event_id": f"last {topic}", "timestamp": far})], topic)
    cli.main(["relink", "--messages-path", f"{folder}/three", "--available-now", "--output-path", f"{folder}/linked", "--checkpoint-path", f"{folder}/c3"])
    linked = spark.read.parquet(f"{folder}/linked")
    assert linked.count() == 30
    assert linked.filter("click_timestamp = timestamp + 9").count() == 15
    assert linked.filter("conversion_timestamp = timestamp + 70").count() == 4

    segments.publish(spark.read.schema(schemas.MESSAGE).json(f"{folder}/topic"), f"{folder}/placed")
    cli.main(["ingest", "--messages-path", f"{folder}/placed", "--by-position", "--starting-offsets", "0:110", "--available-now", "--raw-path", f"{folder}/raw2", "--checkpoint-path", f"{folder}/c4"])
    assert spark.read.parquet(f"{folder}/raw2").count() == 20
