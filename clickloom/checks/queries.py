"""Every operator as a query over the event tables, comparable with its SQL in ``oracles``.

Dates and times are returned as text and sums rounded, so that two engines can
be compared by value; run times are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.operators import attribution_log as log
from clickloom.operators import dedup, fanout, gaps, health, ranking, sampling, sketches, stats
from clickloom.operators.summary import campaign_days
from clickloom.plans import compact, event_table, gold, prepare, silver
from clickloom.sinks import files as sink_files
from clickloom.sinks import messages as message_sink
from clickloom.sinks import scratch, tables
from clickloom.sources import files, segments, streams
from clickloom.streaming import counters, ingest, relink
from clickloom.streaming import gaps as streaming_gaps
from clickloom.streaming import gold as streaming_gold

# The tables cover January 2024. The first load sees it up to FIRST_LOAD, and
# the later runs as it was known on AS_OF.
AS_OF = date(2024, 1, 30)
FIRST_LOAD = date(2024, 1, 25)
BACKFILL = (date(2024, 1, 10), date(2024, 1, 20))
RUN_AT = datetime(2024, 2, 1)
LOG_START = 1_704_067_200

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame, drop: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    formats = {T.DateType: "yyyy-MM-dd", T.TimestampType: "yyyy-MM-dd HH:mm:ss"}
    rounding = {"total_cost": 4, "ctr": 6, "cvr": 6, "cpa": 6, "avg_delay_hours": 6, "cost": 4}
    columns = []
    for field in df.drop(*drop).schema.fields:
        column = F.col(field.name)
        if type(field.dataType) in formats:
            column = F.date_format(column, formats[type(field.dataType)])
        elif field.name in rounding and isinstance(field.dataType, T.DoubleType):
            column = F.round(column, rounding[field.name])
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse(event_table.messages(spark, sf_dir))


def _project(events: DataFrame) -> DataFrame:
    """Events as processed rows, without a raw zone between (their ids are unique)."""
    unsent = {f"kafka_{name}": F.lit(None) for name in ("timestamp", "partition", "offset")}
    rows = events.withColumns({"event_timestamp": F.timestamp_seconds("timestamp"), **unsent})
    return silver.project(rows, RUN_AT).select(schemas.PROCESSED_EVENTS.names)


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(event_table.ad_events(spark, sf_dir))


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = AS_OF - timedelta(days=7)
    return silver.recent_rows(_project(event_table.ad_events(spark, sf_dir, first)), 7, AS_OF)


def _stored_raw(rows: DataFrame) -> DataFrame:
    """``rows`` as a raw zone on disk, landed as they were sent, the form in which later stages read them."""
    landed = rows.withColumns(
        {
            "ingest_ts": F.col("kafka_timestamp"),
            "raw_date": F.to_date("kafka_timestamp"),
            "raw_hour": F.hour("kafka_timestamp"),
        }
    )
    path = scratch.new_path(rows.sparkSession, "raw")
    landed.hint("rebalance", "raw_date").write.partitionBy("raw_date").parquet(path)
    return files.read_raw(rows.sparkSession, path)


def _with_landing(raw: DataFrame) -> DataFrame:
    """Whether each row lies in the folders its time of arrival names."""
    right = (F.to_date("ingest_ts") == F.col("raw_date")) & (F.hour("ingest_ts") == F.col("raw_hour"))
    return raw.withColumn("landed_right", right).drop("ingest_ts", "raw_date", "raw_hour")


def _first_known(spark: SparkSession, sf_dir: str, all_days: bool = False) -> DataFrame:
    """Processed rows as of FIRST_LOAD: earlier events, without conversions still to come.

    With ``all_days`` later events are there too, likewise without conversions from then on.
    """
    known = F.unix_timestamp(F.lit(FIRST_LOAD).cast("timestamp"))
    happened = F.col("conversion_timestamp") < known
    events = event_table.ad_events(spark, sf_dir)
    if not all_days:
        events = events.filter(F.col("timestamp") < known)
    return _project(
        events.withColumns(
            {
                "conversion": F.when(happened, F.col("conversion")).otherwise(F.lit(0)),
                "conversion_timestamp": F.when(happened, F.col("conversion_timestamp")),
            }
        )
    )


def _loaded_table(spark: SparkSession, sf_dir: str, all_days: bool = False) -> tables.PathTable:
    table = tables.processed_events(scratch.new_path(spark, "warehouse"))
    table.ensure(spark)
    table.overwrite_partitions(_first_known(spark, sf_dir, all_days))
    return table


def _with_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows, and a day later each clicked event again with a higher cost and converted."""
    raw = _raw(spark, sf_dir)
    corrected = raw.filter("click = 1").withColumns(
        {
            "kafka_timestamp": F.col("kafka_timestamp") + F.expr("INTERVAL 1 DAY"),
            "cost": F.col("cost") + 1,
            "conversion": F.lit(1),
            "conversion_timestamp": F.col("timestamp") + 60,
        }
    )
    return _stored_raw(raw.unionByName(corrected))


def ad_events_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(event_table.ad_events(spark, sf_dir))


def raw_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_raw(spark, sf_dir))


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone written as parquet and as JSON, both read back."""
    rows = ingest.to_raw(event_table.messages(spark, sf_dir))
    scans = []
    for fmt in ("parquet", "json"):
        path = scratch.new_path(spark, "raw")
        rows.write.partitionBy(*schemas.RAW_PARTITIONS).format(fmt).save(path)
        scans.append(files.read_raw(spark, path, fmt).withColumn("fmt", F.lit(fmt)))
    both = scans[0].unionByName(scans[1])
    return _plain(_with_landing(both))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order and one more, and users with quotes and commas in their names."""
    path = scratch.new_path(spark, "csv")
    events = event_table.ad_events(spark, sf_dir).withColumns(
        {
            "uid": F.concat(F.lit('"a", '), F.col("uid"), F.lit('"')),
            "note": F.lit('x,"y'),
        }
    )
    sink_files.write_csv(events, path, [*reversed(schemas.AD_EVENT_COLUMNS), "note"])
    return _plain(files.typed_events(files.read_events_csv(spark, path)))


def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(silver.transform(_raw(spark, sf_dir)))


def silver_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(silver.transform(_with_corrections(spark, sf_dir)))


def silver_dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered twice: whichever copy is kept is the same row."""
    processed = _processed(spark, sf_dir)
    return _plain(dedup.any_row(processed.unionByName(processed), ["event_id"]))


def silver_recent_prefiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _with_corrections(spark, sf_dir)
    return _plain(silver.transform_recent(raw, 7, AS_OF, assume_ingested_later=True))


def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_recent(spark, sf_dir))


def campaign_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.summarize(_recent(spark, sf_dir), 7, AS_OF))


def campaign_summary_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(campaign_days(_processed(spark, sf_dir)))


def merge_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load, then the recent window merged over it: late conversions and new days."""
    table = _loaded_table(spark, sf_dir)
    table.upsert(_recent(spark, sf_dir), unique=True)
    return _plain(table.read(spark))


def merge_far_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth event has its time in milliseconds, some 50,000 years ahead; merged twice."""
    events = event_table.ad_events(spark, sf_dir)
    far = F.pmod(event_table.number(events), F.lit(50)) == 0
    time = F.when(far, F.col("timestamp") * 1000).otherwise(F.col("timestamp"))
    rows = _project(events.withColumn("timestamp", time))
    table = tables.processed_events(scratch.new_path(spark, "warehouse"))
    table.ensure(spark)
    for _ in range(2):
        table.upsert(rows)
    return _plain(table.read(spark).withColumn("event_day", F.unix_date("event_date"))).drop("event_date")


def merge_processed_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge as one plan that writes nothing."""
    source = _recent(spark, sf_dir)
    return _plain(silver.merged(_first_known(spark, sf_dir), source))


def merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = tables.campaign_summary(scratch.new_path(spark, "warehouse"))
    gold.run(_first_known(spark, sf_dir), summary, 7, FIRST_LOAD, run_at=RUN_AT)
    gold.run(_processed(spark, sf_dir), summary, 7, AS_OF, run_at=RUN_AT)
    return _plain(summary.read(spark))


def full_refresh_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the partitions of the refreshed days are replaced."""
    table = _loaded_table(spark, sf_dir)
    table.overwrite_partitions(_recent(spark, sf_dir))
    return _plain(table.read(spark))


def append_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blind append: rows of the overlapping days are there twice."""
    table = _loaded_table(spark, sf_dir)
    table.append(_recent(spark, sf_dir))
    return _plain(table.read(spark))


def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late conversions of eleven days, merged into a table of all days."""
    table = _loaded_table(spark, sf_dir, all_days=True)
    raw = _stored_raw(_raw(spark, sf_dir))
    silver.backfill(raw, table, *BACKFILL, run_at=RUN_AT, assume_ingested_later=True)
    return _plain(table.read(spark))


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(stats.dataset_stats(event_table.ad_events(spark, sf_dir)))


def stats_for_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(stats.for_display(stats.dataset_stats(event_table.ad_events(spark, sf_dir))))


def scan_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over times of which those of unclicked events are no whole numbers."""
    events = event_table.ad_events(spark, sf_dir)
    text = F.concat(F.col("timestamp").cast("string"), F.when(F.col("click") == 0, ".5").otherwise(""))
    return stats.scan_stats(events.select(text.alias("timestamp")))


def _feed(spark: SparkSession, sf_dir: str, rule: str = "positive_delay") -> DataFrame:
    return fanout.split(event_table.ad_events(spark, sf_dir), rule=rule)


def _with_last_second(events: DataFrame) -> DataFrame:
    """The events, and every five-hundredth again, clicked in the last second a BIGINT holds."""
    chosen = events.filter(F.pmod(event_table.number(events), F.lit(500)) == 0)
    extreme = chosen.withColumns(
        {
            "event_id": F.concat(F.lit("x"), F.col("event_id")),
            "timestamp": F.lit(2**63 - 1),
            "click": F.lit(1),
            "conversion": F.lit(0),
        }
    )
    return events.unionByName(extreme)


def fanout_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.split(_with_last_second(event_table.ad_events(spark, sf_dir))))


def fanout_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.impressions(event_table.ad_events(spark, sf_dir)))


def fanout_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.in_time_order(fanout.clicks(event_table.ad_events(spark, sf_dir))))


def fanout_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.in_time_order(fanout.conversions(event_table.ad_events(spark, sf_dir))))


def _three_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = event_table.ad_events(spark, sf_dir)
    return fanout.impressions(events), fanout.clicks(events), fanout.conversions(events)


def fanout_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three feeds as separate sets, put together again."""
    return _plain(fanout.together(*_three_feeds(spark, sf_dir)))


def conversions_with_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.conversions(event_table.ad_events(spark, sf_dir), "has_timestamp"))


def fanout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.summary(_feed(spark, sf_dir)))


def topic_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed published as messages, counted while it is written."""
    feed, counters = fanout.observed(_feed(spark, sf_dir))
    message_sink.publish_files(message_sink.encode_feed(feed), scratch.new_path(spark, "topics"))
    counts = [(schemas.TOPICS[kind[:-1]], n) for kind, n in counters.get.items()]
    return spark.createDataFrame(counts, "topic string, messages bigint")


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's messages read back: key, topic, the names of the fields, and their values."""
    sent = message_sink.encode_feed(_feed(spark, sf_dir))
    fields = T.StructType(
        [f for f in schemas.EVENT if f.name in schemas.IMPRESSION_MESSAGE]
        + [T.StructField("conversion_delay_sec", T.LongType())]
    )
    return _plain(
        sent.select(
            "key",
            "topic",
            F.array_join(F.json_object_keys("value"), ",").alias("fields"),
            F.inline(F.array(F.from_json("value", fields))),
        )
    )


def relink_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fanout.relink(*_three_feeds(spark, sf_dir)))


def _damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which the unclicked ones are cut off and the converted ones have a bad campaign."""
    messages = event_table.messages(spark, sf_dir)
    value = F.col("value")
    damaged = (
        F.when(value.contains('"click":0'), F.substring(value, F.lit(1), F.length(value) - 10))
        .when(
            value.contains('"conversion":1'),
            F.regexp_replace(value, r'"campaign":\d+', '"campaign":"none"'),
        )
        .otherwise(value)
    )
    return messages.withColumn("value", damaged)


def message_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ingest.parse(_damaged_messages(spark, sf_dir)), ("event_timestamp",))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ingest.dead_letters(_damaged_messages(spark, sf_dir)))


def _tsv(spark: SparkSession, sf_dir: str) -> str:
    """An attribution log with relative times, short, long and blank lines."""
    events = event_table.ad_events(spark, sf_dir)
    columns = schemas.AD_EVENT_COLUMNS + ("cat1",)
    values = {name: F.col(name).cast("string") for name in schemas.AD_EVENT_COLUMNS}
    values["timestamp"] = (F.col("timestamp") - LOG_START).cast("string")
    values["conversion_timestamp"] = F.coalesce(
        (F.col("conversion_timestamp") - LOG_START).cast("string"), F.lit("-1")
    )
    values["cat1"] = F.col("event_id")
    # The converted ones again, with a conversion time no base can be added to.
    events = events.unionByName(
        events.filter("conversion = 1").withColumn("conversion_timestamp", F.lit(2**63 - 1))
    )
    values["conversion_timestamp"] = F.when(
        F.col("conversion_timestamp") == 2**63 - 1, F.col("conversion_timestamp").cast("string")
    ).otherwise(values["conversion_timestamp"])
    full = F.concat_ws("\t", *[values[name] for name in columns])
    short = F.concat_ws("\t", *[values[name] for name in columns[:3]])
    line = (
        F.when(F.col("conversion") == 1, F.concat(full, F.lit("\tone\ttoo many")))
        .when(F.col("click") == 0, short)
        .otherwise(full)
    )
    lines = events.select(F.explode(F.array(line, F.lit(""))).alias("\t".join(columns)))
    path = scratch.new_path(spark, "tsv")
    # A one-column CSV with a separator that occurs nowhere: plain lines under a header.
    (
        lines.write.option("header", True)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("emptyValue", "")
        .option("ignoreTrailingWhiteSpace", False)
        .option("ignoreLeadingWhiteSpace", False)
        .csv(path)
    )
    return path


def tsv_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.read_tsv(spark, _tsv(spark, sf_dir))
    latest = stats.scan_stats(rows).first().max_ts
    return log.convert(rows, log.choose_base(latest)).withColumn(
        "cost", F.col("cost").cast("double")
    )


def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the rows, exactly."""
    events = event_table.ad_events(spark, sf_dir)
    return _plain(sampling.sample_exact(events, events.count() // 4, "event_id"))


def sample_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the rows, of which every third holds the same line: rows are drawn, not lines."""
    events = event_table.ad_events(spark, sf_dir)
    same = F.pmod(event_table.number(events), F.lit(3)) == 0
    line = F.when(same, "the same line").otherwise(F.col("uid"))
    rows = events.select(F.col("event_id").alias("row"), line.alias("line"))
    return sampling.sample_exact(rows, rows.count() // 4, "row")


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_table.ad_events(spark, sf_dir).select("timestamp", "event_id")
    return ranking.with_row_index(events, ["timestamp", "event_id"])


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids given anew, in time order."""
    events = event_table.ad_events(spark, sf_dir)
    return _plain(prepare.identified(events, ["timestamp", "event_id"]))


def time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_table.ad_events(spark, sf_dir)
    return _plain(prepare.in_time_order(events, ["event_id"]))


def head_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_table.ad_events(spark, sf_dir)
    return _plain(prepare.slices(events, ["event_id"]).head)


def tail_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_table.ad_events(spark, sf_dir)
    return _plain(prepare.slices(events, ["event_id"]).tail)


def max_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay limit of 5,000 events."""
    events = event_table.ad_events(spark, sf_dir)
    return _plain(prepare.first_events(events, 5000, ["event_id"]))


def max_events_as_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 5,000 events in the order of files, blocks and places, numbered in it."""
    events = event_table.ad_events(spark, sf_dir)
    n = event_table.number(events)
    text = events.select(
        *(F.col(name).cast("string").alias(name) for name in schemas.AD_EVENT_COLUMNS),
        F.concat(F.lit("file"), F.pmod(n, F.lit(3))).alias("_file"),
        F.pmod(n, F.lit(5)).alias("_block"),
        (-n).alias("_scan"),
    )
    return _plain(prepare.numbered_csv(text, max_events=5000))


def interevent_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also for users with events in the first and in the last second a BIGINT holds."""
    events = event_table.ad_events(spark, sf_dir).select("event_id", "uid", "timestamp")
    n = event_table.number(events)
    ends = F.when(F.pmod(n, F.lit(1000)) == 0, F.lit(2**63 - 1)).otherwise(F.lit(-(2**63)))
    extreme = events.filter(F.pmod(n, F.lit(500)) == 0).withColumns(
        {"timestamp": ends, "event_id": F.concat(F.lit("x"), F.col("event_id"))}
    )
    return gaps.with_gap(events.unionByName(extreme))


def health_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = _processed(spark, sf_dir)
    return _plain(health.freshness(processed, datetime(2024, 2, 2), date(2024, 2, 2)))


def health_rows_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(health.rows_per_day(_processed(spark, sf_dir)))


def health_rows_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.processed_events(scratch.new_path(spark, "warehouse"))
    table.ensure(spark)
    table.overwrite_partitions(_processed(spark, sf_dir))
    return _plain(health.rows_per_day_from_footers(spark, table.path))


def health_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.duplicate_keys(_with_corrections(spark, sf_dir))


def health_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the files of any table: how many and how large they are is Spark's choice."""
    table = tables.processed_events(scratch.new_path(spark, "warehouse"))
    table.ensure(spark)
    table.overwrite_partitions(_processed(spark, sf_dir))
    found = health.file_layout(spark, table.path)
    return _plain(
        found.select(
            "event_date",
            (F.col("files") >= 1).alias("has_files"),
            (F.abs(F.col("mean_bytes") * F.col("files") - F.col("bytes")) < 1).alias("mean_fits"),
            F.col("largest_bytes").between(F.col("mean_bytes"), F.col("bytes")).alias("largest_fits"),
        )
    )


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many small files after its compaction."""
    table = _loaded_table(spark, sf_dir)
    table.append(_recent(spark, sf_dir))
    compact.run(spark, table)
    return _plain(table.read(spark))


def compacted_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of all days, written campaign by campaign parity, after its compaction."""
    table = tables.campaign_summary(scratch.new_path(spark, "warehouse"))
    table.ensure(spark)
    whole = campaign_days(_processed(spark, sf_dir)).withColumn("updated_at", F.lit(RUN_AT))
    for parity in range(2):
        table.append(whole.filter(F.pmod("campaign", F.lit(2)) == parity))
    compact.run(spark, table)
    return _plain(table.read(spark))


def compacted_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streamed raw zone, copied into files of the target size."""
    source, raw, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "raw", "offsets"))
    for known in (True, False):
        _published(spark, sf_dir, known, source)
        _land(spark, source, raw, checkpoint)
    copy = scratch.new_path(spark, "raw")
    compact.raw_copy(spark, raw, copy)
    return _plain(_with_landing(files.read_raw(spark, copy)))


def _published(spark: SparkSession, sf_dir: str, known: bool, path: str) -> None:
    """Messages of the days before FIRST_LOAD, or of those from then on, into one folder."""
    first_load = F.lit(FIRST_LOAD).cast("timestamp")
    messages = event_table.messages(spark, sf_dir)
    early = F.col("timestamp") < first_load
    message_sink.publish_files(messages.filter(early if known else ~early), path)


def _land(spark: SparkSession, source: str, raw: str, checkpoint: str) -> None:
    stream = ingest.to_raw(streams.file_messages(spark, source))
    ingest.run_for(ingest.land(stream, raw, checkpoint, available_now=True))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, raw, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "raw", "offsets"))
    message_sink.publish_files(event_table.messages(spark, sf_dir), source)
    _land(spark, source, raw, checkpoint)
    return _plain(_with_landing(files.read_raw(spark, raw)))


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs from one checkpoint; the second finds nothing new, the third the later days."""
    source, raw, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "raw", "offsets"))
    _published(spark, sf_dir, True, source)
    _land(spark, source, raw, checkpoint)
    _land(spark, source, raw, checkpoint)
    _published(spark, sf_dir, False, source)
    _land(spark, source, raw, checkpoint)
    return _plain(_with_landing(files.read_raw(spark, raw)))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of messages merged into the processed table as they come, one of them twice."""
    source, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "offsets"))
    table = tables.processed_events(scratch.new_path(spark, "warehouse"))
    for known in (True, True, False):
        _published(spark, sf_dir, known, source)
        stream = streams.file_messages(spark, source)
        ingest.run_for(ingest.upsert_stream(stream, table, checkpoint, available_now=True))
    return _plain(table.read(spark))


def stream_upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections arrive first and what they correct afterwards: the newest message wins all the same."""
    source, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "offsets"))
    table = tables.versioned_events(scratch.new_path(spark, "warehouse"))
    events = event_table.ad_events(spark, sf_dir)
    corrected = events.filter("click = 1").withColumns(
        {
            "cost": F.col("cost") + 1,
            "conversion": F.lit(1),
            "conversion_timestamp": F.col("timestamp") + 60,
        }
    )
    later = event_table.as_messages(corrected, F.col("timestamp") + 86_400)
    for messages in (later, event_table.as_messages(events)):
        message_sink.publish_files(messages, source)
        stream = streams.file_messages(spark, source)
        ingest.run_for(
            ingest.upsert_stream(stream, table, checkpoint, available_now=True, within_days=1)
        )
    return _plain(table.read(spark).drop("version"))


def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice, the second time after a restart and at another offset: each lands once."""
    source, raw, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "raw", "offsets"))
    messages = event_table.messages(spark, sf_dir)
    for copy in range(2):
        message_sink.publish_files(messages.withColumn("offset", F.col("offset") + copy * 10**9), source)
        stream = ingest.to_raw(ingest.once(streams.file_messages(spark, source)))
        ingest.run_for(ingest.land(stream, raw, checkpoint, available_now=True))
    return _plain(_with_landing(files.read_raw(spark, raw)))


def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic in one plain folder with its times of arrival, by a run of ten minutes at most; and from its beginning
    again, by a new checkpoint."""
    source = scratch.new_path(spark, "topic")
    message_sink.publish_files(event_table.messages(spark, sf_dir), source)
    runs = []
    for run in (1, 2):
        landed, checkpoint = (scratch.new_path(spark, x) for x in ("landed", "offsets"))
        stream = ingest.with_ingest_time(streams.file_messages(spark, source))
        query = ingest.land(stream, landed, checkpoint, partition_by=(), available_now=True)
        ingest.run_for(query, 600)
        arrived = (F.col("ingest_ts") > F.col("timestamp")) & (F.col("ingest_ts") < F.current_timestamp())
        runs.append(
            spark.read.parquet(landed).select(
                F.lit(run).alias("run"),
                F.get_json_object(F.col("value").cast("string"), "$.event_id").alias("event_id"),
                F.col("key").cast("string").alias("uid"),
                "partition",
                "offset",
                arrived.alias("arrived"),
            )
        )
    return runs[0].unionByName(runs[1])


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-out as a stream in two runs, counted by batch while it is sent."""
    names = ("events", "topics", "offsets", "counts")
    source, topics, checkpoint, counts = (scratch.new_path(spark, x) for x in names)
    listener = counters.BatchCounters(spark, counts)
    spark.streams.addListener(listener)
    try:
        for known in (True, False):
            _published(spark, sf_dir, known, source)
            events = ingest.parse(streams.file_messages(spark, source))
            feed = counters.observed(fanout.split(events))
            query = ingest.land(
                message_sink.encode_feed(feed), topics, checkpoint, "json", ("topic",), available_now=True
            )
            ingest.run_for(query)
            counters.wait_for(spark, counts, query)
    finally:
        spark.streams.removeListener(listener)
    found = counters.totals(spark, counts)
    kinds = F.create_map(*(F.lit(x) for kind in fanout.KINDS for x in (f"{kind}s", schemas.TOPICS[kind])))
    return found.select(kinds[F.col("kind")].alias("topic"), F.col("events").alias("messages"))


def stream_relink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three topics linked as they arrive: days before FIRST_LOAD, the others, and last a message for each topic far ahead.

    The last ones move the watermark past all impressions; they link to nothing.
    """
    # Times from the feed itself: taken from the payload, it would be encoded and parsed again for each filter.
    seconds = F.col("timestamp")
    sent = message_sink.encode_feed(
        _feed(spark, sf_dir),
        F.lit(0).alias("partition"), seconds.alias("offset"), F.timestamp_seconds(seconds).alias("timestamp"),
    )
    last = sent.groupBy("topic").agg(F.max("timestamp").alias("last"))
    ahead = F.unix_seconds(F.col("last")) + 90 * 86_400
    value = F.to_json(F.struct(F.concat(F.lit("last of "), F.col("topic")).alias("event_id"), ahead.alias("timestamp")))
    closing = last.select(
        F.lit(None).cast("string").alias("key"), value.alias("value"), "topic", F.lit(0).alias("partition"),
        ahead.alias("offset"), F.timestamp_seconds(ahead).alias("timestamp"),
    )
    first_load = F.lit(FIRST_LOAD).cast("timestamp")
    deliveries = [sent.filter(F.col("timestamp") < first_load), sent.filter(F.col("timestamp") >= first_load), closing]
    topics, linked, checkpoint = (scratch.new_path(spark, x) for x in ("topics", "linked", "offsets"))
    for delivery in deliveries:
        message_sink.publish_topics(delivery, topics)
        places = [message_sink.topic_path(topics, schemas.TOPICS[kind]) for kind in fanout.KINDS]
        feeds = [relink.feed(streams.file_messages(spark, place)) for place in places]
        rows = relink.relinked(*feeds, convert_within="4 days")
        ingest.run_for(ingest.land(rows, linked, checkpoint, partition_by=(), available_now=True))
    return _plain(spark.read.parquet(linked))


def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps on a stream in two deliveries, each in no order, and a last event far ahead, of a user with no other."""
    events = event_table.ad_events(spark, sf_dir)
    last = events.groupBy().agg((F.max("timestamp") + 90 * 86_400).alias("timestamp"))
    blank = {name: F.lit(None).cast(events.schema[name].dataType) for name in events.columns if name != "timestamp"}
    closing = last.withColumns(blank | {"event_id": F.lit("evt_00000000"), "uid": F.lit("last")}).select(events.columns)
    known = F.col("timestamp") < F.unix_timestamp(F.lit(FIRST_LOAD).cast("timestamp"))
    source, found, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "gaps", "offsets"))
    for delivery in (events.filter(known), events.filter(~known), closing):
        message_sink.publish_files(event_table.as_messages(delivery).orderBy(F.xxhash64("value")), source)
        rows = streaming_gaps.with_gap(ingest.parse(streams.file_messages(spark, source)))
        ingest.run_for(ingest.land(rows, found, checkpoint, partition_by=(), available_now=True))
    return _plain(spark.read.parquet(found))


def stream_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams over one topic from its beginning, from given offsets and from its end, each run before and after the later days arrive."""
    topic = scratch.new_path(spark, "topic")
    messages = event_table.messages(spark, sf_dir)
    first_load = F.lit(FIRST_LOAD).cast("timestamp")
    starts = {"earliest": "earliest", "offsets": {0: 100, 2: 250}, "latest": "latest"}
    places = {name: (scratch.new_path(spark, "raw"), scratch.new_path(spark, "offsets")) for name in starts}
    # Each part of the topic is one delivery with the offsets that follow the last one's.
    for known in (True, False):
        early = F.col("timestamp") < first_load
        segments.publish(messages.filter(early if known else ~early), topic, span=200)
        for name, (raw, checkpoint) in places.items():
            stream = segments.messages(spark, topic, starts[name], checkpoint, span=200)
            ingest.run_for(ingest.land(ingest.to_raw(stream), raw, checkpoint, available_now=True))
    found = [files.read_raw(spark, raw).withColumn("start", F.lit(name)) for name, (raw, _) in places.items()]
    rows = found[0].unionByName(found[1]).unionByName(found[2])
    return rows.select("start", "event_id", "kafka_partition", "kafka_offset")


def _moving_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events, and every seventh again, sent later, with another campaign and a day on."""
    events = event_table.ad_events(spark, sf_dir)
    day = F.lit(86_400)
    moved = events.filter(F.pmod(event_table.number(events), F.lit(7)) == 0).withColumns(
        {
            "campaign": F.col("campaign") + 1000,
            "timestamp": F.col("timestamp") + day,
            "conversion_timestamp": F.col("conversion_timestamp") + day,
        }
    )
    return event_table.as_messages(events), event_table.as_messages(moved, F.col("timestamp") + day)


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary kept by batches in which events move to other groups, one batch twice."""
    return _streamed_gold(spark, sf_dir, (0, 1, 0))


def stream_gold_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the newer versions first."""
    return _streamed_gold(spark, sf_dir, (1, 0))


def _streamed_gold(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> DataFrame:
    source, checkpoint, warehouse = (scratch.new_path(spark, x) for x in ("topic", "offsets", "warehouse"))
    processed, summary = tables.versioned_events(warehouse), tables.campaign_summary(warehouse)
    messages = _moving_messages(spark, sf_dir)
    for number in order:
        message_sink.publish_files(messages[number], source)
        stream = streams.file_messages(spark, source)
        ingest.run_for(
            streaming_gold.maintain(stream, processed, summary, checkpoint, available_now=True, within_days=1)
        )
    return _plain(summary.read(spark))


def merge_hashed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in no order, of which every hundredth comes again with a higher cost."""
    rows = _processed(spark, sf_dir).withColumn("event_id", F.md5("event_id"))
    table = tables.processed_events(scratch.new_path(spark, "warehouse"))
    table.ensure(spark)
    table.overwrite_partitions(rows)
    again = F.conv(F.substring("event_id", 1, 4), 16, 10).cast("int") % 100 == 0
    table.upsert(rows.filter(again).withColumn("cost", F.col("cost") + 1))
    return _plain(table.read(spark))


def period_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of eleven days from sketches kept by day, beside the exact figures: how far off they may be is known."""
    events = event_table.ad_events(spark, sf_dir)
    path = scratch.new_path(spark, "sketches")
    sketches.by_day(events).write.parquet(path)
    kept = sketches.over(spark.read.parquet(path), *BACKFILL)
    day = F.to_date(F.timestamp_seconds("timestamp"))
    exact = events.filter(day.between(*map(F.lit, BACKFILL))).agg(
        F.count_distinct("uid").alias("exact_users"), F.count_distinct("campaign").alias("exact_campaigns")
    )
    both = kept.crossJoin(exact)  # one row each
    def near(name: str):
        return F.abs(F.col(name) - F.col(f"exact_{name}")) <= sketches.ERROR * F.col(f"exact_{name}") + 0.5
    return both.select(
        "events", "clicks", "conversions",
        near("users").alias("users_near"), near("campaigns").alias("campaigns_near"),
    )


def bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three layers as files: stream to raw, merge to processed, merge to summary."""
    source, raw, checkpoint = (scratch.new_path(spark, x) for x in ("topic", "raw", "offsets"))
    warehouse = scratch.new_path(spark, "warehouse")
    processed, summary = tables.processed_events(warehouse), tables.campaign_summary(warehouse)
    message_sink.publish_files(event_table.messages(spark, sf_dir), source)
    _land(spark, source, raw, checkpoint)
    silver.run(files.read_raw(spark, raw), processed, as_of=AS_OF, assume_ingested_later=True)
    gold.run(processed.read(spark), summary, as_of=AS_OF)
    return _plain(summary.read(spark))


ALL: dict[str, Query] = {
    query.__name__: query
    for query in (
        ad_events_adapter,
        raw_projection,
        raw_scan,
        csv_roundtrip,
        silver_transform,
        silver_dedup_latest,
        silver_dedup_any,
        silver_recent_prefiltered,
        recent_window,
        campaign_summary,
        campaign_summary_all_days,
        merge_processed,
        merge_far_dates,
        merge_processed_plan,
        merge_summary,
        full_refresh_dynamic,
        append_batch,
        backfill_range,
        dataset_stats,
        stats_for_display,
        scan_stats,
        fanout_all,
        fanout_impressions,
        fanout_clicks,
        fanout_conversions,
        fanout_union,
        conversions_with_timestamp,
        fanout_summary,
        topic_counters,
        feed_messages,
        relink_events,
        message_encode_decode,
        dead_letters,
        tsv_prepare,
        sample_exact,
        sample_of_copies,
        row_index,
        numbered_events,
        time_order,
        head_slice,
        tail_slice,
        max_events,
        max_events_as_given,
        interevent_gap,
        health_freshness,
        health_rows_per_day,
        health_rows_from_footers,
        health_duplicates,
        health_files,
        compacted,
        compacted_summary,
        compacted_raw,
        stream_ingest,
        stream_resume,
        stream_upsert,
        stream_upsert_out_of_order,
        stream_deduplicated,
        stream_replayed,
        stream_counters,
        stream_relink,
        stream_gaps,
        stream_from_offsets,
        stream_gold,
        stream_gold_out_of_order,
        merge_hashed_keys,
        period_sketches,
        bronze_to_gold,
    )
}
