"""Message streams to the raw zone and, from there or directly, to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clickloom import schemas
from clickloom.functions import events as E
from clickloom.plans import silver


def parse(messages: DataFrame) -> DataFrame:
    """Payload fields and message position, for batch and streaming alike.

    A payload that is not an event stays as a row of NULLs: nothing is lost
    between broker and raw zone. A single bad field only nulls itself.
    """
    return (
        messages.select(
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"),
            # Inlined rather than unpacked with data.*: a later filter on a field
            # would otherwise be pushed below and parse the payload once more.
            F.inline(F.array(F.from_json(F.col("value").cast("string"), schemas.EVENT))),
        )
        .withColumn("event_timestamp", E.epoch_to_timestamp(F.col("timestamp")))
    )


def to_raw(messages: DataFrame) -> DataFrame:
    """``parse`` with the time of arrival and the partitions derived from it."""
    return (
        parse(messages)
        .withColumn("ingest_ts", F.current_timestamp())
        .withColumns({"raw_date": F.to_date("ingest_ts"), "raw_hour": F.hour("ingest_ts")})
        .select(schemas.RAW.names)
    )


def dead_letters(messages: DataFrame) -> DataFrame:
    """Messages whose payload gives no field at all, with the payload itself."""
    payload = F.col("value").cast("string")
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.EVENT])
    # compared as a whole, which parses once; a test per field would parse for each
    read = F.coalesce(F.from_json(payload, schemas.EVENT), nothing)
    return messages.filter(read == nothing).select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        payload.alias("payload"),
    )


def with_ingest_time(stream: DataFrame) -> DataFrame:
    return stream.withColumn("ingest_ts", F.current_timestamp())


def once(messages: DataFrame, within: str = "1 day", by: str = "content") -> DataFrame:
    """Messages without the copies that a redelivery brings, to be landed.

    ``content`` takes messages with the same key and value for one, whatever their
    position; ``position`` those with the same topic, partition and offset. Of copies
    the first to arrive stays. What has been seen is state, kept for ``within`` after it
    arrived, over restarts, and then forgotten: a copy that comes later lands again, and
    silver keeps one version. The clock is that of arrival, so no message is ever behind the
    watermark and none is lost, however old the event in it.
    """
    if by == "content":
        text = F.struct(F.col("key").cast("string"), F.col("value").cast("string"))
        same = {"_same": F.sha2(F.to_json(text), 256)}
    elif by == "position":
        same = {f"_{name}": F.col(name) for name in ("topic", "partition", "offset")}
    else:
        raise ValueError(f"by must be content or position, not {by!r}")
    seen = messages.withColumns({**same, "_arrived": F.current_timestamp()})
    fresh = seen.withWatermark("_arrived", within).dropDuplicatesWithinWatermark([*same])
    return fresh.drop(*same, "_arrived")


def land(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = schemas.RAW_PARTITIONS,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Append a stream to files exactly once; the checkpoint lets a restart go on.

    A new checkpoint path replays the source from its starting position.
    ``available_now`` takes what is there and stops; ``interval`` spaces the
    batches, which means fewer and larger files.
    """
    if fmt not in ("parquet", "json"):
        raise ValueError(f"raw format must be parquet or json, not {fmt!r}")
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer, available_now, interval).start()


def upsert_stream(
    messages: DataFrame,
    table,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    within_days: int | None = None,
) -> StreamingQuery:
    """Merge each batch of messages into the processed table.

    A batch repeated after a failure changes nothing, because the merge is by
    key. With a table of ``versioned_events`` the newest message wins in
    whatever order they arrive; without versions the one that arrives last.
    ``within_days`` as for ``upsert``: a batch then only looks at the
    partitions near its own, however large the table.
    """
    versioned = "version" in table.schema.names

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        rows = silver.with_id(silver.transform(parse(batch), versioned=versioned))
        table.upsert(
            rows.filter(F.col("event_date").isNotNull()),
            unique=True,
            when_newer="version" if versioned else None,
            within_days=within_days,
        )

    table.ensure(messages.sparkSession)
    writer = messages.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, available_now, interval).start()


def run_for(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for the query; with a limit, stop it then."""
    if seconds is None:
        query.awaitTermination()
        return
    query.awaitTermination(seconds)
    query.stop()


def triggered(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer
