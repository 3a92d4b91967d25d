"""The daily campaign summary, kept up to date by a stream of messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clickloom.operators import merge
from clickloom.operators.summary import campaign_days
from clickloom.plans import silver
from clickloom.sinks import files, scratch
from clickloom.streaming.ingest import parse, triggered

GROUP = ("event_date", "campaign")


def touched(held: DataFrame, rows: DataFrame) -> DataFrame:
    """The groups that the old places of rows and their new ones are in."""
    return held.select(*GROUP).unionByName(rows.select(*GROUP)).distinct()


def sum_again(processed, summary, groups: DataFrame, run_at: datetime | None = None) -> None:
    """Bring the summary of ``groups`` up to date with the processed table.

    Only the partitions and rows of these groups are read. A group that has no
    rows left goes. Running it twice changes nothing more.
    """
    spark = groups.sparkSession
    rows = processed.within(processed.read(spark), groups.select("event_date").distinct())
    sums = campaign_days(merge.semi_join(rows, groups, GROUP))
    updated_at = F.current_timestamp() if run_at is None else F.lit(run_at)
    summary.upsert(
        sums.withColumn("updated_at", updated_at),
        unique=True,
        keys_move=False,
        replaces=groups.withColumnRenamed("event_date", "summary_date"),
    )


def maintain(
    messages: DataFrame,
    processed,
    summary,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    within_days: int | None = None,
    run_at: datetime | None = None,
) -> StreamingQuery:
    """Merge each batch into the processed table and sum again the groups it touches.

    With a table of ``versioned_events`` both tables end the same in whatever
    order messages arrive. Where an event moves, the group it leaves is
    known only before the merge, so the touched groups are written first, under
    the checkpoint and by batch: a batch repeated after a failure finds them there
    although the merge has been done. ``within_days`` as for ``upsert``.
    """
    spark = messages.sparkSession
    versioned = "version" in processed.schema.names

    def keep_up(batch: DataFrame, batch_id: int) -> None:
        journal = f"{checkpoint}/touched-groups/batch={batch_id}"
        rows = silver.with_id(silver.transform(parse(batch), versioned=versioned))
        with scratch.staged(rows.filter(F.col("event_date").isNotNull()), "batch") as rows:
            if not files.exists(spark, f"{journal}/_SUCCESS"):
                groups = touched(processed.holding(rows, within_days), rows)
                groups.write.mode("overwrite").parquet(journal)
            groups = spark.read.schema(rows.select(*GROUP).schema).parquet(journal)
            processed.upsert(
                rows,
                unique=True,
                when_newer="version" if versioned else None,
                within_days=within_days,
                leaving=groups,
                written=True,
            )
            sum_again(processed, summary, groups, run_at)
        files.delete(spark, journal)

    processed.ensure(spark)
    summary.ensure(spark)
    writer = messages.writeStream.foreachBatch(keep_up).option("checkpointLocation", checkpoint)
    return triggered(writer, available_now, interval).start()
