"""Small files to files of the target size, each with a key range of its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import health, ranking
from clickloom.sinks import files, scratch
from clickloom.sources.files import read_raw


def candidates(layout: DataFrame, target_bytes: int = schemas.TARGET_FILE_BYTES) -> DataFrame:
    """Partitions with more files than their size needs, and how many it does need."""
    return _wanted(layout, target_bytes).filter(F.col("files") > F.col("wanted_files"))


def _wanted(layout: DataFrame, target_bytes: int) -> DataFrame:
    wanted = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")
    return layout.withColumn("wanted_files", F.greatest(wanted, F.lit(1)))


def run(spark: SparkSession, table, target_bytes: int = schemas.TARGET_FILE_BYTES) -> int:
    """Rewrite those partitions of a folder table and return how many there were.

    Partitions that are fine already are not read.
    """
    if files.exists(spark, f"{table.path}/_spark_metadata"):
        raise ValueError(f"{table.path} is a stream's folder, whose log names its files: use raw_copy")
    layout = health.file_layout(spark, table.path, table.partition)
    rewrite = scratch.written(candidates(layout, target_bytes), "layout")
    chosen = rewrite.count()
    if chosen:
        rows = table.within(table.read(spark), rewrite)
        packed = _packed(rows, rewrite, (table.partition,), table.keys)
        (
            packed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(table.partition)
            .parquet(table.path)
        )
    return chosen


def raw_copy(
    spark: SparkSession, path: str, output: str, target_bytes: int = schemas.TARGET_FILE_BYTES
) -> int:
    """The raw zone of ``path`` in files of the target size, as a new folder; its partitions' number.

    A copy, because the log a stream keeps beside its files names each of them: the old zone
    stays readable and may go on growing until readers have moved.
    """
    by = schemas.RAW_PARTITIONS
    layout = scratch.written(
        _wanted(health.file_layout(spark, path, *by), target_bytes), "layout"
    )
    rows = _packed(read_raw(spark, path), layout, by, ("event_id",))
    rows.write.partitionBy(*by).parquet(output)
    return layout.count()


def _packed(rows: DataFrame, layout: DataFrame, by: tuple[str, ...], keys: tuple[str, ...]) -> DataFrame:
    """``rows`` dealt to the wanted number of files of each partition, a task for each file.

    The rows are numbered by partition and key, and a file takes an equal run of
    numbers: its key range overlaps with no other's, and a hot key cannot
    unbalance them.
    """
    layout = layout.select(
        *(F.col(name).cast(rows.schema[name].dataType).alias(name) for name in by), "wanted_files"
    )
    names = rows.columns
    spread = rows.withColumn("_spread", F.xxhash64(*names))
    numbered = ranking.with_row_index(spread, [*by, *keys, "_spread"], "_at")
    ordered = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    def before(name: str):
        return F.coalesce(F.sum(name).over(ordered), F.lit(0))

    # One row for each partition.
    sizes = numbered.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    known = sizes.alias("s").join(layout.alias("l"), _same(by, "s", "l"))
    known = known.select(*(F.col(f"s.{name}") for name in by), "_rows", "wanted_files")
    known = known.withColumn("_start", before("_rows")).withColumn("_first", before("wanted_files"))
    known = scratch.written(known, "layout")
    total = known.agg(F.sum("wanted_files")).first()[0] or 1
    place = F.floor((F.col("_at") - F.col("_start")) * F.col("wanted_files") / F.col("_rows"))
    return (
        numbered.alias("t")
        .join(known.alias("k"), _same(by, "t", "k"))
        .withColumn("_file", (F.col("_first") + place).cast("int"))
        .select(*(F.col(f"t.{name}") for name in names), "_file")
        .repartitionById(int(total), "_file")
        .sortWithinPartitions(*by, *keys)
        .select(*names)
    )


def _same(by: tuple[str, ...], left: str, right: str):
    pairs = [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in by]
    return reduce(lambda a, b: a & b, pairs)
