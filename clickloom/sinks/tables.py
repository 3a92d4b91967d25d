"""Mutable tables: parquet folders with one partition column, or catalog tables.

Both kinds offer the same operations, so the plans do not care which they get.
A folder has one writer at a time. Every write to it is Spark's dynamic
partition overwrite: new files go to a staging folder and replace the old
partitions only when the job commits, so a plan may read the table it updates
and losing an executor never leaves half a partition. A driver that dies during
the commit leaves whole old or whole new partitions; running the same job again
gives the wanted table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from clickloom import schemas
from clickloom.operators import merge
from clickloom.sinks import files, scratch

# Partition values that come to the driver, to prune scans by literals; more are
# joined. They come as text, since a payload's date may lie outside what Python's
# dates hold.
MOST_PARTITIONS = 50_000

# Keys of a merge source that become literals, which the scan looks up in the key
# filters of the row groups. Beyond them the source touches most row groups anyway, and
# only the range of its keys is pushed.
MOST_KEYS = 10_000
# Spark pushes a list as a chain of comparisons, which the reader walks recursively: longer
# ones are several lists.
_LIST = 256
_PUSHED_KEYS = "spark.sql.parquet.pushdown.inFilterThreshold"

# Spark lists up to 10,000 folders by a task each; a few tasks for a core do it as evenly, without
# the time that starting so many takes.
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTERS = 4
# Text that SQL takes between quotes as it is.
_PLAIN = re.compile(r"[\w +.:-]*", re.ASCII)


@dataclass(frozen=True)
class PathTable:
    path: str
    schema: StructType
    partition: str
    keys: tuple[str, ...]

    def ensure(self, spark: SparkSession) -> None:
        """Create the folder if it is not there; an existing table is left alone."""
        empty = spark.createDataFrame([], self.schema)
        empty.write.mode("ignore").partitionBy(self.partition).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as it is now: its folders are listed by this call."""
        before = int(spark.conf.get(_LISTING))
        spark.conf.set(_LISTING, min(before, _LISTERS * spark.sparkContext.defaultParallelism))
        try:
            return spark.read.schema(self.schema).parquet(self.path).select(self.schema.names)
        finally:
            spark.conf.set(_LISTING, before)

    def append(self, df: DataFrame) -> None:
        """Blind append: running it twice doubles the rows, unlike ``upsert``."""
        self._writer(df, "append").parquet(self.path)

    def overwrite_partitions(self, df: DataFrame, truncate: bool = False) -> None:
        """Replace the partitions ``df`` has rows for; with ``truncate`` the whole table.

        Truncating must not read the table it replaces: Spark deletes it first.
        """
        overwrite = "static" if truncate else "dynamic"
        self._writer(df, "overwrite").option("partitionOverwriteMode", overwrite).parquet(self.path)

    def upsert(
        self,
        source: DataFrame,
        *,
        unique: bool = False,
        keys_move: bool = True,
        when_newer: str | None = None,
        delete_unmatched: Column | None = None,
        within_days: int | None = None,
        replaces: DataFrame | None = None,
        leaving: DataFrame | None = None,
        written: bool = False,
    ) -> None:
        """Update the rows whose keys ``source`` has, insert the rest.

        Only touched partitions are read in full and written again. With
        ``keys_move`` (a key may sit in another partition than its new row)
        these are found by a join on the key columns alone, within the source's
        key range; without it they are the source's own partitions. ``unique``
        skips the duplicate-key check for a source known to have none.
        ``within_days`` promises that a date partition never changes by more for
        a key; only partitions so near to the source's own are then looked at.
        ``delete_unmatched`` drops target rows it holds for that the source does
        not have, ``replaces`` those whose key it holds. ``leaving`` spares the
        look for moved keys where the partitions their rows lie in are known (more do no harm),
        and ``written`` the staging of a source that is a scan of files nobody changes.
        """
        spark, source = source.sparkSession, source.select(self.schema.names)
        with nullcontext(source) if written else scratch.staged(source, "upsert-source") as rows:
            if not unique:
                merge.require_unique(rows, self.keys)
            target = self.read(spark)
            arriving, sources = self.values(rows), []
            if leaving is not None:
                sources.append(leaving.select(self.partition))
            elif keys_move and self.partition not in self.keys:
                sources.append(self._holding(target, rows, within_days))
            if delete_unmatched is not None:
                sources.append(target.filter(delete_unmatched))
            if replaces is not None:
                sources.append(replaces.select(self.partition))

            def merged(touched: DataFrame) -> DataFrame:
                return merge.merge_upsert(
                    touched,
                    rows,
                    self.keys,
                    when_newer=when_newer,
                    delete_unmatched=delete_unmatched,
                    replaces=replaces,
                )

            left = [self.values(df) for df in sources]
            if arriving is None or None in left:
                self._overwrite_many(target, rows, sources, merged)
                return
            left_from: set[str | None] = set().union(*left)
            result = merged(target.filter(self.among(arriving | left_from)))
            # A partition all of whose rows left gets no new files, so the
            # dynamic overwrite would keep its old ones.
            emptied = left_from - arriving
            if emptied:
                emptied -= self.values(result.filter(self.among(emptied)))
            self.overwrite_partitions(result)
            for value in emptied:
                files.delete(spark, f"{self.path}/{self._folder(value)}")

    def _overwrite_many(
        self,
        target: DataFrame,
        rows: DataFrame,
        sources: list[DataFrame],
        merged: Callable[[DataFrame], DataFrame],
    ) -> None:
        """The end of ``upsert`` with partition values kept in tables, however many they are.

        Only touched partitions are read, as in ``joined``, and written again.
        """
        spark, column = rows.sparkSession, [self.partition]
        none = target.select(column).limit(0)
        leaving = reduce(DataFrame.unionByName, [df.select(column) for df in sources], none)
        with (
            scratch.staged(rows.select(column).distinct(), "arriving") as arriving,
            scratch.staged(leaving.distinct(), "leaving") as leaving,
        ):
            result = merged(self.joined(target, arriving.unionByName(leaving)))
            emptied = merge.anti_join(leaving, arriving, column)
            emptied = merge.anti_join(emptied, merge.semi_join(result, emptied, column), column)
            text = F.col(self.partition).cast("string").alias("value")
            with scratch.staged(emptied.select(text), "emptied") as emptied:
                self.overwrite_partitions(result)
                for row in emptied.toLocalIterator():
                    files.delete(spark, f"{self.path}/{self._folder(row.value)}")

    def _writer(self, df: DataFrame, mode: str):
        # Rebalancing gives each partition files of the advisory size, splits a
        # hot partition over many tasks and puts small ones together.
        # Within a file rows are sorted by key, so that row groups hold narrow key
        # ranges and a later merge can skip them.
        rows = df.select(self.schema.names).hint("rebalance", self.partition)
        rows = rows.sortWithinPartitions(self.partition, *self.keys)
        writer = rows.write.mode(mode).partitionBy(self.partition)
        if self._filtered():
            # Bloom filters of the size the keys of a row group need.
            writer = writer.options(
                **{
                    f"parquet.bloom.filter.enabled#{self.keys[0]}": "true",
                    "parquet.bloom.filter.adaptive.enabled": "true",
                }
            )
        return writer

    def _filtered(self) -> bool:
        return self.keys[0] != self.partition and isinstance(self.schema[self.keys[0]].dataType, StringType)

    def holding(self, rows: DataFrame, within_days: int | None = None) -> DataFrame:
        """The table's rows with keys of ``rows``, which is read repeatedly.

        The scan skips the row groups that cannot hold a match, by the range of the
        keys (ids that grow with time) and, for up to MOST_KEYS, by the keys themselves
        in the row groups' filters (ids in no order).
        """
        return self._holding(self.read(rows.sparkSession), rows, within_days)

    def _holding(self, target: DataFrame, rows: DataFrame, within_days: int | None) -> DataFrame:
        in_range, keys = self._in_range(rows)
        # The estimate is a few percent off; only what may be few enough is gathered to be counted.
        near = target.filter(in_range & self._listed(rows) if keys <= 2 * MOST_KEYS else in_range)
        if within_days is not None:
            near = self.within(near, self._near(rows, within_days))
        return merge.matched(near, rows, self.keys)

    def _listed(self, rows: DataFrame) -> Column:
        """Rows of the table that have one of the keys of ``rows``, if these are few enough for literals."""
        spark, key = rows.sparkSession, self.keys[0]
        if not self._filtered():
            return F.lit(True)
        known = [row[0] for row in rows.select(key).distinct().limit(MOST_KEYS + 1).collect()]
        if len(known) > MOST_KEYS:
            return F.lit(True)
        # Lists above this are pushed as their range only.
        if int(spark.conf.get(_PUSHED_KEYS)) < _LIST:
            spark.conf.set(_PUSHED_KEYS, _LIST)
        there = sorted(value for value in known if value is not None)
        tests = [F.col(key).isin(there[i : i + _LIST]) for i in range(0, len(there), _LIST)]
        if len(there) < len(known):
            tests.append(F.col(key).isNull())
        # Joined in pairs, so that the condition is no deeper than it must be.
        while len(tests) > 1:
            pairs = [a | b for a, b in zip(tests[::2], tests[1::2], strict=False)]
            tests = pairs + tests[len(pairs) * 2 :]
        return tests[0] if tests else F.lit(False)

    def _arriving(self, rows: DataFrame) -> tuple[set[str | None] | None, Column]:
        """The source's partitions, and where its keys lie in the target."""
        return self.values(rows), self._in_range(rows)[0]

    def _in_range(self, rows: DataFrame) -> tuple[Column, int]:
        """Where the keys of ``rows`` lie in the target, and about how many there are.

        The range is made of literals, so for ids that grow with time the scan
        skips the row groups that cannot hold a match.
        """
        key = self.keys[0]
        kind = self.schema[key].dataType
        # As text, for the same reason as the partitions.
        low, high, nulls, keys = rows.agg(
            F.min(key).cast("string"),
            F.max(key).cast("string"),
            F.count(F.when(F.col(key).isNull(), True)),
            F.approx_count_distinct(key),
        ).first()
        in_range = F.lit(False)
        if low is not None:
            in_range = F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        if nulls:
            in_range = in_range | F.col(key).isNull()
        return in_range, keys

    def _near(self, rows: DataFrame, days: int) -> DataFrame:
        """The dates of ``rows`` and those up to ``days`` before and after."""
        day = F.col(self.partition)
        around = F.sequence(F.date_sub(day, days), F.date_add(day, days))
        near = F.when(day.isNull(), F.array(day)).otherwise(around)
        dates = rows.select(self.partition).distinct()
        return dates.select(F.explode(near).alias(self.partition)).distinct()

    def within(self, df: DataFrame, partitions: DataFrame) -> DataFrame:
        """Rows of ``df`` in one of ``partitions``: by literals, or by a join where they are many."""
        values = self.values(partitions)
        if values is None:
            return self.joined(df, partitions)
        return df.filter(self.among(values))

    def joined(self, df: DataFrame, partitions: DataFrame) -> DataFrame:
        """Rows of ``df`` in one of ``partitions``, which is read repeatedly, however many they are.

        The partitions between the least and the greatest are left by literals. Of these
        Spark leaves out at run time what is not in ``partitions``, if its size allows a broadcast.
        """
        column, kind = F.col(self.partition), self.schema[self.partition].dataType
        low, high, nulls = partitions.agg(
            F.min(column).cast("string"), F.max(column).cast("string"), F.count_if(column.isNull())
        ).first()
        without = df.filter(column.isNull() if nulls else F.lit(False))
        if low is None:
            return without
        between = column.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        # An equality, as null-safe ones do not prune; and a filter, as only filtered tables do.
        known = partitions.select(column.cast(kind).alias(self.partition)).filter(between)
        return df.filter(between).join(known, self.partition, "left_semi").unionByName(without)

    def values(self, df: DataFrame) -> set[str | None] | None:
        """Partition values present, as text: one row for each. None if over MOST_PARTITIONS."""
        text = F.col(self.partition).cast("string").alias("value")
        found = df.select(text).distinct().limit(MOST_PARTITIONS + 1).collect()
        if len(found) > MOST_PARTITIONS:
            return None
        return {row.value for row in found}

    def among(self, values: set[str | None]) -> Column:
        """Rows of the given partitions, as literals that prune the scan."""
        column, kind = F.col(self.partition), self.schema[self.partition].dataType
        known = sorted(v for v in values if v is not None)
        plain = [v for v in known if _PLAIN.fullmatch(v)]
        tests = []
        if plain:
            # As one text: a Python call for each value would take longer than the scan. Of the table's own
            # type, not the column as text, so that Spark prunes by them as it does by any list.
            name, to = f"`{self.partition}`", kind.simpleString()
            tests.append(F.expr(f"{name} IN ({', '.join(f"CAST('{v}' AS {to})" for v in plain)})"))
        if len(plain) < len(known):
            tests.append(column.isin(*(F.lit(v).cast(kind) for v in known if not _PLAIN.fullmatch(v))))
        if None in values:
            tests.append(column.isNull())
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    def _folder(self, value: str | None) -> str:
        return f"{self.partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


@dataclass(frozen=True)
class CatalogTable:
    """A table in a catalog with row-level operations, such as Iceberg."""

    name: str
    schema: StructType
    partition: str
    keys: tuple[str, ...]
    provider: str = "iceberg"
    properties: dict[str, str] = field(default_factory=dict)

    def ensure(self, spark: SparkSession) -> None:
        namespace, _, _ = self.name.rpartition(".")
        if namespace:
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        properties = ", ".join(f"'{key}' = '{value}'" for key, value in self.properties.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.schema.toDDL()}) "
            f"USING {self.provider} PARTITIONED BY ({self.partition})"
            + (f" TBLPROPERTIES ({properties})" if properties else "")
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).select(self.schema.names)

    def append(self, df: DataFrame) -> None:
        df.select(self.schema.names).writeTo(self.name).append()

    def overwrite_partitions(self, df: DataFrame, truncate: bool = False) -> None:
        writer = df.select(self.schema.names).writeTo(self.name)
        if truncate:
            writer.overwrite(F.lit(True))
        else:
            writer.overwritePartitions()

    def upsert(
        self,
        source: DataFrame,
        *,
        unique: bool = False,
        keys_move: bool = True,
        when_newer: str | None = None,
        delete_unmatched: Column | None = None,
        within_days: int | None = None,
        replaces: DataFrame | None = None,
        leaving: DataFrame | None = None,
        written: bool = False,
    ) -> None:
        """The catalog's own MERGE, which finds duplicate and moved keys itself."""
        if replaces is not None:
            # Keys the source does not have go first; the rest is an update.
            gone = merge.anti_join(replaces, source, self.keys).alias("s")
            gone.mergeInto(self.name, self._same()).whenMatched().delete().merge()
        rows = source.select(self.schema.names).alias("s")
        plan = rows.mergeInto(self.name, self._same())
        if when_newer:
            newer = F.col(f"s.{when_newer}") >= F.col(f"{self.name}.{when_newer}")
            plan = plan.whenMatched(newer).updateAll()
        else:
            plan = plan.whenMatched().updateAll()
        plan = plan.whenNotMatched().insertAll()
        if delete_unmatched is not None:
            plan = plan.whenNotMatchedBySource(delete_unmatched).delete()
        plan.merge()

    def holding(self, rows: DataFrame, within_days: int | None = None) -> DataFrame:
        """The table's rows with keys of ``rows``; what can be skipped is the format's business."""
        return merge.matched(self.read(rows.sparkSession), rows, self.keys)

    def within(self, df: DataFrame, partitions: DataFrame) -> DataFrame:
        """Rows of ``df`` in one of ``partitions``."""
        return merge.semi_join(df, partitions, [self.partition])

    def _same(self) -> Column:
        return reduce(
            lambda a, b: a & b,
            [F.col(f"{self.name}.{key}").eqNullSafe(F.col(f"s.{key}")) for key in self.keys],
        )


# Public Iceberg table properties.
COPY_ON_WRITE = {
    "format-version": "2",
    "write.update.mode": "copy-on-write",
    "write.merge.mode": "copy-on-write",
    "write.delete.mode": "copy-on-write",
}


def processed_events(base: str, name: str = "processed_events") -> PathTable:
    return PathTable(f"{base}/{name}", schemas.PROCESSED_EVENTS, "event_date", ("event_id",))


def versioned_events(base: str, name: str = "versioned_events") -> PathTable:
    """``processed_events`` that keep the position of the message each row comes from."""
    return PathTable(f"{base}/{name}", schemas.VERSIONED_EVENTS, "event_date", ("event_id",))


def campaign_summary(base: str, name: str = "campaign_summary") -> PathTable:
    return PathTable(
        f"{base}/{name}", schemas.CAMPAIGN_SUMMARY, "summary_date", ("summary_date", "campaign")
    )


def processed_events_in(catalog: str, database: str, name: str = "processed_events") -> CatalogTable:
    return CatalogTable(
        f"{catalog}.{database}.{name}",
        schemas.PROCESSED_EVENTS,
        "event_date",
        ("event_id",),
        properties={
            **COPY_ON_WRITE,
            "write.target-file-size-bytes": str(schemas.TARGET_FILE_BYTES),
        },
    )


def campaign_summary_in(catalog: str, database: str, name: str = "campaign_summary") -> CatalogTable:
    return CatalogTable(
        f"{catalog}.{database}.{name}",
        schemas.CAMPAIGN_SUMMARY,
        "summary_date",
        ("summary_date", "campaign"),
        properties=COPY_ON_WRITE,
    )
