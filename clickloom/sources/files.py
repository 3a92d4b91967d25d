"""Batch readers. Each declares its schema, so no job is spent on inferring one."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import events as E


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The raw zone. Declaring the schema keeps JSON's times, ints and all-NULL columns."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"raw format must be parquet or json, not {fmt!r}")
    return spark.read.format(fmt).schema(schemas.RAW).load(path).select(schemas.RAW.names)


def headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """The different first lines of the text files under ``path``, each with its files.

    Blank lines before it do not count; a file without any line has no header.
    Only the files' first blocks are read. One row for each file reaches the
    driver, as in Spark's own listing.
    """
    lines = spark.read.text(path).select(
        F.rtrim("value", F.lit("\r\n")).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = (
        lines.filter((F.col("block") == 0) & (F.trim("line") != ""))
        .groupBy("file")
        .agg(F.min_by("line", "place").alias("header"))
    )
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        found.setdefault(row.header.removeprefix("\ufeff"), []).append(row.file)
    return list(found.items())


def _position() -> dict[str, Column]:
    """File, block and place in it: the order of the rows as given."""
    return {
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_scan": F.monotonically_increasing_id(),
    }


# Where a row stands in its files, in the order to sort by.
FILE_ORDER = ("_file", "_block", "_scan")


def read_events_csv(
    spark: SparkSession,
    path: str,
    categories: bool = False,
    position: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Combined events with a header, every field still a string (blank reads as NULL).

    Columns are found by name in each file's own header; one a file lacks is
    NULL, others are left out. Quotes within a quoted field are doubled. A
    quoted field may hold line breaks only with ``multi_line``, which reads a file
    in one task. ``position`` adds the columns of FILE_ORDER.
    """
    columns = schemas.AD_EVENT_COLUMNS + (schemas.CATEGORY_COLUMNS if categories else ())
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    parts = []
    for header, names in headers(spark, path) or [(",".join(columns), [])]:
        fields = next(csv.reader([header]))
        numbered = schemas.strings(f"_field{n}" for n in range(len(fields)))
        rows = reader.schema(numbered).csv(names) if names else spark.createDataFrame([], numbered)
        place = {name: f"_field{n}" for n, name in reversed(list(enumerate(fields)))}
        chosen = [
            (F.col(place[name]) if name in place else F.lit(None).cast("string")).alias(name)
            for name in columns
        ]
        if position and names:
            chosen += [column.alias(name) for name, column in _position().items()]
        elif position:
            nowhere = {"_file": F.lit(""), "_block": F.lit(0), "_scan": F.lit(0)}
            chosen += [column.alias(name) for name, column in nowhere.items()]
        parts.append(rows.select(*chosen))
    return reduce(DataFrame.unionByName, parts)


def typed_events(df: DataFrame, campaign_text: bool = False) -> DataFrame:
    """Coerce the seven event columns of string rows leniently; others pass through.

    With ``campaign_text`` the campaign stays as it is written, be it a number or not.
    """
    number = E.safe_int(F.col("campaign"), None).try_cast("int")
    return df.withColumns(
        {
            "timestamp": E.safe_int(F.col("timestamp")),
            "uid": F.coalesce("uid", F.lit("")),
            "campaign": F.col("campaign") if campaign_text else number,
            "click": E.safe_int(F.col("click")).try_cast("int"),
            "conversion": E.safe_int(F.col("conversion")).try_cast("int"),
            "conversion_timestamp": E.safe_int(F.col("conversion_timestamp"), None),
            "cost": E.safe_float(F.col("cost")),
        }
    )


def read_tsv(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A headered TSV or TSV.GZ as string columns, plus the whole line as ``_line``.

    Short rows are padded with "", long ones cut to the header's width, blank
    lines skipped. The first line of each file is its header; a later line like
    it is data. Files may differ in their headers: columns are matched by name,
    in the order of the first file, and those a file lacks are "". One gzip file
    arrives in one task; ``partitions`` spreads its lines right after it is read.
    """
    found = headers(spark, path)
    if not found:
        raise ValueError(f"empty input: {path}")
    columns = dict.fromkeys(name for header, _ in found for name in header.split("\t"))
    # One column under a header, with a separator and quotes that occur nowhere:
    # plain lines, of which Spark leaves out the first of every file.
    reader = (
        spark.read.option("header", True)
        .option("sep", "\u0001\u0002\u0001")
        .option("quote", "\u0000")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .schema("_line STRING")
    )
    parts = []
    for header, names in found:
        lines = reader.csv(names)
        if partitions:
            lines = lines.repartition(partitions)
        body = lines.select(F.rtrim("_line", F.lit("\r\n")).alias("_line")).filter(
            F.length("_line") > 0
        )
        fields = F.split("_line", "\t", -1)
        place = {name: n for n, name in reversed(list(enumerate(header.split("\t"))))}
        parts.append(
            body.select(
                *[
                    F.coalesce(F.get(fields, F.lit(place[name])), F.lit("")).alias(name)
                    if name in place
                    else F.lit("").alias(name)
                    for name in columns
                ],
                "_line",
            )
        )
    return reduce(DataFrame.unionByName, parts)
