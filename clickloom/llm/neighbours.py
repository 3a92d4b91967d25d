"""Each document beside the next by descending doc_id, without sorting everything in one place."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clickloom.llm.arrow import importable, map_rows
from clickloom.sinks import scratch

#: Ranges for each shuffle partition, and sampled keys for each range, which only balance them.
RANGES = 4
SAMPLED = 32

_LOWEST = -(1 << 63)


def _keys(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
    )


def with_next(
    docs: DataFrame,
    function: Callable[[dict, str | None], dict],
    schema: str,
) -> tuple[DataFrame, int]:
    """``function(row, text of the next row)`` over ``docs`` by descending doc_id; and the number of rows.

    ``row`` has doc_id, text (null as empty), range, pos and guest. The row after the last is the first. Null ids come last;
    rows with the same id are ordered by a hash of their text, so that only equal rows may swap. The id order is cut
    into ranges; each also gets the first row of the following one, as a guest, which ends its range: function gets it with
    None for the next text. Texts travel compressed, once; a task holds two of them at a time.
    """
    spark = docs.sparkSession
    importable(spark)
    keys = scratch.written(_keys(docs), "keys")
    rows = keys.count()
    ranges = max(1, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, SAMPLED * ranges / max(1, rows))
    drawn = sorted((row["id"], row["key"]) for row in keys.sample(share, seed=5).collect())
    bounds = sorted({drawn[len(drawn) * n // ranges] for n in range(1, ranges)}) if drawn else []

    placed = map_rows(
        keys,
        lambda slice_: [r | {"range": bisect_left(bounds, (r["id"], r["key"]))} for r in slice_],
        "id bigint, key bigint, range int",
    )
    # One row for each range at most. The next of a range's last row is the highest row of the range below.
    tops = {
        row["range"]: (row["top"]["id"], row["top"]["key"])
        for row in placed.groupBy("range").agg(F.max(F.struct("id", "key")).alias("top")).collect()
    }
    order = sorted(tops)
    guest_of: dict[tuple[int, int], list[int]] = {}
    for number, at in enumerate(order):
        guest_of.setdefault(tops[order[number - 1]], []).append(at)

    kind = docs.schema["doc_id"].dataType.simpleString()

    def dealt(slice_: list[dict]) -> list[dict]:
        made, press = [], zstandard.ZstdCompressor(level=3)
        for row in slice_:
            place = row["id"], row["key"]
            row["packed"] = press.compress(row.pop("text").encode())
            made.append(row | {"range": bisect_left(bounds, place), "guest": False})
            made += [row | {"range": at, "guest": True} for at in guest_of.get(place, ())]
        return made

    source = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
    )
    shuffled = (
        map_rows(
            source,
            dealt,
            f"doc_id {kind}, id bigint, key bigint, packed binary, range int, guest boolean",
        )
        .repartition("range")
        .sortWithinPartitions("range", "guest", F.desc("id"), F.desc("key"))
    )
    wanted = StructType.fromDDL(schema)
    target = to_arrow_schema(wanted)

    def walk(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        held: dict | None = None
        open_ = zstandard.ZstdDecompressor()
        pos = 0
        for batch in source:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if held and held["range"] == row["range"] and held["guest"]:
                        continue  # more equal rows that are guests
                    row["text"] = open_.decompress(row.pop("packed")).decode()
                    pos = pos + 1 if held and held["range"] == row["range"] else 0
                    row["pos"] = pos
                    if held and held["range"] == row["range"]:
                        made.append(function(held, row["text"]))
                    if row["guest"]:
                        made.append(function(row, None))
                    held = row
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=target)
                    made = []

    return shuffled.mapInArrow(walk, wanted), rows
