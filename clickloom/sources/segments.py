"""Message folders addressed by offset, for streams that start at a given place.

Messages lie in ``partition=P/segment=S``, where S is the first offset of a span of
``SPAN`` offsets with leading zeros. A delivery that would need more than MOST_SEGMENTS
of them in a partition takes longer ones, ``segment=S-L`` of L offsets, so that
listings and commits, which the driver holds, do not grow with the messages. A start becomes a
pattern of folder names, so that what lies before it is not even listed; of the segments that hold the
start itself, rows before it are filtered.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.sinks import files

SPAN = 1_000_000
_DIGITS = 19

#: Segments of one delivery in a partition, and by how much the next longer ones are longer.
MOST_SEGMENTS = 512
_LONGER = 16
_LAST = 2**63 - 1

Start = str | dict[int, int]

_FILE = T.StructType(
    [f for f in schemas.MESSAGE if f.name != "partition"]
    + [schemas.MESSAGE["partition"], T.StructField("segment", T.StringType())]
)


def publish(messages: DataFrame, path: str, span: int = SPAN) -> None:
    """Append messages to the folders their positions name. Negative offsets are refused.

    ``span`` is the least length of a segment; how long this delivery's are is found by reading its positions first.
    """
    length = _length(messages, span)
    start = F.col("offset") - F.pmod(F.col("offset"), F.lit(length).cast("bigint"))
    name = F.concat(F.lpad(start.cast("string"), _DIGITS, "0"), F.lit("" if length == span else f"-{length}"))
    checked = F.when(F.col("offset") >= 0, name).otherwise(F.raise_error(F.lit("an offset below 0")))
    rows = messages.withColumn("segment", checked)
    rows.hint("rebalance", "partition", "segment").write.mode("append").partitionBy("partition", "segment").json(path)


def _lengths(span: int) -> list[int]:
    found = [span]
    while found[-1] * _LONGER <= _LAST:
        found.append(found[-1] * _LONGER)
    return found


def _length(messages: DataFrame, span: int) -> int:
    """The shortest length of which no partition needs more than about MOST_SEGMENTS segments."""
    lengths = _lengths(span)
    numbers = [F.floor(F.col("offset") / length) for length in lengths]
    counts = messages.groupBy("partition").agg(
        *(F.approx_count_distinct(number).alias(f"n{k}") for k, number in enumerate(numbers))
    )
    most = counts.agg(*(F.max(f"n{k}") for k in range(len(lengths)))).first()
    return next((x for x, n in zip(lengths, most, strict=True) if n is None or n <= MOST_SEGMENTS), lengths[-1])


def from_segment(start: int, span: int = SPAN) -> list[str]:
    """Patterns of the segments from the one that holds ``start`` on."""
    first = str(start // span * span).zfill(_DIGITS)
    patterns = [first]
    for at in range(_DIGITS - 1, -1, -1):
        digit = int(first[at])
        if digit < 9:
            larger = "9" if digit == 8 else f"[{digit + 1}-9]"
            patterns.append(first[:at] + larger + "?" * (_DIGITS - at - 1))
    return patterns


def ends(spark: SparkSession, path: str, span: int = SPAN) -> dict[int, int]:
    """One past the last offset of each partition; only its last segment of each length is read."""
    if not files.exists(spark, path):
        return {}
    found = {}
    for name in files.names(spark, path):
        if not name.startswith("partition=") or not name[10:].isdigit():
            continue
        # Segments of one length follow each other, so the last of each length are all that may hold the last offset.
        last = {}
        for segment in files.names(spark, f"{path}/{name}"):
            if segment.startswith("segment="):
                start, _, length = segment[8:].partition("-")
                last[length] = max(last.get(length, (-1, "")), (int(start), segment))
        if last:
            paths = [f"{path}/{name}/{segment}" for _, segment in last.values()]
            offset = spark.read.schema(_FILE).json(paths).agg(F.max("offset")).first()[0]
            found[int(name[10:])] = max(last.values())[0] if offset is None else offset + 1
    return found


def starting(spark: SparkSession, path: str, start: Start, checkpoint: str, span: int = SPAN) -> Start:
    """``start`` as it was when the checkpoint was new: ``latest`` then means the same place after a restart."""
    known = f"{checkpoint}/start/offsets.json"
    if files.exists(spark, known):
        text = "".join(row.value for row in spark.read.text(known).collect())
        saved = json.loads(text)
        return saved if isinstance(saved, str) else {int(p): offset for p, offset in saved.items()}
    if start == "latest":
        start = ends(spark, path, span)
    elif start != "earliest" and not isinstance(start, dict):
        raise ValueError(f"start must be earliest, latest or offsets by partition, not {start!r}")
    files.write_text(spark, known, json.dumps(start))
    return start


def messages(
    spark: SparkSession, path: str, start: Start = "earliest", checkpoint: str | None = None, span: int = SPAN
) -> DataFrame:
    """A stream of the messages at ``path`` from ``start`` on.

    ``earliest``, ``latest`` (what is there when the stream first starts is left out) or the first offset
    wanted of each partition; partitions that a map does not name start at their beginning, those
    that appear later too. ``latest`` needs the ``checkpoint`` the stream is going to have.
    """
    if checkpoint is not None:
        start = starting(spark, path, start, checkpoint, span)
    elif start == "latest":
        raise ValueError("latest needs the stream's checkpoint, which remembers what it meant")
    reader = spark.readStream.schema(_FILE).format("json").option("basePath", path)
    if start == "earliest" or not start:
        return reader.load(f"{path}/partition=*/segment=*").select(schemas.MESSAGE.names)
    folders = [f"partition={p}/segment={{{','.join(_wanted_names(max(0, at), span))}}}" for p, at in start.items()]
    others = _other_numbers(start)
    folders += [f"partition={p}/segment=*" for p in others]
    rows = reader.load(f"{path}/{{{','.join(folders)}}}")
    return rows.filter(_wanted(start)).select(schemas.MESSAGE.names)


def _wanted_names(start: int, span: int) -> list[str]:
    """``from_segment`` for segments of every length."""
    names = from_segment(start, span)
    for length in _lengths(span)[1:]:
        names += [f"{name}-{length}" for name in from_segment(start, length)]
    return names


def _other_numbers(start: dict[int, int]) -> list[str]:
    """Patterns of all partition numbers that ``start`` does not name."""
    longest = max(len(str(p)) for p in start)
    named = {str(p) for p in start}
    patterns = []
    for length in range(1, longest + 1):
        prefixes = [""]
        for at in range(length):
            grown = []
            for prefix in prefixes:
                free = []
                for digit in "0123456789"[(at == 0 and length > 1) :]:
                    begun = prefix + digit
                    if any(len(n) == length and n.startswith(begun) for n in named):
                        if at < length - 1:
                            grown.append(begun)
                    else:
                        free.append(digit)
                if free:
                    patterns.append(f"{prefix}[{''.join(free)}]{'[0-9]' * (length - at - 1)}")
            prefixes = grown
    patterns.append("[0-9]" * (longest + 1) + "*")
    return patterns


def _wanted(start: dict[int, int]) -> Column:
    offsets = F.create_map(*(F.lit(x) for pair in start.items() for x in pair))
    return F.col("offset") >= F.coalesce(F.try_element_at(offsets, F.col("partition")), F.lit(0))
