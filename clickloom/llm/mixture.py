"""Packing in set proportions: deficit round-robin over one queue of tokens for each source.

Time runs in windows. In each, every queue's deficit grows by its share of the window, and the queue sends as many
whole tokens as its deficit holds; the fraction left is carried on. What the queues send, in their order, window after window,
is one stream of tokens, and the sequences are cut from it without a gap. So a window is never more than one token
for each queue away from the target proportions, and no window knows of tasks or files.

After k windows a queue has sent ``(k * WINDOW * parts + carried) // PARTS`` tokens, whatever came before in other queues.
This closed form replaces a loop over windows: the place of any token follows from its place in its queue
alone. Only when a queue runs dry the shares change; these few phases are worked out on the driver from one token count for
each queue. A queue's order is that of the tasks that made the tokens, so that neither texts nor ids are sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from clickloom.llm.arrow import importable
from clickloom.llm.packing import token_ids
from clickloom.sinks import scratch

CAPACITY = 1024
#: Tokens of a window: the shorter, the finer the mixture and the more cuts.
WINDOW = 32 * CAPACITY
#: Shares are whole numbers of this many parts, so that every figure is an exact 64-bit integer up to MOST tokens.
PARTS = 1 << 16
MOST = 1 << 46
#: Queues at most. Beyond them the sources with the fewest tokens share the last queue, one after another.
QUEUES = 256
#: Ids in one row of the stored tokens; longer documents take several rows.
IDS = 1 << 18


def tokens(docs: DataFrame, path: str, source: str = "source", end: int | None = 0) -> DataFrame:
    """part, source, doc_id, start, doc_tokens, ids (32-bit, little-endian) and ``before``.

    A document is its ids and then ``end``, if that is given; a null text is the empty text. ``before`` counts the tokens of the same source
    ahead of the row in its part, the task that made it. Other columns are not read.
    """
    kinds = {name: docs.schema[name].dataType.simpleString() for name in ("doc_id", source)}
    schema = StructType.fromDDL(
        f"part int, source {kinds[source]}, doc_id {kinds['doc_id']}, start bigint, doc_tokens bigint, "
        "length bigint, before bigint, ids binary"
    )
    target = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict = {}
        for batch in given:
            made, size = [], 0
            for row in batch.to_pylist():
                ids = token_ids(row["text"], path).astype("<u4")
                if end is not None:
                    ids = np.append(ids, np.array([end], "<u4"))
                for start in range(0, len(ids), IDS):
                    some = ids[start : start + IDS]
                    before = sent.get(row["source"], 0)
                    sent[row["source"]] = before + len(some)
                    made.append(
                        {
                            "part": row["part"],
                            "source": row["source"],
                            "doc_id": row["doc_id"],
                            "start": start,
                            "doc_tokens": len(ids),
                            "length": len(some),
                            "before": before,
                            "ids": some.tobytes(),
                        }
                    )
                    size += len(some)
                    if size >= 4 * IDS:
                        yield pa.RecordBatch.from_pylist(made, schema=target)
                        made, size = [], 0
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=target)

    importable(docs.sparkSession)
    return docs.select(
        F.spark_partition_id().alias("part"),
        F.col(source).alias("source"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    ).mapInArrow(batches, schema)


def _parts(shares: np.ndarray) -> np.ndarray:
    """``shares`` as whole parts of PARTS, by largest remainder; each positive share has one at least."""
    there = shares > 0
    wanted = shares / shares.sum() * (PARTS - there.sum())
    parts = np.floor(wanted).astype(np.int64)
    spare = int(PARTS - there.sum() - parts.sum())
    parts[np.argsort(parts - wanted, kind="stable")[:spare]] += 1
    return parts + there


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i all numbers from first[i] to last[i]: the i's and the numbers."""
    n = np.maximum(last - first + 1, 0)
    index = np.repeat(np.arange(len(n)), n)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n) + first[index]


@dataclass
class Schedule:
    """Where every token of every queue goes. Rows are phases, columns queues."""

    parts: np.ndarray
    carried: np.ndarray
    left: np.ndarray
    #: Tokens of each queue sent before each phase, and after the last.
    sent: np.ndarray
    capacity: int
    window: int

    @classmethod
    def of(
        cls,
        counts: list[int],
        shares: list[float] | None = None,
        capacity: int = CAPACITY,
        window: int = WINDOW,
    ) -> Schedule:
        """From the tokens of each queue; without ``shares`` each queue's share is its part of what is left.

        Queues with share 0 start when all others have run dry.
        """
        if sum(counts) >= MOST:
            raise ValueError(f"{sum(counts)} tokens; {MOST} and more are not exact here")
        left = np.array(counts, np.int64)
        wanted = None if shares is None else np.array(shares, float)
        carried, sent = np.zeros_like(left), np.zeros_like(left)
        rows = []
        while left.any():
            weights = np.where(left > 0, left if wanted is None else wanted, 0.0)
            if not weights.any():
                weights = left.astype(float)
            parts = _parts(weights)
            active = parts > 0
            step = window * parts[active]
            rounds = int(np.min(-((carried[active] - left[active] * PARTS) // step)))
            credit = rounds * window * parts + carried
            taken = np.where(active, np.minimum(left, credit // PARTS), 0)
            rows.append((parts, carried, left, sent))
            sent, left = sent + taken, left - taken
            carried = np.where(active & (left > 0), credit % PARTS, carried)
        none = np.zeros((0, len(left)), np.int64)
        columns = [np.array([row[i] for row in rows]) if rows else none for i in range(4)]
        return cls(*columns[:3], np.vstack([columns[3], sent]), capacity, window)

    def _after(self, phase: np.ndarray, k: np.ndarray, queue) -> np.ndarray:
        """Tokens the queue has sent in the phase after k windows."""
        credit = k * self.window * self.parts[phase, queue] + self.carried[phase, queue]
        return np.minimum(self.left[phase, queue], credit // PARTS) * (self.parts[phase, queue] > 0)

    def _window_of(self, phase: np.ndarray, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The window of the phase that sends the queue's token, counted from the phase's start."""
        step = self.window * self.parts[phase, queue]
        return -((self.carried[phase, queue] - (token + 1) * PARTS) // step)

    def _base(self, phase: np.ndarray, k: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Where in the stream the queue's tokens of that window start."""
        every = np.arange(self.parts.shape[1])
        base = self.sent[phase].sum(1)
        for start in range(0, len(k), 4096):
            some = slice(start, start + 4096)
            at, number = phase[some, None], k[some, None]
            ahead = every < queue[some, None]
            base[some] += self._after(at, number - ~ahead, every).sum(1)
        return base

    def _tail(self) -> np.ndarray:
        """Starts of the sequences from the last full one's end on, and the stream's end.

        The rest is cut into powers of two, which need no padding.
        """
        total = int(self.sent[-1].sum())
        starts = [total - total % self.capacity]
        for bit in reversed(range(self.capacity.bit_length())):
            if (total % self.capacity) >> bit & 1:
                starts.append(starts[-1] + (1 << bit))
        return np.array(starts, np.int64)

    def places(self, queue: np.ndarray, at: np.ndarray, length: np.ndarray) -> dict[str, np.ndarray]:
        """Pieces of rows that hold ``length`` tokens from the ``at``-th of their queue on.

        row, skipped (tokens of the row before the piece), length, sequence_id and offset, by row and place.
        """
        stop = at + length
        # By phase,
        first, last = np.zeros_like(at), np.zeros_like(at)
        for q in np.unique(queue):
            mine = queue == q
            first[mine] = np.searchsorted(self.sent[:, q], at[mine], side="right") - 1
            last[mine] = np.searchsorted(self.sent[:, q], stop[mine] - 1, side="right") - 1
        row, phase = _spread(first, last)
        q = queue[row]
        low = np.maximum(at[row], self.sent[phase, q])
        high = np.minimum(stop[row], self.sent[phase + 1, q])
        row, phase, low, high = (x[low < high] for x in (row, phase, low, high))
        # by window,
        q = queue[row]
        before = self.sent[phase, q]
        i, k = _spread(
            self._window_of(phase, q, low - before), self._window_of(phase, q, high - 1 - before)
        )
        row, phase, low, high, q, before = (x[i] for x in (row, phase, low, high, q, before))
        sent = before + self._after(phase, k - 1, q)
        low, high = np.maximum(low, sent), np.minimum(high, before + self._after(phase, k, q))
        some = low < high
        row, phase, low, high, q, sent, k = (x[some] for x in (row, phase, low, high, q, sent, k))
        place = self._base(phase, k, q) + low - sent
        # and by sequence.
        tail = self._tail()
        full = tail[0] // self.capacity

        def sequence(token: np.ndarray) -> np.ndarray:
            short = full + np.searchsorted(tail, token, side="right") - 1
            return np.where(token < tail[0], token // self.capacity, short)

        def start(number: np.ndarray) -> np.ndarray:
            return np.where(number < full, number * self.capacity, tail[np.clip(number - full, 0, len(tail) - 1)])

        i, number = _spread(sequence(place), sequence(place + high - low - 1))
        begin = np.maximum(place[i], start(number))
        end = np.minimum((place + high - low)[i], start(number + 1))
        skipped = low[i] - at[row[i]] + begin - place[i]
        # Neighbours in both the row and the stream are one piece.
        same = np.zeros(len(i), bool)
        same[1:] = (
            (row[i][1:] == row[i][:-1]) & (number[1:] == number[:-1]) & (begin[1:] == end[:-1])
            & (skipped[1:] - skipped[:-1] == begin[1:] - begin[:-1])
        )
        heads = np.flatnonzero(~same)
        ends = end[np.append(heads[1:] - 1, len(i) - 1)] if len(i) else end
        return {
            "row": row[i][heads],
            "skipped": skipped[heads],
            "length": ends - begin[heads],
            "sequence_id": number[heads],
            "offset": (begin - start(number))[heads],
        }


def _queues(totals: DataFrame, targets: Mapping | None) -> tuple[list, list[int], list[float] | None, int | None]:
    """Sources with a queue of their own, tokens and shares of all queues, and the number of the shared queue."""
    named = list(targets or {})
    if len(named) >= QUEUES:
        raise ValueError(f"{len(named)} targets; there are {QUEUES} queues")
    kind = totals.schema["source"].dataType
    wanted = totals.sparkSession.createDataFrame(
        [(name, True) for name in named], StructType().add("source", kind).add("named", "boolean")
    )
    same = F.col("t.source").eqNullSafe(F.col("w.source"))
    first = (
        totals.alias("t")
        .join(F.broadcast(wanted.alias("w")), same, "left")
        .select("t.source", "t.n", "w.named")
        .orderBy(F.desc_nulls_last("named"), F.desc("n"), "source")
        .limit(QUEUES + 1)
        .collect()
    )
    own = first if len(first) <= QUEUES else first[: QUEUES - 1]
    sources, counts = [row["source"] for row in own], [row["n"] for row in own]
    shared = None
    if len(first) > len(own):
        shared = len(own)
        counts.append(totals.agg(F.sum("n")).first()[0] - sum(counts))
    shares = None
    if targets is not None:
        shares = [float(targets.get(name, 0)) for name in sources] + [0.0] * (shared is not None)
        if min(shares, default=0) < 0:
            raise ValueError(f"negative targets: {dict(targets)}")
    return sources, counts, shares, shared


def pack(
    docs: DataFrame,
    path: str,
    source: str = "source",
    targets: Mapping | None = None,
    capacity: int = CAPACITY,
    window: int = WINDOW,
    end: int | None = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of ``docs`` in sequences: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Each id lies in one piece. All sequences hold ``capacity`` tokens but the last few, whose lengths are powers of two,
    so none needs padding. ``targets`` gives shares by source: as long as no named source runs dry, every window holds these; then the
    rest is shared among the others in their proportions, and sources that are not named come last. Without targets
    every window holds the proportions of the whole input. A null source is a source like any other.
    A document without ids (no ``end``, no text) has no piece; an empty table has none at all. Rows are independent of each other: repeated
    rows are packed as often as they occur. Columns other than doc_id, text and ``source`` are not read.
    """
    spark = docs.sparkSession
    importable(spark)
    stored = scratch.written(tokens(docs, path, source, end), "tokens")
    in_part = scratch.written(
        stored.groupBy("part", "source").agg(F.sum("length").alias("n")), "tokens-of-parts"
    )
    totals = in_part.groupBy("source").agg(F.sum("n").alias("n"))
    sources, counts, shares, shared = _queues(totals, targets)
    schedule = Schedule.of(counts, shares, capacity, window)

    listed = spark.createDataFrame(
        [(name, number) for number, name in enumerate(sources)],
        StructType().add("source", stored.schema["source"].dataType).add("queue", "integer"),
    )
    same = F.col("p.source").eqNullSafe(F.col("q.source"))
    dealt = in_part.alias("p").join(F.broadcast(listed.alias("q")), same, "left").select(
        "p.part", "p.source", "p.n", F.coalesce("q.queue", F.lit(shared)).alias("queue")
    )
    # One row for each task of the first step, then the sources of one such task.
    parts = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("queue", "part").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    of_parts = (
        dealt.groupBy("queue", "part")
        .agg(F.sum("n").alias("n"))
        .select("queue", "part", F.coalesce(F.sum("n").over(parts), F.lit(0)).alias("ahead"))
    )
    starts = dealt.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(
        of_parts, ["queue", "part"]
    )
    # Written, so that Spark knows its size and joins it to the ids without moving them where it is small.
    starts = scratch.written(
        starts.select("part", "source", "queue", (F.col("ahead") + F.col("inside")).alias("ahead")), "starts"
    )
    place = (F.col("t.part") == F.col("s.part")) & F.col("t.source").eqNullSafe(F.col("s.source"))
    located = stored.alias("t").join(starts.alias("s"), place).select(
        "t.source", "t.doc_id", "t.start", "t.doc_tokens", "t.length", "t.ids",
        "s.queue", (F.col("s.ahead") + F.col("t.before")).alias("at"),
    )
    kind = {f.name: f.dataType.simpleString() for f in stored.schema}
    schema = StructType.fromDDL(
        f"doc_id {kind['doc_id']}, source {kind['source']}, start bigint, length bigint, ids_crc32 bigint, "
        "doc_tokens bigint, sequence_id bigint, offset bigint" + (", ids array<int>" if keep_ids else "")
    )
    target = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            def whole(name: str) -> np.ndarray:
                return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)

            found = schedule.places(whole("queue"), whole("at"), whole("length"))
            rows, skipped, length = found["row"], found["skipped"], found["length"]
            if not len(rows):
                continue
            held = [memoryview(ids.as_buffer()) for ids in batch.column("ids")]
            some = [
                held[r][4 * a : 4 * (a + n)]
                for r, a, n in zip(rows.tolist(), skipped.tolist(), length.tolist(), strict=True)
            ]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows)),
                "source": batch.column("source").take(pa.array(rows)),
                "start": whole("start")[rows] + skipped,
                "length": length,
                "ids_crc32": np.fromiter(map(zlib.crc32, some), np.int64, len(some)),
                "doc_tokens": whole("doc_tokens")[rows],
                "sequence_id": found["sequence_id"],
                "offset": found["offset"],
            }
            if keep_ids:
                columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype("i4") for x in some], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type)
                    for x, f in ((columns[f.name], f) for f in target)
                ],
                schema=target,
            )

    return located.mapInArrow(batches, schema)
