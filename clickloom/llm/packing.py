"""Best-fit packing by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces of each length reaches the driver:
``capacity`` numbers, however many pieces there are. On these counts the plan is made. For each length, from the longest down, the gap it
leaves is looked up in an index of the lengths that are still available, then of the sums of pairs, then of triples, and as
many sequences as the counts allow are filled exactly at once. What remains goes, longest first, to the open
sequence it fits best; should pairs or triples do worse than best fit, they are left out. A plan is a list of (times, lengths): each step uses up a length or a group of open sequences, so
it has a few thousand entries at any size. Pieces of one length are numbered, in shares so that no length lands
in one task, and each number looks up its place in the plan.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.arrow import importable, map_rows
from clickloom.llm.bpe import PIECES, byte_symbols
from clickloom.sinks import scratch

CAPACITY = 2048
#: Steps that use up a length, after which the index of sums is made anew; in between it is only too large.
REINDEX = 32


@lru_cache(maxsize=2)
def _native_encoders(path: str):
    """The library's encoders for texts with and without runs of white space, from one vocabulary file.

    Without such runs the pattern needs no look-ahead, and a faster engine can match it.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    of_symbol = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    special = {added["content"]: added["id"] for added in content.get("added_tokens", [])}
    ranks = {
        bytes(of_symbol[symbol] for symbol in token): number
        for token, number in content["model"]["vocab"].items()
        if number not in special.values()
    }
    del content
    simple = PIECES.replace(r"|\s+(?!\S)", "")
    return [
        tiktoken.Encoding(
            f"{path}#{n}", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
        )
        for n, pattern in enumerate((PIECES, simple))
    ], list(special)


_RUN = re.compile(r"\s\s")
#: Runs of white space (Unicode's property) from this length on are encoded apart: the engine's look-ahead
#: holds one entry for each character of a run, and gives up at a million.
LONG_RUN = 10_000
_LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def token_ids(text: str, path: str) -> np.ndarray:
    """What the tokenizers library gives for ``text``, several times as fast."""
    if len(text) < LONG_RUN:
        return _token_ids(text, path)
    special = tuple(_native_encoders(path)[1])
    parts, place = [], 0
    for run in _LONG_RUN.finditer(text):
        # The last character of a run belongs to the word that follows it; the others are one piece, before and after which
        # pieces end whatever stands there.
        followed = run.end() < len(text) and not text.startswith(special, run.end())
        end = run.end() - followed
        parts += [_token_ids(text[place : run.start()], path), _run_ids(text[run.start() : end], path)]
        place = end
    parts.append(_token_ids(text[place:], path))
    return np.concatenate(parts)


def _run_ids(run: str, path: str) -> np.ndarray:
    (_, simple), _ = _native_encoders(path)
    return simple.encode_to_numpy(run, disallowed_special=())


def _token_ids(text: str, path: str) -> np.ndarray:
    (general, simple), special = _native_encoders(path)
    chosen = general if _RUN.search(text) else simple
    if any(token in text for token in special):
        return chosen.encode_to_numpy(text, allowed_special="all")
    return chosen.encode_to_numpy(text, disallowed_special=())


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end: int | None = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """Token pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, and with ``keep_ids`` ids.

    A document is its ids and then ``end``, if that is given; a null text is the empty text. One longer than
    ``capacity`` is cut so that all pieces but the first are full. A document without ids (no ``end``, no text)
    has no piece. Rows are independent of each other: repeated rows give repeated pieces.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (
        ", ids array<int>" if keep_ids else ""
    )

    def rows(slice_: list[dict]) -> list[dict]:
        made = []
        for row in slice_:
            ids = token_ids(row["text"], path).astype("<u4")
            if end is not None:
                ids = np.append(ids, np.array([end], "<u4"))
            start, number = 0, 0
            while start < len(ids):
                stop = start + ((len(ids) - start) % capacity or capacity)
                made.append(
                    {
                        "doc_id": row["doc_id"],
                        "piece": number,
                        "start": start,
                        "length": stop - start,
                        "ids_crc32": zlib.crc32(ids[start:stop].tobytes()),
                    }
                    | ({"ids": ids[start:stop].astype("i4")} if keep_ids else {})
                )
                start, number = stop, number + 1
        return made

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_rows(source, rows, schema)


class _Sums:
    """Which gaps one, two or three available lengths fill exactly."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        self.age = REINDEX

    def refresh(self) -> None:
        if self.age >= REINDEX:
            there = (self.counts > 0).astype(np.float64)
            n = len(there)
            self.pairs = np.rint(np.convolve(there, there))[:n] > 0
            self.triples = np.rint(np.convolve(self.pairs.astype(np.float64), there))[:n] > 0
            self.age = 0

    def pair(self, gap: int, taken: Counter, largest: int) -> tuple[int, int] | None:
        """The available pair with sum ``gap`` that has the longest first length, at most ``largest``."""
        if gap < 2 or not self.pairs[gap]:
            return None
        a = np.arange(min(gap - 1, largest), (gap - 1) // 2, -1)
        b = gap - a
        left = self.counts.copy() if taken else self.counts
        for length, times in taken.items():
            left[length] -= times
        fits = np.flatnonzero((left[a] > 0) & (left[b] > (a == b)))
        return (int(a[fits[0]]), int(b[fits[0]])) if len(fits) else None

    def filling(self, anchor: int, gap: int, depth: int) -> tuple[int, ...] | None:
        """``depth`` lengths that fill ``gap`` exactly beside ``anchor``."""
        taken = Counter({anchor: 1})
        if gap < depth:
            return None
        if depth == 1:
            return (gap,) if self.counts[gap] > taken[gap] else None
        if depth == 2:
            return self.pair(gap, taken, gap)
        if not self.triples[gap]:
            return None
        first = np.arange(gap - 2, (gap - 1) // 3, -1)
        first = first[(self.counts[first] > 0) & self.pairs[gap - first]]
        for a in map(int, first):
            if self.counts[a] > taken[a]:
                if pair := self.pair(gap - a, taken + Counter({a: 1}), a):
                    return (a, *pair)
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths of one sequence) that use every piece counted once; lengths are 1 to ``capacity``.

    Exact fillings are consumed by single lengths, then by pairs, then by triples, each over all gaps; the rest is
    packed by best fit. Since pairs and triples may take lengths that best fit had better use for, the plan is the best of those that stop
    at singles, at pairs and at triples.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    steps: list[tuple[int, tuple[int, ...]]] = []
    if left[capacity]:
        steps.append((int(left[capacity]), (capacity,)))
        left[capacity] = 0
    plans = []
    for depth in (1, 2, 3):
        steps += _exact(left, capacity, depth)
        plans.append(steps + _best_fit(left.copy(), capacity))
    return min(plans, key=lambda found: sum(times for times, _ in found))


def _exact(left: np.ndarray, capacity: int, depth: int) -> list[tuple[int, tuple[int, ...]]]:
    """Consume, from the longest length down, what ``depth`` other lengths complete exactly."""
    steps = []
    index = _Sums(left)
    for anchor in range(capacity - 1, 0, -1):
        while left[anchor]:
            index.refresh()
            filling = index.filling(anchor, capacity - anchor, depth)
            if filling is None:
                break
            lengths = (anchor, *filling)
            times = min(int(left[x]) // n for x, n in Counter(lengths).items())
            steps.append((times, lengths))
            for length in lengths:
                left[length] -= times
            index.age += 1
    return steps


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over counts: equal open sequences are one group."""
    groups: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, bool)

    def put(gap: int, times: int, lengths: tuple[int, ...]) -> None:
        groups[gap].append((times, lengths))
        filled[gap] = True

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(filled[length:])
            if not len(fits):
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, n // each, (length,) * each)
                if n % each:
                    put(capacity - n % each * length, 1, (length,) * (n % each))
                break
            gap = length + int(fits[0])
            times, lengths = groups[gap].pop()
            used = min(times, n)
            if used < times:
                groups[gap].append((times - used, lengths))
            filled[gap] = bool(groups[gap])
            put(gap - length, used, (*lengths, length))
            n -= used
    return [group for at in groups for group in at]


class _Places:
    """Where the n-th piece of each length goes."""

    def __init__(self, steps: list[tuple[int, tuple[int, ...]]], capacity: int) -> None:
        used = np.zeros(capacity + 1, np.int64)
        slots, sequence = [], 0
        for times, lengths in steps:
            offset = 0
            for length in lengths:
                slots.append((length, int(used[length]), sequence - int(used[length]), offset))
                used[length] += times
                offset += length
            sequence += times
        table = np.array(sorted(slots), np.int64).reshape(-1, 4)
        self.keys = (table[:, 0] << 48) + table[:, 1]
        self.shift, self.offset = table[:, 2], table[:, 3]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 48) + rank, side="right") - 1
        return rank + self.shift[at], self.offset[at]


def _numbered(stored: DataFrame) -> DataFrame:
    """``stored`` with ``rank``: 0, 1, ... among the pieces of a length.

    A length is dealt over as many shares as there are shuffle partitions; each share is numbered by itself, from
    where the shares before it end. Rows alike in all columns may swap numbers, which changes nothing.
    """
    shares = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored.withColumn(
        "share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares))
    )
    first = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "share")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(first), F.lit(0)))
        .drop("n")
    )
    order = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        dealt.withColumn("local", F.row_number().over(order) - 1)
        .join(starts, ["length", "share"])
        .withColumn("rank", F.col("before") + F.col("local"))
        .drop("share", "before", "local")
    )


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``made`` (as ``pieces`` gives it) with ``sequence_id`` and ``offset``.

    Every piece gets one place; sequences are gapless from offset 0 and hold at most ``capacity`` tokens. An empty
    table packs into no sequence. The pieces are written once to the shared folder, since they are read twice.
    """
    importable(made.sparkSession)
    stored = scratch.written(made, "pieces")
    histogram = stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    places = _Places(plan({row["length"]: row["n"] for row in histogram}, capacity), capacity)

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sequence, offset = places.find(
                rows["length"].to_numpy(np.int64), rows["rank"].to_numpy(np.int64)
            )
            yield rows.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    numbered = _numbered(stored).select(*stored.columns, "rank")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema)
    return numbered.mapInPandas(look_up, f"{fields}, sequence_id bigint, offset bigint")
