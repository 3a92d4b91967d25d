"""Spelling variants by Bloom-guided neighbourhoods.

Every edit of every word that could be a word is generated, but none is sent anywhere before a blocked Bloom filter of the
vocabulary says that it may exist. There is one filter for each word length, all in one array that is
broadcast: a deletion asks the filter of the length below, a replacement that of its own length. What passes goes
to an exact join with the vocabulary, which removes false positives. An insertion is a deletion seen from the other word, and
a replacement is tried with the larger letter only, so each pair of near words is found once.

Hashes are polynomials over code points, so the hash of an edit follows from the word's by a few operations whatever its
length, and strings are made for positives only. The array has a fixed largest size; a vocabulary it cannot hold is
dealt over rounds by hash, each with filters of its own, and every edit is looked up in its round's.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm.arrow import importable
from clickloom.sinks import scratch

#: Code points at least, and occurrences at least, of a word.
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A run is misspelt on purpose if this divides its digest.
DAMAGE = 97
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: What lower-cased runs consist of.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
#: Bits of a filter for each word, and bytes of all filters of a round at most (they are rounded up to powers of two).
BITS = 32
FILTER_BYTES = 32 << 20
#: 64-bit blocks of a filter at least; a block answers a probe by six of its bits.
LEAST_BLOCKS = 1 << 10
PROBES = 6
#: Lengths up to this have a filter each, longer ones one for each power of two.
LENGTHS = 64
#: Runs of a text counted at a time, and distinct ones a task holds before it hands them on; edits looked up at a time, words to a task.
RUNS = 200_000
EDITS = 1 << 20
WORDS = 50_000

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def counted(docs: DataFrame, damage: int | None = DAMAGE) -> DataFrame:
    """word and its occurrences ``n`` in ``docs`` (doc_id, text), of any length and number.

    Runs of letters, lower-cased in A-Z only. With ``damage`` a run loses one letter if that number divides the CRC of the
    document's id and the run. A null text has no runs; a null id counts as the empty string.
    """
    schema = T.StructType.fromDDL("word string, n bigint")
    target = to_arrow_schema(schema)

    def emitted(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], schema=target)

    def add(key: str, runs: Counter, counts: Counter) -> None:
        lower: Counter = Counter()
        for run, n in runs.items():
            lower[run.lower() if run.isascii() else run.translate(_LOWER)] += n
        for run, n in lower.items():
            if damage:
                digest = zlib.crc32(f"{key}:{run}".encode())
                if digest % damage == 0:
                    at = digest % len(run)
                    run = run[:at] + run[at + 1 :]
            counts[run] += n

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in given:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # Some at a time: neither a very long text's runs nor its distinct ones are ever held together.
                matches = RUN.finditer(text.as_py())
                while runs := Counter(found.group() for found in islice(matches, RUNS)):
                    add(key, runs, counts)
                    if len(counts) >= RUNS:
                        yield emitted(counts)
                        counts.clear()
        if counts:
            yield emitted(counts)

    importable(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.filter("text IS NOT NULL").select(key, "text").mapInArrow(batches, schema)
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def shard_of(length: int) -> int:
    """The filter that words of ``length`` are in."""
    return length if length <= LENGTHS else LENGTHS + length.bit_length()


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _FACTOR, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


class Filters:
    """Where the blocks of each length's filter lie in one array, for one of ``rounds`` parts of the vocabulary."""

    def __init__(self, sizes: dict[int, int], rounds: int = 1) -> None:
        self.rounds = rounds
        self.blocks: dict[int, tuple[int, int]] = {}
        self.total = 0
        for shard, n in sorted(sizes.items()):
            wanted = max(LEAST_BLOCKS, n * BITS // 64 // rounds)
            blocks = 1 << (wanted - 1).bit_length()
            self.blocks[shard] = (self.total, blocks)
            self.total += blocks

    def slots(self, hashes: np.ndarray, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Round, block and the bits in it, for each polynomial hash."""
        start, blocks = self.blocks[shard]
        mixed = _mixed(hashes + np.uint64(shard))
        bits = np.zeros(len(mixed), np.uint64)
        other = _mixed(mixed)
        for probe in range(PROBES):
            bits |= np.uint64(1) << ((other >> np.uint64(6 * probe)) & np.uint64(63))
        block = (mixed & np.uint64(blocks - 1)).astype(np.int64) + start
        return (mixed >> np.uint64(40)) % np.uint64(self.rounds), block, bits


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for mine in np.split(order, cuts):
        if len(mine):
            yield int(lengths[mine[0]]), mine


def _built(vocabulary: DataFrame, filters: Filters, number: int) -> np.ndarray:
    """The array of one round: blocks are combined in tasks, and only blocks with bits reach the driver."""
    schema = T.StructType.fromDDL("block bigint, bits bigint")
    target = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            words = batch.column(0).to_pylist()
            for length, mine in _by_length(words):
                hashes = _codes([words[i] for i in mine]) @ _powers(length)
                part, block, bits = filters.slots(hashes, shard_of(length))
                here = part == number
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[here]), pa.array(bits[here].view(np.int64))], schema=target
                )

    made = vocabulary.select("word").mapInArrow(batches, schema)
    found = made.groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    array = np.zeros(filters.total, np.uint64)
    array[found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return array


def _edits(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Edits of words of one length, some at a time: new length, hashes, row, place, and the new letter (0: deleted)."""
    m, length = codes.shape
    powers = _powers(length)
    terms = codes * powers
    ahead = np.cumsum(terms, 1)
    whole = ahead[:, -1]
    # In a run of equal letters, deleting any gives the same word: the last is deleted.
    last = np.ones(codes.shape, bool)
    last[:, :-1] = codes[:, 1:] != codes[:, :-1]
    row, place = np.nonzero(last)
    shifted = (whole[row] - ahead[row, place]) * np.uint64(_INVERSE)
    yield length - 1, ahead[row, place] - terms[row, place] + shifted, row, place, np.zeros(len(row), np.uint64)
    step = max(1, EDITS // len(LETTERS))
    cells = codes.ravel()
    for start in range(0, m * length, step):
        some = cells[start : start + step]
        cell, letter = np.nonzero(LETTERS > some[:, None])
        new = LETTERS[letter]
        row, place = np.divmod(cell + start, length)
        yield length, whole[row] + (new - some[cell]) * powers[place], row, place, new


def _probed(vocabulary: DataFrame, filters: Filters, number: int, held) -> DataFrame:
    """word, n and an edit ``other`` of it that the round's filters do not rule out."""
    schema = T.StructType.fromDDL("word string, n bigint, other string")
    target = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = held.value
        for batch in given:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for length, mine in _by_length(words):
                step = max(1, EDITS // length)
                for start in range(0, len(mine), step):
                    chunk = mine[start : start + step]
                    for size, hashes, row, place, letter in _edits(_codes([words[i] for i in chunk])):
                        if shard_of(size) not in filters.blocks:
                            continue
                        part, block, bits = filters.slots(hashes, shard_of(size))
                        maybe = np.flatnonzero((part == number) & (array[block] & bits == bits))
                        if not len(maybe):
                            continue
                        source = [words[chunk[i]] for i in row[maybe]]
                        other = [
                            word[:at] + (chr(new) if new else "") + word[at + 1 :]
                            for word, at, new in zip(source, place[maybe].tolist(), letter[maybe].tolist(), strict=True)
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(source, pa.string()),
                                pa.array(n[chunk[row[maybe]]], pa.int64()),
                                pa.array(other, pa.string()),
                            ],
                            schema=target,
                        )

    return vocabulary.select("word", "n").mapInArrow(batches, schema)


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, other, other_n: all pairs one edit apart, each once. ``vocabulary`` (word, n) holds each word once and is read repeatedly."""
    spark = vocabulary.sparkSession
    importable(spark)
    length = F.length("word")
    long = F.lit(LENGTHS + 1) + F.floor(F.log2(length))
    sizes = {
        int(row["shard"]): row["n"]
        for row in vocabulary.groupBy(F.when(length <= LENGTHS, length).otherwise(long).alias("shard"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    total = sum(sizes.values())
    rounds = max(1, math.ceil(total * BITS / 8 / filter_bytes))
    filters = Filters(sizes, rounds)
    # Words are few bytes and much work, so tasks are counted in words.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // WORDS)
    dealt = vocabulary.repartition(tasks, "word")
    known = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    found = None
    for number in range(rounds):
        held = spark.sparkContext.broadcast(_built(vocabulary, filters, number))
        # Written in each round, so that the next round's array takes the place of this one's.
        pairs = scratch.written(_probed(dealt, filters, number, held).join(known, "other"), "near-words")
        held.destroy()
        found = pairs if found is None else found.unionByName(pairs)
    return found.select("word", "n", "other", "other_n")


def forms(vocabulary: DataFrame, pairs: DataFrame, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n.

    ``form`` is the near word with the largest n (ties: the first in code-point order), if that is at least ``factor`` times the word's own;
    ``root`` is where following forms ends. Since n grows at each step, chains are short, and each
    round of joins follows twice as many steps.
    """
    both = pairs.unionByName(
        pairs.select(
            F.col("other").alias("word"), F.col("other_n").alias("n"),
            F.col("word").alias("other"), F.col("n").alias("other_n"),
        )
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best"),
    )
    larger = -F.col("best.minus") >= factor * F.col("n")
    known = vocabulary.join(best, "word", "left").select(
        "word",
        F.when(larger, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(larger, -F.col("best.minus")).alias("form_n"),
    )
    known = scratch.written(known.withColumn("root", F.coalesce("form", "word")), "forms")
    top = known.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(top, factor)))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        after = known.filter("form IS NOT NULL").select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = known.join(after, F.col("root") == F.col("at"), "left")
        known = scratch.written(
            moved.select("word", "form", F.coalesce("next", "root").alias("root"), "n", "n_near", "form_n"), "forms"
        )
    return known.select("word", "form", "root", "n", "n_near", "form_n")


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    damage: int | None = DAMAGE,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """The words of ``docs`` (doc_id, text) with their forms and roots (see ``forms``), one row for each.

    A table without words gives no row. Rows are independent of each other: repeated rows count as often as they occur. Runs
    of any length are words like others. Other columns are not read.
    """
    words = counted(docs, damage).filter((F.length("word") >= least_length) & (F.col("n") >= least_count))
    vocabulary = scratch.written(words, "vocabulary")
    return forms(vocabulary, near_pairs(vocabulary, filter_bytes))
