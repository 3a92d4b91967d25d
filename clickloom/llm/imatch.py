"""I-Match fingerprints over randomised lexicons.

The lexicon is all terms within a band of inverse document frequency, counted over all documents. At each level it is dealt at
random over a number of lexicons, twice as many as at the level before, and a document's sub-fingerprint in
each is the hash of its sorted distinct terms there. Every term in the band counts, at every level. A document uses the first level at which
its lexicons hold TERMS of its terms or fewer on average, and the one before, with twice as many in each: so a part of the
text can change and leave lexicons untouched, however long it is. Two fingerprints are as alike as the share of
sub-fingerprints they have in common, at the levels both use.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import importable, map_rows
from clickloom.sinks import scratch

#: The band: terms of at least two documents, and of at most a tenth of all.
LEAST_DOCUMENTS = 2
MOST_SHARE = 0.1
#: Randomised lexicons at level 0, and terms of a document in a lexicon of its finer level, on average and at most.
LEXICONS = 8
TERMS = 2
#: Hexadecimal digits of a sub-fingerprint.
DIGITS = 6

#: Terms in the band that tasks hold themselves, 8 bytes each. A larger lexicon is joined with all terms of all documents.
HELD = 8_000_000

#: Terms a task holds before it counts and hands them on.
COUNTED = 4_000_000

_MARKS = ".,;:!?\"'()[]{}<>#$%&*|@~^_=+-/\\`"


def terms(text: str) -> np.ndarray:
    """Hashes of the distinct terms: words between white space, in lower case, without marks around them."""
    found = {word.strip(_MARKS) for word in set(text.lower().split())}
    found.discard("")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def level_of(n: int) -> int:
    """The coarser of the two levels of a document with ``n`` terms in the band."""
    return max(0, ((max(1, n) - 1) // (2 * TERMS * LEXICONS)).bit_length())


def fingerprint(found: np.ndarray, text_hash: int) -> str:
    """The fingerprint of a document by all its terms in the band: its coarser level, and the sub-fingerprints there and at the next.

    Without terms in the band it is the hash of the whole text.
    """
    if not len(found):
        return f"text:{text_hash & 0xFFFFFFFFFFFFFFFF:016x}"
    values = np.sort(found.astype(np.uint64))
    level = level_of(len(values))
    written = [str(level)]
    for at in (level, level + 1):
        lexicon = values % np.uint64(LEXICONS << at)
        order = np.argsort(lexicon, kind="stable")
        lexicon, data = lexicon[order], values[order].astype(">u8").tobytes()
        starts = np.flatnonzero(np.diff(lexicon, prepend=lexicon[:1] + np.uint64(1)))
        parts = [""] * (LEXICONS << at)
        for part, start, stop in zip(
            lexicon[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(lexicon)], strict=True
        ):
            parts[part] = xxhash.xxh32_hexdigest(data[8 * start : 8 * stop])[:DIGITS]
        written.append(".".join(parts))
    return "|".join(written)


def likeness(one: str, other: str) -> float:
    """0 to 1: of the lexicons at common levels in which either has a term, the share where both agree."""
    if one == other:
        return 1.0
    if one.startswith("text:") or other.startswith("text:"):
        return 0.0
    levels = []
    for written in (one, other):
        level, first, second = written.split("|")
        levels.append({int(level): first.split("."), int(level) + 1: second.split(".")})
    used = same = 0
    for level in levels[0].keys() & levels[1].keys():
        for a, b in zip(levels[0][level], levels[1][level], strict=True):
            used += bool(a or b)
            same += bool(a) and a == b
    return same / used if used else 0.0


def text_hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64))


def frequencies(docs: DataFrame) -> DataFrame:
    """term and n, the number of rows of ``docs`` that hold it. Tasks count what they read before anything is shuffled."""
    importable(docs.sparkSession)
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64)), pa.array(times.astype(np.int64))], schema=schema
            )

        for batch in source:
            for text in batch.column(0):
                held.append(terms(text.as_py()))
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(batches, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


class Lexicon:
    """Terms in the band, and those too frequent for it.

    In a table too small for the band, the terms of LEAST_DOCUMENTS documents are in it. The latter are few: with MOST_SHARE of a tenth at most ten times the mean number of terms in a document. So tasks may hold
    them, and no frequent term is ever shuffled with the documents. Tasks also hold a band of at most HELD terms.
    """

    def __init__(self, docs: DataFrame, documents: int) -> None:
        most = max(MOST_SHARE * documents, LEAST_DOCUMENTS)
        counted = scratch.written(
            frequencies(docs).filter(F.col("n") >= LEAST_DOCUMENTS), "frequencies"
        )
        self.band = counted.filter(F.col("n") <= most).select("term")
        #: Whether tasks know the band, so that ``known`` gives nothing else.
        self.held = self.band.count() <= HELD
        told = self.band if self.held else counted.filter(F.col("n") > most).select("term")
        column = told.toArrow().column("term").to_numpy()
        self.told = docs.sparkSession.sparkContext.broadcast(np.sort(column.astype(np.uint64)))

    def reader(self) -> Callable[[np.ndarray], np.ndarray]:
        """For tasks: of a document's terms, those in the band; if tasks do not hold it, all but the frequent ones."""
        told, held = self.told, self.held

        def known(found: np.ndarray) -> np.ndarray:
            listed = told.value
            if not len(listed):
                return found[:0] if held else found
            at = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
            return found[(listed[at] == found) == held]

        return known

    def resolve(
        self,
        samples: DataFrame,
        function: Callable[[dict, list[np.ndarray]], dict],
        schema: str,
    ) -> DataFrame:
        """``function(row, terms)`` over the rows of ``samples``, with all terms in the band of its two texts.

        ``samples`` is a written table with range and pos, which name a row, and terms: an array of (term, mark) as read by
        ``reader``, where the bits of mark tell the texts that hold the term.
        """

        def rows(slice_: list[dict]) -> list[dict]:
            made = []
            for row in slice_:
                pairs = row.pop("terms") or ()
                texts = [
                    np.array([t["term"] for t in pairs if t["mark"] & bit], np.int64).astype(np.uint64)
                    for bit in (1, 2)
                ]
                made.append(function(row, texts))
            return made

        if not self.held:
            pairs = samples.select("range", "pos", F.explode("terms").alias("t"))
            known = (
                pairs.select("range", "pos", F.col("t.term").alias("term"), F.col("t.mark").alias("mark"))
                .join(self.band, "term")
                .groupBy("range", "pos")
                .agg(F.collect_list(F.struct("term", "mark")).alias("terms"))
            )
            samples = samples.drop("terms").join(known, ["range", "pos"], "left")
        return map_rows(samples, rows, schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each row of ``docs`` (doc_id, text), by the lexicon of all of them.

    A null text is empty, and has no terms: its fingerprint is the hash of the empty text. Equal texts have equal
    fingerprints, repeated rows included. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lexicon = Lexicon(docs, docs.count())
    known, held = lexicon.reader(), lexicon.held

    def rows(slice_: list[dict]) -> list[dict]:
        made = []
        for row in slice_:
            found, hashed = known(terms(row["text"])), text_hash(row["text"])
            out = {"range": 0, "pos": row["pos"], "doc_id": row["doc_id"], "text_hash": hashed}
            if held:
                out["fingerprint"] = fingerprint(found, hashed)
            else:
                out["terms"] = [{"term": term, "mark": 1} for term in found.astype(np.int64).tolist()]
            made.append(out)
        return made

    source = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("pos"),
    )
    samples = map_rows(
        source,
        rows,
        f"range int, pos bigint, doc_id {kind}, text_hash bigint, fingerprint string, "
        "terms array<struct<term:bigint,mark:tinyint>>",
    )
    if held:
        return samples.select("doc_id", "fingerprint")
    return lexicon.resolve(
        scratch.written(samples, "samples"),
        lambda row, texts: {"doc_id": row["doc_id"], "fingerprint": fingerprint(texts[0], row["text_hash"])},
        f"doc_id {kind}, fingerprint string",
    )
