"""Jaccard self-join on word n-grams by chosen paths.

A document is the set of its word n-grams. Documents with the same set are one representative with a number of
copies, so copies cost nothing further. A run samples a shared token: the n-gram that comes first in the run's
random order (its min-hash), and all representatives with the same token form a bucket. A bucket beyond LIMIT is
split again by further sampled tokens, two at a level so that similar pairs rarely part, for DEPTH levels at most. A bucket
that splitting does not take apart is left whole: its members are alike. Small and dense buckets, the leaves, are
searched by brute force: first on sketches, then on the whole sets, which are gathered only for documents that have a
plausible partner. As many runs are made as the target recall asks for.

A pair that meets in several leaves counts in the first only. A leaf adds up the links of each member and joins its linked
members to a tree, so that a group of near copies never becomes rows of pairs. Leaves beyond BLOCK are searched block by
block, each pair of blocks a group of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.arrow import map_groups, map_rows, without_repeats
from clickloom.llm.components import components
from clickloom.sinks import scratch

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999

#: Coordinates of a sketch; the first are the runs' tokens, the others split large buckets.
COORDINATES = 64
#: Members of a bucket from which it is split, levels of splitting, tokens sampled at a level.
LIMIT = 512
DEPTH = 3
SAMPLED = 2
#: Share of a bucket that one token may keep together before splitting counts as useless.
DENSE = 0.5
#: Members in memory on either side of a search.
BLOCK = 512
#: Equal coordinates from which a pair is looked at: one of the threshold falls below once in a hundred thousand.
PLAUSIBLE_SIGMAS = 4.2

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xBF58476D1CE4E5B9)
_random = np.random.default_rng(20)
_ODD = _random.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _random.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)


def grams(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-grams of lower-cased words between white space.

    A text with fewer words has one n-gram, of all its words; one without words has none.
    """
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = min(words, len(tokens))
    mixed = np.full(len(tokens) - n + 1, n, np.uint64)
    for place in range(n):
        mixed = mixed * _MULTIPLIER + hashed[place : len(tokens) - n + 1 + place]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _MIXER
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def sketch(found: np.ndarray) -> np.ndarray:
    """Min-hashes of a set of n-grams."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 2048):
        part = (low[None, start : start + 2048] ^ _XOR[:, None]) * _ODD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at ``threshold`` has met in a leaf with probability ``recall``."""
    survives = threshold * (1 - (1 - threshold) ** SAMPLED) ** DEPTH
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survives)))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_key, digest of the set, its size and its sketch, for each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(slice_: list[dict]) -> list[dict]:
        made = []
        for row in slice_:
            found = grams(row.pop("text"), words)
            row["digest"] = xxhash.xxh3_128_digest(found.tobytes())
            row["size"] = len(found)
            row["sketch"] = sketch(found).tobytes()
            made.append(row)
        return made

    source = docs.select(
        "doc_id", _text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    schema = f"doc_id {kind}, text_key bigint, digest binary, size int, sketch binary"
    return map_rows(source, rows, schema)


def _token(coordinate: Column | int) -> Column:
    """One coordinate of the sketch."""
    start = F.lit(coordinate) * 4 + 1 if isinstance(coordinate, int) else coordinate * 4 + 1
    return F.substring("sketch", start, F.lit(4))


def _node(run: Column, *parts: Column) -> Column:
    """A bucket's number; numbers sort by run."""
    return F.shiftleft(run.cast("bigint"), 56) + F.shiftrightunsigned(F.xxhash64(run, *parts), 8)


def leaves(reps: DataFrame, runs: int) -> DataFrame:
    """digest and leaf, for the leaves of every run that hold two members or more."""
    first = reps.filter("size > 0").select(
        "digest", "sketch", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    )
    placed = first.select("digest", "run", _node(F.col("run"), _token(F.col("run"))).alias("node"))
    sizes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    open_ = scratch.written(placed.join(sizes, "node"), "buckets")
    done = [open_.filter(F.col("n") <= LIMIT).select("digest", F.col("node").alias("leaf"))]
    large = open_.filter(F.col("n") > LIMIT)
    spare = COORDINATES - runs
    for level in range(DEPTH):
        if large.isEmpty():
            break
        samples = F.array(*(F.lit(level * SAMPLED + s) for s in range(SAMPLED)))
        at = F.lit(runs) + F.pmod(F.col("run") * (DEPTH * SAMPLED) + F.col("s"), F.lit(spare))
        split = (
            large.withColumnRenamed("n", "whole")
            .join(reps.select("digest", "sketch"), "digest")
            .withColumn("s", F.explode(samples))
            .select("digest", "run", "node", "whole", _node(F.col("run"), "node", "s", _token(at)).alias("child"))
        )
        children = split.groupBy("node", "child").agg(
            F.count(F.lit(1)).alias("n"), F.first("whole").alias("whole")
        )
        dense = (
            children.groupBy("node")
            .agg((F.max("n") > DENSE * F.first("whole")).alias("dense"))
            .filter("dense")
            .select("node")
        )
        dense = scratch.written(dense, "dense")
        done.append(large.join(dense, "node", "left_semi").select("digest", F.col("node").alias("leaf")))
        inner = (
            split.join(dense, "node", "left_anti")
            .join(children.filter("n > 1").select("child", "n"), "child")
            .select("digest", "run", F.col("child").alias("node"), "n")
        )
        inner = scratch.written(inner, "buckets")
        done.append(inner.filter(F.col("n") <= LIMIT).select("digest", F.col("node").alias("leaf")))
        large = inner.filter(F.col("n") > LIMIT)
    else:
        done.append(large.select("digest", F.col("node").alias("leaf")))
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    return scratch.written(found, "leaves")


def _of_run(run: int) -> Column:
    return F.filter("leaves", lambda leaf: F.shiftright(leaf, 56) == run)


def _useful(found: DataFrame, runs: int) -> DataFrame:
    """``found`` without leaves whose members all share a leaf of an earlier run, and with each member's leaves.

    Columns: digest, leaf, n (members of the leaf), leaves (all of the digest, sorted).
    """
    run = F.shiftright("leaf", 56)
    each = found.groupBy("digest").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    earlier = found.join(each, "digest")
    only = [F.when(F.size(x) == 1, x[0]) for x in map(_of_run, range(runs))]
    stats = earlier.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.min(x).alias(f"low{q}") for q, x in enumerate(only)),
        *(F.max(x).alias(f"high{q}") for q, x in enumerate(only)),
        *(F.count(x).alias(f"with{q}") for q, x in enumerate(only)),
    )
    shared = F.lit(False)
    for q in range(runs):
        shared = shared | (
            (run > q) & (F.col(f"with{q}") == F.col("n")) & (F.col(f"low{q}") == F.col(f"high{q}"))
        )
    # Written, so that neither side of the next join is tied to a grouping and hot leaves can be split.
    kept = stats.filter(~F.coalesce(shared, F.lit(False))).select("leaf", "n")
    kept = scratch.written(kept, "kept-leaves")
    return scratch.written(earlier.join(kept, "leaf"), "useful")


def _blocked(members: DataFrame) -> DataFrame:
    """A row for each pair of blocks (i, j) a member is searched in; side 1 is the second block."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("digest"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        members.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
        .drop("blocks", "own", "other", "n")
    )


@dataclass
class _Rule:
    """Counts a pair only in the first leaf it meets in."""

    leaf: int
    table: np.ndarray

    @classmethod
    def of(cls, group: list[dict]) -> _Rule:
        width = max(len(row["leaves"]) for row in group)
        table = np.empty((len(group), width), np.int64)
        for n, row in enumerate(group):
            table[n] = -1 - n
            table[n, : len(row["leaves"])] = row["leaves"]
        return cls(group[0]["leaf"], table)

    def here(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for start in range(0, len(a), 1 << 16):
            x, y = self.table[a[start : start + (1 << 16)]], self.table[b[start : start + (1 << 16)]]
            for column in range(x.shape[1]):
                before = (x[:, column] >= 0) & (x[:, column] < self.leaf)
                if before.any():
                    met = before & (y == x[:, column : column + 1]).any(axis=1)
                    out[start : start + (1 << 16)] &= ~met
        return out


def _pairs(group: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a group of blocks, in slices: within one block, or between the two sides."""
    side = np.array([row["side"] for row in group])
    if group[0]["i"] == group[0]["j"]:
        for start in range(0, len(group), 128):
            a, b = np.meshgrid(np.arange(start, min(start + 128, len(group))), np.arange(len(group)), indexing="ij")
            upper = a < b
            yield a[upper], b[upper]
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for start in range(0, len(left), 128):
            a, b = np.meshgrid(left[start : start + 128], right, indexing="ij")
            yield a.ravel(), b.ravel()


def _plausible(threshold: float) -> int:
    mean = COORDINATES * threshold
    return max(1, math.floor(mean - PLAUSIBLE_SIGMAS * math.sqrt(mean * (1 - threshold))))


def _active(threshold: float):
    least = _plausible(threshold)

    def search(group: list[dict]) -> list[dict]:
        if len(group) < 2:
            return []
        drawn = np.frombuffer(b"".join(row["sketch"] for row in group), np.uint32)
        drawn = drawn.reshape(len(group), COORDINATES)
        size = np.array([row["size"] for row in group], float)
        rule = _Rule.of(group)
        active = np.zeros(len(group), bool)
        for a, b in _pairs(group):
            near = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9
            a, b = a[near], b[near]
            for start in range(0, len(a), 1 << 15):
                x, y = a[start : start + (1 << 15)], b[start : start + (1 << 15)]
                alike = (drawn[x] == drawn[y]).sum(axis=1) >= least
                x, y = x[alike], y[alike]
                counted = rule.here(x, y)
                active[x[counted]] = active[y[counted]] = True
        names = ("digest", "leaf", "i", "j", "side")
        return [{k: group[n][k] for k in names} for n in np.flatnonzero(active)]

    return search


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sorted sets share."""
    n = len(sets)
    shared = np.zeros((n, n), np.float32)
    if n == 2:
        shared[0, 1] = shared[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
        return shared
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, column = owner[common], column[common]
    dense = np.cumsum(times > 1) - 1
    column = dense[column]
    for start in range(0, int((times > 1).sum()), 4096):
        here = (column >= start) & (column < start + 4096)
        table = np.zeros((n, min(4096, int((times > 1).sum()) - start)), np.float32)
        table[owner[here], column[here] - start] = 1
        shared += table @ table.T
    return shared


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [top(x) for x in range(n)]


def _verify(threshold: float):
    part = Fraction(threshold).limit_denominator(10_000)
    p, q = part.numerator, part.denominator

    def search(group: list[dict]) -> list[dict]:
        if len(group) < 2:
            return []
        sets = [np.frombuffer(row["grams"], np.uint64) for row in group]
        shared = np.rint(intersections(sets)).astype(np.int64)
        size = np.array([len(s) for s in sets], np.int64)
        copies = np.array([row["copies"] for row in group], np.int64)
        rule = _Rule.of(group)
        links = np.zeros(len(group), np.int64)
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in _pairs(group):
            alike = shared[a, b] * (p + q) >= p * (size[a] + size[b])
            a, b = a[alike], b[alike]
            counted = rule.here(a, b)
            a, b = a[counted], b[counted]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            ends.append((a, b))
        roots = _roots(len(group), *(np.concatenate(x) for x in zip(*ends, strict=True)))
        return [
            {"digest": group[n]["digest"], "root": group[roots[n]]["digest"], "links": int(links[n])}
            for n in np.flatnonzero(links)
        ]

    return search


def _with_grams(docs: DataFrame, active: DataFrame, words: int) -> DataFrame:
    """The rows of ``active`` (digest, doc_id, text_key, places), each place with the set of its document."""
    texts = docs.select(
        F.col("doc_id"), _text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Repeated rows arrive once from each task, and once in each group.
    texts = without_repeats(texts, ["doc_id", "text_key"])
    wanted = active.withColumnRenamed("doc_id", "rep_id")
    met = texts.join(
        wanted, texts["doc_id"].eqNullSafe(wanted["rep_id"]) & (texts["text_key"] == wanted["text_key"])
    ).select("text", "digest", "copies", "leaves", "places")

    def rows(slice_: list[dict]) -> list[dict]:
        made = []
        for row in slice_:
            found = grams(row["text"], words).tobytes()
            if xxhash.xxh3_128_digest(found) == row["digest"]:
                shared = {"digest": row["digest"], "copies": row["copies"], "leaves": row["leaves"]}
                made += [place | shared | {"grams": found} for place in row["places"]]
        return made

    return map_rows(
        met,
        rows,
        "leaf bigint, i int, j int, side int, digest binary, copies bigint, leaves array<bigint>, grams binary",
    )


def classes(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """doc_id, text_key, class_id, class_key, copy_id, n_copies and n_links for each row of ``docs`` (doc_id, text).

    ``copy_id`` is the smallest doc_id of the documents with the same set of n-grams, n_copies their number. ``class_id``
    is the smallest doc_id of all documents that links (Jaccard ``threshold`` or more) connect, and n_links the
    number of other documents linked to this one, copies included; ``class_key`` names the class where ids repeat. Documents without words (null or empty texts
    among them) are copies of each other and link to nothing else. Repeated rows count as further copies.
    A null doc_id is the smallest. Other columns are not read.
    """
    runs = runs_for(threshold, recall)
    drawn = scratch.written(sketches(docs, words), "sketches")
    reps = drawn.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"),
        F.count(F.lit(1)).alias("copies"),
        F.first("size").alias("size"),
        F.first("sketch").alias("sketch"),
    )
    reps = scratch.written(reps, "representatives")
    useful = _useful(leaves(reps, runs), runs)
    searched = _blocked(useful.join(reps.select("digest", "size", "sketch"), "digest"))
    active = map_groups(
        searched,
        ["leaf", "i", "j"],
        _active(threshold),
        "digest binary, leaf bigint, i int, j int, side int",
    )
    active = scratch.written(active, "active")
    places = active.groupBy("digest").agg(
        F.collect_list(F.struct("leaf", "i", "j", "side")).alias("places")
    )
    own_leaves = useful.groupBy("digest").agg(F.first("leaves").alias("leaves"))
    wanted = (
        places.join(own_leaves, "digest")
        .join(reps, "digest")
        .select("digest", "places", "leaves", "copies", "rep.doc_id", "rep.text_key")
    )
    linked = map_groups(
        _with_grams(docs, wanted, words),
        ["leaf", "i", "j"],
        _verify(threshold),
        "digest binary, root binary, links bigint",
        unique="digest",
    )
    linked = scratch.written(linked, "links")
    labels = components(linked.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("digest").agg(F.sum("links").alias("links"))
    named = (
        reps.join(labels.withColumnRenamed("node", "digest"), "digest", "left")
        .join(links, "digest", "left")
        .select(
            "digest",
            F.col("rep.doc_id").alias("copy_id"),
            F.coalesce("component", "digest").alias("component"),
            F.col("copies").alias("n_copies"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    named = scratch.written(named, "named")
    smallest = named.groupBy("component").agg(F.min(F.struct("copy_id")).alias("class"))
    # Written for the same reason as the kept leaves: a hot class can be split.
    smallest = scratch.written(smallest, "classes")
    return (
        drawn.select("doc_id", "text_key", "digest")
        .join(named.join(smallest, "component"), "digest")
        .select(
            "doc_id",
            "text_key",
            F.col("class.copy_id").alias("class_id"),
            F.hex("component").alias("class_key"),
            "copy_id",
            "n_copies",
            "n_links",
        )
    )


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one document of each class of ``classes``: that with the smallest doc_id, all columns as they are.

    Of rows alike in doc_id and text the one stays whose columns have the smallest hash, maps aside. Columns of any name come back.
    """
    found = classes(docs, **parameters)
    kept = found.groupBy("class_key").agg(F.min(F.struct("doc_id", "text_key")).alias("kept"))
    kept = scratch.written(
        kept.select(F.col("kept.doc_id").alias("__id"), F.col("kept.text_key").alias("__key")), "kept"
    )
    # Inside, the input's columns are called by number, and so clash with nothing.
    names = [name.lower() for name in docs.columns]
    numbered = docs.toDF(*(f"c{n}" for n in range(len(names))))
    own_id, own_text = (f"c{names.index(name)}" for name in ("doc_id", "text"))
    hashed = [f.name for f in numbered.schema if "map<" not in f.dataType.simpleString()]
    keyed = numbered.withColumns(
        {"__text_key": F.xxhash64(F.coalesce(own_text, F.lit(""))), "__row": F.xxhash64(*hashed)}
    )
    keyed = without_repeats(keyed, [own_id, "__text_key", "__row"])
    met = keyed.join(
        kept, keyed[own_id].eqNullSafe(kept["__id"]) & (keyed["__text_key"] == kept["__key"])
    )
    order = Window.partitionBy("__id", "__key").orderBy("__row")
    return (
        met.withColumn("__copy", F.row_number().over(order))
        .filter("__copy = 1")
        .select(*numbered.columns)
        .toDF(*docs.columns)
    )
