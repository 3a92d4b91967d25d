"""Largest inner products by robust-pruned directed graphs, one for each shard.

Vectors are lengthened by one component so that all of a shard have the same norm: the nearest in distance is then
the one with the largest inner product. A shard's graph is built in batches that double in size: greedy beam
searches in the graph so far propose neighbours, and relaxed pruning keeps a neighbour only if no kept one is
nearer to it by the factor ALPHA, which leaves short and long edges in diverse directions. A query searches every shard
by a beam, and the shards' best are merged by their exact inner products. Queries travel in blocks, to tasks that hold one graph at a time.

Equal vectors are one node with the ids that can matter: the k + 1 smallest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from clickloom.llm.arrow import importable, map_groups
from clickloom.sinks import scratch

#: Vectors in a shard, on average.
SHARD = 8192
#: Edges of a node, beam widths while building and searching, nodes a beam expands at a time.
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
WIDTH = 4
#: Factor of relaxed pruning.
ALPHA = 1.2
#: Nodes linked at a time at most, and queries in a block.
BATCH = 256
QUERIES = 256


@dataclass
class Graph:
    """Lengthened vectors, neighbours of each node (-1 for none), and where searches start."""

    vectors: np.ndarray
    neighbours: np.ndarray
    start: int

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Node numbers (-1 for none) and squared distances of the beams at the end, nearest first."""
        n, m = len(queries), len(self.vectors)
        seen = np.zeros((n, m + 1), bool)
        seen[:, m] = True  # the place of -1
        ids = np.full((n, beam), -1, np.int64)
        far = np.full((n, beam), np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        ids[:, 0] = self.start
        far[:, 0] = ((queries - self.vectors[self.start]) ** 2).sum(1)
        open_[:, 0] = True
        seen[:, self.start] = True
        active = np.arange(n)
        while len(active):
            waiting = np.where(open_[active], far[active], np.inf)
            width = min(WIDTH, beam)
            near = np.argpartition(waiting, width - 1, axis=1)[:, :width]
            chosen = np.take_along_axis(waiting, near, 1) < np.inf
            some = chosen.any(1)
            active, near, chosen = active[some], near[some], chosen[some]
            if not len(active):
                break
            nodes = np.where(chosen, ids[active[:, None], near], -1)
            open_[active[:, None], near] = False
            found = np.where(nodes[:, :, None] >= 0, self.neighbours[nodes], -1).reshape(len(active), -1)
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found[seen[active[:, None], found]] = -1
            seen[active[:, None], found] = True
            row, column = np.nonzero(found >= 0)
            distance = np.full(found.shape, np.inf, np.float32)
            step = queries[active[row]] - self.vectors[found[row, column]]
            distance[row, column] = np.einsum("ij,ij->i", step, step)
            every = np.concatenate([far[active], distance], 1)
            best = np.argpartition(every, beam - 1, axis=1)[:, :beam]
            far[active] = np.take_along_axis(every, best, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], found], 1), best, 1)
            fresh = np.concatenate([open_[active], found >= 0], 1)
            open_[active] = np.take_along_axis(fresh, best, 1)
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, 1)
        return np.where(far < np.inf, np.take_along_axis(ids, order, 1), -1), far


def prune(vectors: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours for ``nodes`` from ``proposed`` (a row each, -1 for none): the nearest first, and of the rest those
    to which no kept one is nearer by ALPHA."""
    proposed = np.sort(np.where(proposed == nodes[:, None], -1, proposed), axis=1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
    points = vectors[proposed]
    own = ((points - vectors[nodes][:, None]) ** 2).sum(2)
    own[proposed < 0] = np.inf
    norms = (points**2).sum(2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    kept = np.full((len(nodes), degree), -1, np.int64)
    row = np.arange(len(nodes))
    left = own.copy()
    for place in range(degree):
        best = left.argmin(1)
        there = left[row, best] < np.inf
        if not there.any():
            break
        kept[there, place] = proposed[row, best][there]
        covered = ALPHA**2 * between[row, best] <= own
        left[covered | ~there[:, None]] = np.inf
        left[row, best] = np.inf
    return kept


def lengthened(vectors: np.ndarray) -> np.ndarray:
    norms = (vectors**2).sum(1)
    rest = np.sqrt(np.maximum(norms.max() - norms, 0))
    return np.hstack([vectors, rest[:, None]]).astype(np.float32)


def build(vectors: np.ndarray) -> Graph:
    """The graph of the rows of ``vectors``, in double precision."""
    points = lengthened(vectors)
    n = len(points)
    start = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    graph = Graph(points, np.full((n + 1, DEGREE), -1, np.int64), start)
    order = np.random.default_rng(1).permutation(n)
    order = order[order != start]
    place = 0
    while place < len(order):
        batch = order[place : place + min(BATCH, place + 1)]
        place += len(batch)
        ids, _ = graph.search(points[batch], BUILD_BEAM)
        if len(batch) > 1:
            # Nodes of a batch do not see each other in the graph yet.
            step = points[batch][:, None] - points[batch][None]
            alike = np.argsort((step**2).sum(2), axis=1)[:, : DEGREE // 2]
            ids = np.concatenate([ids, batch[alike]], 1)
        graph.neighbours[batch] = prune(points, batch, ids, DEGREE)
        _link_back(graph, batch)
    return graph


def _link_back(graph: Graph, batch: np.ndarray) -> None:
    """Edges into ``batch`` from the nodes it now points to; full nodes are pruned again."""
    targets = graph.neighbours[batch]
    source = np.repeat(batch, DEGREE)[targets.ravel() >= 0]
    targets = targets.ravel()[targets.ravel() >= 0]
    by_target = np.argsort(targets, kind="stable")
    targets, source = targets[by_target], source[by_target]
    nodes, first, times = np.unique(targets, return_index=True, return_counts=True)
    if not len(nodes):
        return
    number = np.arange(len(targets)) - np.repeat(first, times)
    added = np.full((len(nodes), int(times.max())), -1, np.int64)
    added[np.repeat(np.arange(len(nodes)), times), number] = source
    merged = np.concatenate([graph.neighbours[nodes], added], 1)
    merged = -np.sort(-merged, axis=1)  # the empty places last
    merged[:, 1:][merged[:, 1:] == merged[:, :-1]] = -1
    full = (merged >= 0).sum(1) > DEGREE
    simple = -np.sort(-merged[~full], axis=1)[:, :DEGREE]
    graph.neighbours[nodes[~full], : simple.shape[1]] = simple
    for begin in range(0, int(full.sum()), BATCH):
        chosen = np.flatnonzero(full)[begin : begin + BATCH]
        graph.neighbours[nodes[chosen]] = prune(graph.vectors, nodes[chosen], merged[chosen], DEGREE)


def valid(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and the vector in double precision of the rows that take part."""
    inside: Column = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select("vec_id", F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .filter(inside & F.exists("v", lambda x: x != 0))
    )


def index(vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    """A written table of graphs, a row for each shard and dimension; and the number of shards.

    Columns: dim, shard, n, vectors (doubles), neighbours (32-bit), start, ids (the k + 1 smallest vec_ids of each node).
    """
    by_id = Window.partitionBy("v").orderBy("vec_id")
    distinct = (
        vectors.distinct()
        .withColumn("number", F.row_number().over(by_id))
        .filter(F.col("number") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    distinct = scratch.written(distinct, "vectors")
    shards = max(1, -(-distinct.count() // SHARD))
    dealt = distinct.withColumn("dim", F.size("v")).withColumn(
        "shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int")
    )

    def graphs(group: list[dict]) -> list[dict]:
        group.sort(key=lambda row: row["ids"][0])
        points = np.array([row["v"] for row in group])
        graph = build(points)
        return [
            {
                "dim": group[0]["dim"],
                "shard": group[0]["shard"],
                "n": len(group),
                "vectors": points.tobytes(),
                "neighbours": graph.neighbours.astype("i4").tobytes(),
                "start": graph.start,
                "ids": [row["ids"] for row in group],
            }
        ]

    made = map_groups(
        dealt,
        ["dim", "shard"],
        graphs,
        "dim int, shard int, n int, vectors binary, neighbours binary, start int, ids array<array<bigint>>",
    )
    return scratch.written(made, "graphs"), shards


def _visits(queries: DataFrame, graphs: DataFrame, shards: int) -> DataFrame:
    """Graphs and blocks of about QUERIES queries, laid out so that a task meets each graph once, and after it its blocks.

    Where there are fewer shards than tasks, a shard's blocks are dealt over several, each with a copy of the graph.
    """
    spark = queries.sparkSession
    slices = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    blocks = max(1, -(-queries.count() // QUERIES))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = (
        queries.withColumn("dim", F.size("v"))
        .groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
        .withColumn("slice", F.pmod("block", F.lit(slices)))
        .withColumn("shard", each(shards))
    )
    held = graphs.withColumn("slice", each(slices)).withColumn("block", F.lit(-1))
    both = held.unionByName(asked, allowMissingColumns=True)
    keys = ["dim", "shard", "slice"]
    return both.repartition(*keys).sortWithinPartitions(*keys, "block")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each of ``queries`` the k largest inner products found.

    Both tables have vec_id and embedding. Rows with a null vec_id, and vectors that are null or zero or hold a null or a
    non-finite component, take no part. Vectors of different lengths are never compared. A query's own vec_id is no candidate;
    repeated rows are one. Of several vectors of one query id the smallest, compared number by number, is searched for; as
    candidates all of them count. Equal scores are ordered by vec_id. The score is the inner product in double precision.
    """
    graphs, shards = index(valid(vectors), k)
    asked = scratch.written(valid(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    schema = T.StructType.fromDDL("query_id bigint, vec_id bigint, score double")
    target = to_arrow_schema(schema)

    def search(row: dict, graph: Graph, points: np.ndarray, ids: list[list[int]]) -> list[dict]:
        made = []
        wanted = np.array([q["v"] for q in row["queries"]])
        flat = np.hstack([wanted, np.zeros((len(wanted), 1))]).astype(np.float32)
        found, _ = graph.search(flat, min(len(points), max(beam, k + 1)))
        for q, vector, nodes in zip(row["queries"], wanted, found, strict=True):
            nodes = nodes[nodes >= 0]
            scores = (points[nodes] * vector).sum(1)
            best = [
                (-score, number)
                for node, score in zip(nodes.tolist(), scores.tolist(), strict=True)
                for number in ids[node]
                if number != q["vec_id"]
            ]
            best.sort()
            made += [{"query_id": q["vec_id"], "vec_id": number, "score": -score} for score, number in best[:k]]
        return made

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in given:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                place = row["dim"], row["shard"], row["slice"]
                if row["block"] < 0:
                    points = np.frombuffer(row["vectors"]).reshape(row["n"], row["dim"])
                    neighbours = np.frombuffer(row["neighbours"], "i4").astype(np.int64).reshape(-1, DEGREE)
                    held = place, Graph(lengthened(points), neighbours, row["start"]), points, row["ids"]
                # A shard may hold no vector of a query's length.
                elif held is not None and held[0] == place and (made := search(row, *held[1:])):
                    yield pa.RecordBatch.from_pylist(made, schema=target)

    importable(vectors.sparkSession)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        _visits(asked, graphs, shards)
        .mapInArrow(batches, schema)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
