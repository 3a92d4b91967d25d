"""Whitening of embeddings on principal components found by contour integration (FEAST).

Entries become whole numbers, so the fit list (each distinct vector once), its sums and every vector's centred place are exact.
The covariance is summed in tasks; only its d x d entries reach the driver. There the eigenvalues are
cut into intervals that hold a few each, by inertia counts: an LDL' factorisation of the shifted covariance has as many negative
pivots as there are eigenvalues below the shift. For each interval a quadrature over a circle around it, one solve of the complex shifted
covariance for each node, projects a random block onto the eigenvectors inside; Rayleigh-Ritz extracts
them, and this repeats until residuals vanish and as many are found as the counts say.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm.arrow import importable
from clickloom.sinks import scratch

COMPONENTS = 16
#: x = floor(SCALE * entry) + SHIFT.
SCALE = 64
SHIFT = 1_000_000
#: Nodes on half a circle, eigenvalues sought in one interval unless they lie together, repetitions at most.
NODES = 8
TOGETHER = 8
REPEATS = 60
#: Components with less than this part of the whole variance are rounding noise and left out.
LEAST = 1e-12
#: Residual, in parts of the largest eigenvalue, at which an eigenvector is found.
RESIDUAL = 1e-12


def negative_pivots(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix below ``shift``: negative pivots of an LDL' factorisation, pivots chosen by Bunch and Kaufman."""
    a = matrix - shift * np.eye(len(matrix))
    bound = (1 + np.sqrt(17)) / 8
    negative, i, n = 0, 0, len(a)
    while i < n:
        size = 1
        if i < n - 1:
            r = i + 1 + int(np.argmax(np.abs(a[i + 1 :, i])))
            largest = abs(a[r, i])
            if abs(a[i, i]) < bound * largest:
                row = np.abs(a[r, i:])
                row[r - i] = 0
                if abs(a[i, i]) * row.max() < bound * largest**2:
                    pivot = i
                    if abs(a[r, r]) < bound * row.max():
                        size, pivot = 2, i + 1
                    if pivot != r:
                        a[[pivot, r]] = a[[r, pivot]]
                        a[:, [pivot, r]] = a[:, [r, pivot]]
        j = i + size
        block = a[i:j, i:j]
        if size == 1:
            negative += int(block[0, 0] < 0)
            solved = a[i:j, j:] / block[0, 0] if block[0, 0] else np.zeros_like(a[i:j, j:])
        else:
            # Chosen so that its determinant is negative: one pivot of each sign.
            negative += 1
            solved = np.linalg.solve(block, a[i:j, j:])
        a[j:, j:] -= a[j:, i:j] @ solved
        i = j
    return negative


def _cut(below: Callable[[float], int], low: float, high: float) -> float:
    """A place between ``low`` and ``high``, near the middle, with no eigenvalue close by."""
    margin = (high - low) * 1e-3
    for part in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
        place = low + part * (high - low)
        if below(place - margin) == below(place + margin):
            break
    return place


def _intervals(below: Callable[[float], int], low: float, high: float) -> list[tuple[float, float, int]]:
    """(from, to, eigenvalues) that cover ``low`` to ``high``; more than TOGETHER only where no cut parts them."""
    found, waiting, least = [], [(low, high)], high * 1e-10
    while waiting:
        a, b = waiting.pop()
        n = below(b) - below(a)
        if n > TOGETHER and b - a > least:
            place = _cut(below, a, b)
            waiting += [(a, place), (place, b)]
        elif n:
            found.append((a, b, n))
    return found


def _inside(matrix: np.ndarray, low: float, high: float, n: int, scale: float) -> np.ndarray:
    """The ``n`` eigenvectors whose eigenvalues lie between ``low`` and ``high``."""
    d = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = -np.pi / 2 * (nodes - 1)
    middle, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * angles)
    width = min(d, n + n // 2 + 4)
    rng = np.random.default_rng(0)
    block = rng.standard_normal((d, width))
    for repeat in range(REPEATS):
        if width < d:
            projected = np.zeros((d, block.shape[1]))
            for turn, weight in zip(turns, weights, strict=True):
                shifted = (middle + radius * turn) * np.eye(d) - matrix
                projected += weight / 4 * (radius * turn * np.linalg.solve(shifted, block.astype(complex))).real
            basis, _ = np.linalg.qr(projected)
        else:
            basis = np.eye(d)
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ small
        residual = np.linalg.norm(matrix @ block - block * values, axis=0)
        mine = (values > low) & (values < high)
        done = mine & (residual <= RESIDUAL * scale)
        if done.sum() == n == mine.sum():
            return block[:, done]
        if repeat % 10 == 9 or width == d:
            # Slow: too little room, or eigenvalues too near the circle.
            if width == d:
                best = np.argsort(np.where(mine, residual, residual + scale))[:n]
                return block[:, best]
            width = min(d, 2 * width)
            block = np.hstack([block, rng.standard_normal((d, width - block.shape[1]))])
    raise RuntimeError(f"{n} eigenvalues between {low} and {high}, of which {done.sum()} were found")


def top_components(covariance: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns; their largest entry is positive.

    Fewer if the matrix has fewer above the noise. Raises if the inertia counts and what was found do not agree.
    """
    d = len(covariance)
    trace = float(np.trace(covariance))
    nothing = np.zeros(0), np.zeros((d, 0))
    if not trace > 0:
        return nothing
    matrix = (covariance + covariance.T) / (2 * trace)
    counts: dict[float, int] = {}

    def below(place: float) -> int:
        if place not in counts:
            counts[place] = negative_pivots(matrix, place)
        return counts[place]

    high = float(np.abs(matrix).sum(1).max()) * (1 + 1e-9)
    low = LEAST
    wanted = min(k, d - below(low))
    if not wanted:
        return nothing
    # Cut off the rest: the highest place above which ``wanted`` are left, or more if they are equal.
    top = high
    while d - below(low) > wanted and top - low > high * 1e-10:
        place = (low + top) / 2
        if d - below(place) >= wanted:
            low = place
        else:
            top = place
    if d - below(low) == wanted and low > LEAST:
        # In the middle of the gap below the last wanted one, as far as it is free.
        under = LEAST
        for _ in range(20):
            place = (under + low) / 2
            if d - below(place) == wanted:
                low = place
            else:
                under = place
        edge = low
        while top - edge > high * 1e-10 and d - below((edge + top) / 2) >= wanted:
            edge = (edge + top) / 2
        low = (low + edge) / 2
    scale = high
    found = [_inside(matrix, a, b, n, scale) for a, b, n in _intervals(below, low, high)]
    basis, _ = np.linalg.qr(np.hstack(found))
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    if len(values) < wanted:
        raise RuntimeError(f"{wanted} components wanted, {len(values)} found")
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = basis @ small[:, order]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), 0), np.arange(wanted)])
    return values[order] * trace, vectors * signs


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vectors`` with the whole-number vector ``__x``, without the rows that take no part.

    Those are null and empty vectors, vectors with null or non-finite entries, or with entries so large that no long holds them, and
    vectors of another length than most have (of equally frequent lengths, the longest counts).
    """
    scaled = F.transform(column, lambda c: c.cast("double") * SCALE)
    fits = F.forall(scaled, lambda c: c.isNotNull() & (F.abs(c) < 2.0**62))
    rows = vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0)).filter(F.coalesce(fits, F.lit(False)))
    sizes = rows.groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    x = F.transform(scaled, lambda c: F.floor(c).cast("bigint") + SHIFT)
    return rows.filter(F.size(column) == (common["d"] if common else 0)).withColumn("__x", x)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _exact(x: np.ndarray, factor: int = 1) -> np.ndarray:
    """``x``, as Python's numbers if products or sums with ``factor`` could leave 64 bits."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return x if most * max(factor, len(x), 1) < 1 << 61 else x.astype(object)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exactly."""
    wide = _exact(x, n)
    held = sums if wide.dtype == object or max(map(abs, sums), default=0) >= 1 << 61 else sums.astype(np.int64)
    return wide * n - held


def _sums(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of vectors and their exact sums."""
    schema = T.StructType.fromDDL("dim int, n bigint, s decimal(38,0)")
    target = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in given:
            x = _matrix(batch, d)
            n, total = n + len(x), total + _exact(x).sum(0)
        rows = [{"dim": i, "n": n, "s": Decimal(int(s))} for i, s in enumerate(total)]
        yield pa.RecordBatch.from_pylist(rows if n else [], schema=target)

    found = fit.mapInArrow(batches, schema).groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    sums, n = np.zeros(d, object), 0
    for row in found.collect():
        sums[row["dim"]], n = int(row["s"]), row["n"]
    return n, sums


def _moments(fit: DataFrame, d: int, project: Callable[[np.ndarray], np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the projected vectors and of their products, as k numbers and a k x k matrix."""
    schema = T.StructType.fromDDL("i int, j int, s double")
    target = to_arrow_schema(schema)
    upper = np.triu_indices(k)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in given:
            y = project(_matrix(batch, d))
            first, second = first + y.sum(0), second + y.T @ y
        i = np.append(upper[0], np.arange(k)).astype(np.int32)
        j = np.append(upper[1], np.full(k, -1)).astype(np.int32)
        s = np.append(second[upper], first)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(s)], schema=target)

    first, second = np.zeros(k), np.zeros((k, k))
    for row in fit.mapInArrow(batches, schema).groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        if row["j"] < 0:
            first[row["i"]] = row["s"]
        else:
            second[row["i"], row["j"]] = second[row["j"], row["i"]] = row["s"]
    return first, second


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """For each row that takes part (``whole_numbers``) and component: key, component, n, deviation, whitened, explained, identity_error.

    Repeated rows come back as often as they occur, but count once in the fit. If all vectors are equal, or there are none, there is no
    component and no row; likewise components without variance are missing. Equal eigenvalues may share their
    components in any way. A deviation that no long holds is null. Columns other than ``key`` and ``column`` are not read.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = whole_numbers(vectors.select(F.col(key).alias("key"), F.col(column).alias("__v")), "__v").select("key", "__x")
    fit = scratch.written(rows.select("__x").distinct(), "fit")
    schema = T.StructType.fromDDL(
        f"{key} {vectors.schema[key].dataType.simpleString()}, component int, n bigint, deviation bigint, "
        "whitened double, explained double, identity_error double"
    )
    some = fit.select(F.size("__x").alias("d")).first()
    if some is None:
        return spark.createDataFrame([], schema)
    d = some["d"]
    n, sums = _sums(fit, d)
    _, products = _moments(fit, d, lambda x: (_centred(x, n, sums) / n).astype(float), d)
    covariance = products / n
    values, components = top_components(covariance, k)
    found = len(values)
    if not found:
        return spark.createDataFrame([], schema)
    weights = components / np.sqrt(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        return (_centred(x, n, sums) / n).astype(float) @ weights

    first, second = _moments(fit, d, whitened, found)
    measured = second / n - np.outer(first / n, first / n)
    error = float(np.abs(measured - np.eye(found)).max())
    explained = values / np.trace(covariance)
    target = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x = _matrix(part, d)
                centred = _centred(x, n, sums)
                largest = max(abs(int(centred.max())), abs(int(centred.min())))
                wide = centred if largest**2 * d < 1 << 63 else centred.astype(object)
                deviation = [int(s) if s < 1 << 63 else None for s in (wide**2).sum(1)]
                m = len(x)
                each = np.repeat(np.arange(m), found)
                columns = [
                    part.column("key").take(pa.array(each)),
                    np.tile(np.arange(1, found + 1), m),
                    np.full(m * found, n),
                    pa.array(deviation, pa.int64()).take(pa.array(each)),
                    ((centred / n).astype(float) @ weights).ravel(),
                    np.tile(explained, m),
                    np.full(m * found, error),
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                        for c, f in zip(columns, target, strict=True)
                    ],
                    schema=target,
                )

    return rows.mapInArrow(batches, schema)
