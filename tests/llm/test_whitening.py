"""Whitening against a dense eigendecomposition, and exact whole numbers against Python's."""

import math

import numpy as np
import pytest

from clickloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def _expected(vectors):
    """n, sums, deviation of each vector, and the largest eigenvalues over the trace, from rows of numbers."""
    xs = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, xs)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for x in xs]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    values, components = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, xs, deviation, values[::-1], components[:, ::-1]


def _check(rows, keyed):
    keys = [key for key, _ in keyed]
    n, sums, xs, deviation, values, components = _expected([v for _, v in keyed])
    k = min(16, int((values > 1e-12 * values.sum()).sum()))
    assert len(rows) == k * len(keys)
    of = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(of) == len(rows)
    signs = {}
    for key, x, d in zip(keys, xs, deviation, strict=True):
        place = np.array([(n * c - s) / n for c, s in zip(x, sums, strict=True)])
        for i in range(k):
            row = of[key, i + 1]
            assert (row["n"], row["deviation"]) == (n, d)
            assert row["explained"] == pytest.approx(values[i] / values.sum(), rel=1e-9)
            assert row["identity_error"] < 1e-6
            wanted = place @ components[:, i] / math.sqrt(values[i])
            if abs(wanted) > 1e-3:
                signs.setdefault(i, np.sign(wanted * row["whitened"]))
            assert row["whitened"] * signs.get(i, 1) == pytest.approx(wanted, abs=1e-6)


def _frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def test_query_against_a_dense_decomposition(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    _check(queries.op12_whitening(spark, SF).collect(), [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in given])


def test_copies_count_once_and_rows_without_numbers_go(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(5).round(3).tolist()) for i in range(300)]
    good += [(1000 + i, good[0][1]) for i in range(200)]
    bad = [(1, None), (2, []), (3, [1.0, None, 1.0, 1.0, 1.0]), (4, [math.nan] * 5), (5, [math.inf] * 5), (6, [1e30] * 5)]
    bad += [(7, [1.0, 2.0])]
    rows = whitening.whiten(_frame(spark, good + [(10_000 + i, v) for i, v in bad], "double")).collect()
    _check(rows, good)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**40 * i), 1.0 - i]) for i in range(40)]
    found = whitening.whiten(_frame(spark, rows, "double")).collect()
    n, _, _, deviation, _, _ = _expected([v for _, v in rows])
    for row in found:
        d = deviation[row["vec_id"]]
        assert row["n"] == n and row["deviation"] == (d if d < 2**63 else None)


def test_nothing_to_whiten(spark):
    assert whitening.whiten(_frame(spark, [])).collect() == []
    assert whitening.whiten(_frame(spark, [(1, None)])).collect() == []
    assert whitening.whiten(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_other_columns_are_not_read(spark):
    from pyspark.sql import functions as F

    rows = _frame(spark, [(i, [float(i), float(i * i % 7)]) for i in range(20)]).withColumns(
        {"n": F.lit(1), "__x": F.lit("x"), "key": F.lit(2), "component": F.lit(0)}
    )
    assert whitening.whiten(rows).count() == 40


def _matrices():
    rng = np.random.default_rng(0)
    for d in (1, 2, 17, 48):
        a = rng.standard_normal((d, d))
        q = np.linalg.qr(a)[0]
        yield a @ a.T
        yield np.eye(d) * 7.5
        yield a[:, : max(1, d // 3)] @ a[:, : max(1, d // 3)].T
        yield np.diag(10.0 ** rng.uniform(-5, 5, d))
        yield q @ np.diag(rng.integers(1, 4, d).astype(float)) @ q.T


@pytest.mark.parametrize("matrix", list(_matrices()), ids=str)
def test_contours_find_all_the_largest(matrix):
    every = np.linalg.eigvalsh(matrix)[::-1]
    values, components = whitening.top_components(matrix)
    k = len(values)
    assert k == min(16, int((every > 1e-12 * every.sum()).sum()))
    np.testing.assert_allclose(values, every[:k], rtol=1e-9, atol=1e-13 * every[0])
    np.testing.assert_allclose(components.T @ components, np.eye(k), atol=1e-12)
    np.testing.assert_allclose(matrix @ components, components * values, atol=1e-10 * every[0])


def test_no_variance_has_no_components():
    values, components = whitening.top_components(np.zeros((4, 4)))
    assert values.shape == (0,) and components.shape == (4, 0)


def test_pivots_count_eigenvalues():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        every = np.linalg.eigvalsh(a)
        for shift in rng.uniform(every[0] - 1, every[-1] + 1, 10):
            assert whitening.negative_pivots(a, shift) == (every < shift).sum()
    assert whitening.negative_pivots(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
