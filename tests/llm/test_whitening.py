"""Whitening against numpy over the distinct vectors."""

import math

import numpy as np
import pytest

from feedback_engine.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x int, k1 string, whitened int"


def slow(rows, components=4):
    """Rows by (id, component) of one dimension; the sign of a component is left to the caller."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in usable]
    fit = sorted(set(v for _, v in whole))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    x = np.array([[c - s / n for c, s in zip(v, sums)] for v in fit])
    covariance = x.T @ x / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    made = []
    for i, v in whole:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        centred = np.array([c - s / n for c, s in zip(v, sums)])
        for k in range(min(components, len(v))):
            made.append((i, k + 1, n, deviation, centred @ axes[:, k] / math.sqrt(values[k]), values[k] / np.trace(covariance)))
    return sorted(made, key=lambda r: (r[0], r[1], r[3]))


def run(spark, rows):
    docs = spark.createDataFrame([(*row, 1, "k", 2) for row in rows], SCHEMA)
    made = whitening.by_component(whitening.whiten(docs))
    assert made.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return sorted(map(tuple, made.collect()), key=lambda r: (r[0], r[1], r[3]))


def compare(got, expected):
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    for k in sorted({r[1] for r in got}):
        a = np.array([r[4] for r in got if r[1] == k])
        b = np.array([r[4] for r in expected if r[1] == k])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    assert max(r[6] for r in got) < 1e-9 and len({r[6] for r in got}) == 1


@pytest.mark.parametrize("numbers", [1 << 18, 40])
def test_equals_numpy(spark, monkeypatch, numbers):
    """With blocks of few rows too, so that many blocks are multiplied."""
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", numbers)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 3)
    rng = np.random.default_rng(3)
    vectors = (rng.normal(0, 1, (300, 7)) * np.arange(1, 8) + 5).tolist()
    rows = [*enumerate(vectors), *[(1000 + k, vectors[0]) for k in range(50)], (0, vectors[1])]
    odd = [(5000, None), (5001, []), (5002, [1.0, None, *[0.0] * 5]), (5003, [math.nan] * 7), (5004, [math.inf, *[0.0] * 6])]
    compare(run(spark, rows + odd), slow(rows))


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    made = whitening.by_component(whitening.whiten(docs)).collect()
    compare(sorted(map(tuple, made), key=lambda r: (r[0], r[1], r[3])), slow(rows))


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [])]) == []
    # One fitted vector has no variance: nothing is whitened.
    alone = run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [r[:6] for r in alone] == [(i, k, 1, 0, None, None) for i in (1, 2) for k in (1, 2)]
    # Points on a line: one component.
    line = run(spark, [(1, [0.0, 0.001]), (2, [1.0, 0.001]), (3, [0.5, -0.0])])
    assert [r[2:5:2] for r in line if r[1] == 2] == [(3, None)] * 3
    assert all(abs(abs(r[4]) - w) < 1e-12 for r, w in zip([r for r in line if r[1] == 1], [1.5**0.5, 1.5**0.5, 0.0]))
    # Each dimension is fitted on its own.
    mixed = run(spark, [(1, [0.0]), (2, [1.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (5, [2.0, 2.0])])
    assert [(r[0], r[1], r[2]) for r in mixed] == [(1, 1, 2), (2, 1, 2), *[(i, k, 3) for i in (3, 4, 5) for k in (1, 2)]]
    # Entries too large for a long leave; a deviation too large for one is null.
    large = run(spark, [(1, [1e300]), (2, [1e12]), (3, [0.0])])
    assert [(r[0], r[2], r[3]) for r in large] == [(2, 2, None), (3, 2, None)]
