"""Whitening against numpy's dense eigenvectors of the exact covariance, and Python integers."""

import math

import numpy as np
import pytest

from adjudika.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n string, component string"


def run(spark, rows, parts=3, schema=SCHEMA, **settings):
    table = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], schema).repartition(parts)
    return whitening.whitened(table, **settings).collect()


def held_against_numpy(got, rows, expected=8):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    t = (x * n - sums).astype(np.float64) / n
    values, vectors = np.linalg.eigh(t.T @ t / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * expected and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, r)
    assert set(by) == set(range(1, expected + 1))
    place = {i: k for k, (i, _) in enumerate(rows)}
    for c, found in by.items():
        y = t @ vectors[:, c - 1] / np.sqrt(values[c - 1])
        z = np.array([r.whitened for r in found.values()])
        at = [place[i] for i in found]
        assert min(np.abs(y[at] - z).max(), np.abs(y[at] + z).max()) < 1e-7
        assert all(abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-10 and r.identity_error < 1e-9 for r in found.values())
    deviation = (x * n - sums)
    deviation = (deviation * deviation).sum(1)
    for r in got:
        exact = int(deviation[place[r.vec_id]])
        assert (r.deviation, r.deviation_digits) == ((exact, None) if exact < 1 << 63 else (None, str(exact)))


@pytest.mark.parametrize("width", [3, 8, 20, 40, 90])
def test_equals_dense(spark, width):
    rng = np.random.default_rng(width)
    base = rng.normal(0, 0.3, (300, width)) @ rng.normal(0, 1, (width, width))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    held_against_numpy(run(spark, rows), rows, min(width, 8))


def test_flat_spectrum_with_one_large_value(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.1, (2_000, 64))
    base[:, 0] *= 30
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    held_against_numpy(run(spark, rows), rows)


def test_iteration_filters_to_certified_pairs():
    rng = np.random.default_rng(0)
    turn, _ = np.linalg.qr(rng.standard_normal((200, 200)))
    values = np.concatenate([np.linspace(30, 20, 8), np.linspace(19.5, 1, 192)])
    dense = (turn * values) @ turn.T
    basis = whitening.leading(lambda q: (dense @ q, values.sum()), 200)
    assert np.abs(basis.values - values[:8]).max() < 1e-10 and basis.passes > 10
    assert np.abs(np.abs((basis.vectors * turn[:, :8]).sum(0)) - 1).max() < 1e-12


def test_dropped_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0, 1, 12)]) for i in range(50)]
    bad = [(100, None), (101, [None] * 12), (102, [float("nan")] + [0.0] * 11), (103, [float("inf")] + [0.0] * 11)]
    held_against_numpy(run(spark, rows + bad), rows)
    twice = run(spark, rows + rows[:1] * 30)
    assert sum(r.vec_id == 0 for r in twice) == 31 * 8


def test_deviation_beyond_a_long(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(0, 1, 2) * (3e6, 1e6)]) for i in range(40)]
    held_against_numpy(run(spark, rows, schema=SCHEMA.replace("float", "double")), rows, 2)


def test_nothing_to_whiten(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(1, [0.5, 0.25])]) == []
    assert run(spark, [(i, [0.5, 0.25]) for i in range(9)]) == []
    with pytest.raises(ValueError):
        run(spark, [(1, [0.0]), (2, [0.0, 1.0])])


def test_one_dimension_without_variance(spark):
    rows = [(i, [float(i % 7), 2.0, float(i % 3)]) for i in range(60)]
    got = run(spark, rows)
    assert {r.component for r in got} == {1, 2} and all(r.identity_error < 1e-9 for r in got)
