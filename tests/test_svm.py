"""The squared hinge SVM against its own optimality condition and a plain solver."""

from __future__ import annotations

import numpy as np
import pytest

from corpusloom.operators import svm

SCHEMA = "id int, y int, x struct<indices:array<int>,values:array<double>>"


def data(seed: int = 4, n: int = 120, d: int = 30):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        at = np.sort(rng.choice(d, rng.integers(0, 8), replace=False))
        rows.append((i, int(rng.random() < 0.3), (at.tolist(), rng.normal(size=len(at)).round(3).tolist())))
    return rows


def plain(rows, d, c, balanced, steps=200_000):
    """Gradient descent on the dense problem until nothing moves."""
    x = np.zeros((len(rows), d + 1))
    for r, (_, _, (at, v)) in enumerate(rows):
        x[r, at] = v
    x[:, d] = 1
    y = np.array([1.0 if r[1] == 1 else -1.0 for r in rows])
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) if balanced else np.ones(len(y))
    w, z = np.zeros(d + 1), np.zeros(d + 1)
    big = 1 + 2 * c * cost.max() * np.linalg.norm(x, 2) ** 2
    momentum = (np.sqrt(big) - 1) / (np.sqrt(big) + 1)
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z - (z - 2 * c * x.T @ (cost * y * slack)) / big
        z, moved, w = new + momentum * (new - w), np.abs(new - w).max(), new
        if moved < 1e-14:
            break
    return w, 0.5 * w @ w + c * (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()


@pytest.mark.parametrize("sample, chunk, c, weight", [(4096, 1 << 16, 10.0, "balanced"), (60, 7, 0.1, None), (1, 31, 0.01, "balanced")])
def test_fit_is_the_minimum(spark, monkeypatch, sample, chunk, c, weight):
    monkeypatch.setattr(svm, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(svm, "CHUNK", chunk)
    rows = data()
    df = spark.createDataFrame(rows + [(900, None, ([0], [5.0]))], SCHEMA).repartition(3)
    model = svm.fit_squared_hinge(df, "y", "x", 30, c, weight, tolerance=1e-9)
    want, objective = plain(rows, 30, c, weight == "balanced")
    assert np.allclose(model.weights + [model.intercept], want, atol=1e-8)
    assert abs(model.objective - objective) < 1e-8 and model.gradient_norm <= 1e-9


def test_prediction_and_saving(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 2, ([i % 2], [1.0])) for i in range(20)], SCHEMA)
    model = svm.fit_squared_hinge(df, "y", "x", 2, 1.0)
    assert all(r.prediction == r.y and (r.margin > 0) == (r.y == 1) for r in model.predict(df, "x").collect())
    model.save(spark, str(tmp_path / "m"))
    assert svm.LinearSVM.load(spark, str(tmp_path / "m")) == model


def test_degenerate_tables(spark):
    none = svm.fit_squared_hinge(spark.createDataFrame([], SCHEMA), "y", "x", 3)
    assert none.weights == [0.0] * 3 and none.intercept == 0 and none.objective == 0
    one = spark.createDataFrame([(1, 1, ([], [])), (2, 1, ([0], [0.0]))], SCHEMA)
    model = svm.fit_squared_hinge(one, "y", "x", 3, 1.0, "balanced", tolerance=1e-10)
    # Minimum of b^2 / 2 + 2 (1 - b)^2.
    assert abs(model.intercept - 0.8) < 1e-9 and model.weights == [0.0] * 3


def test_passes_do_not_grow_with_the_rows_beyond_the_small_sample(spark, monkeypatch):
    rng = np.random.default_rng(5)
    size = 60
    rows = []
    for _ in range(1500):
        indices = sorted(rng.choice(size, 8, replace=False).tolist())
        rows.append((int(rng.random() < 0.3 + 0.4 * (indices[0] < 3)), (indices, rng.random(8).tolist())))
    docs = spark.createDataFrame(rows, "pos int, f struct<indices: array<int>, values: array<double>>")
    monkeypatch.setattr(svm, "SAMPLE_ROWS", 30)
    model = svm.fit_squared_hinge(docs, "pos", "f", size, 100.0, "balanced", tolerance=1e-8)
    assert model.gradient_norm <= 1e-8
    assert model.passes <= 40


def test_square_of_all_rows_is_the_curvature_however_it_is_added_up(spark, monkeypatch):
    rng = np.random.default_rng(6)
    size, c = 600, 10.0
    rows = []
    for _ in range(2600):
        indices = sorted(rng.choice(size, 6, replace=False).tolist())
        rows.append((int(rng.random() < 0.3 + 0.4 * (indices[0] < 40)), (indices, rng.random(6).tolist())))
    docs = spark.createDataFrame(rows, "pos int, f struct<indices: array<int>, values: array<double>>").repartition(2)
    blocks = svm.packed(docs, "pos", "f")
    points = [np.zeros(size + 1), rng.normal(size=size + 1), rng.normal(size=size + 1)]
    for moved, merged in ((1 << 22, 1 << 22), (0, 0), (8000, 1 << 22)):
        monkeypatch.setattr(svm, "MOVED", moved)
        monkeypatch.setattr(svm, "MERGED", merged)
        monkeypatch.setattr(svm, "CHUNK", 1100)
        passes = svm.Passes(blocks, size + 1, c, (1.0, 2.0))
        near, v = svm.SquareCurvature(passes), rng.normal(size=size + 1)
        for w in points:
            assert np.allclose(near.at(w)(passes.curvature(w, v)), v, atol=1e-3)


def test_passes_stay_few_where_a_sample_would_differ_from_all_rows(spark, monkeypatch):
    """With as many features as a sample has rows, its curvature takes many products a step; that of all rows takes few."""
    rng = np.random.default_rng(7)
    size = 300
    rows = []
    for _ in range(1200):
        indices = sorted(rng.choice(size, 12, replace=False).tolist())
        rows.append((int(rng.random() < 0.2 + 0.5 * (indices[0] < 8)), (indices, rng.random(12).tolist())))
    docs = spark.createDataFrame(rows, "pos int, f struct<indices: array<int>, values: array<double>>")
    monkeypatch.setattr(svm, "SAMPLE_ROWS", 300)
    monkeypatch.setattr(svm, "SQUARE_ROWS", 700, raising=False)  # the rows of the sample before
    model = svm.fit_squared_hinge(docs, "pos", "f", size, 100.0, "balanced", tolerance=1e-8)
    assert model.gradient_norm <= 1e-8
    assert model.passes <= 50


def test_a_square_that_no_rounding_explains_raises(spark):
    rows = [(int(i % 3 == 0), ([i % 5], [1.0])) for i in range(40)]
    docs = spark.createDataFrame(rows, "pos int, f struct<indices: array<int>, values: array<double>>")
    near = svm.SquareCurvature(svm.Passes(svm.packed(docs, "pos", "f"), 6, 1.0, (1.0, 1.0)))
    near.triangle.stripes[0][0, 0] = -1e9
    with pytest.raises(np.linalg.LinAlgError):
        near.at(np.zeros(6))
