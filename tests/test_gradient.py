"""Squared-hinge machines, sigmoids and perceptrons against direct solutions and planted data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import gradient


def frame(spark, x, y, part=None):
    rows = [(i, float(y[i]), int(part[i]) if part is not None else 0, *map(float, x[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, y double, part int, " + ", ".join(f"f{j} double" for j in range(x.shape[1]))).repartition(5)


def direct_machine(x, y, c):
    """Newton steps on the whole problem, in one place."""
    x, sign, w = np.column_stack([x, np.ones(len(x))]), np.where(y == 1, 1.0, -1.0), np.zeros(x.shape[1] + 1)
    for _ in range(200):
        gap = np.maximum(0, 1 - sign * (x @ w))
        slope = w - 2 * c * (gap * sign) @ x
        if np.abs(slope).max() < 1e-10:
            break
        active = x[gap > 0]
        step, t = np.linalg.solve(np.eye(len(w)) + 2 * c * active.T @ active, slope), 1.0
        loss = 0.5 * w @ w + c * (gap**2).sum()
        while 0.5 * (w - t * step) @ (w - t * step) + c * (np.maximum(0, 1 - sign * (x @ (w - t * step))) ** 2).sum() > loss and t > 1e-9:
            t /= 2
        w = w - t * step
    return w


def test_squared_hinge_equals_a_direct_solution(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 6))
    y = (x @ rng.normal(size=6) + rng.normal(size=1000) > 0.4).astype(int)
    part = rng.integers(0, 3, 1000)
    names = [f"f{j}" for j in range(6)]
    df = frame(spark, x, y, part)
    assert gradient.squared_hinge(df, names, "y", 1.0)[0] == pytest.approx(direct_machine(x, y, 1.0), abs=1e-6)
    machines = gradient.squared_hinge(df, names, "y", 0.3, F.col("part"), 3)
    for i in range(3):
        assert machines[i] == pytest.approx(direct_machine(x[part != i], y[part != i], 0.3), abs=1e-6)


def test_sigmoids(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(800, 1))
    y, which = (rng.random(800) < 1 / (1 + np.exp(-(2 * m[:, 0] - 0.5)))).astype(int), np.arange(800) % 2
    curves = gradient.sigmoids(frame(spark, m, y, which), F.col("f0"), "y", F.col("part"), 2)
    for i in range(2):
        z, t = m[which == i, 0], y[which == i]
        wanted = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
        p = 1 / (1 + np.exp(-(curves[i, 0] * z + curves[i, 1])))
        assert abs(((p - wanted) * z).sum()) < 1e-6 and abs((p - wanted).sum()) < 1e-6
    one_class = gradient.sigmoids(frame(spark, m, np.ones(800)), F.col("f0"), "y", F.col("part"), 1)
    assert np.isfinite(one_class).all()


def test_perceptron_learns_parity_and_stops_on_noise(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (2000, 3))
    parity = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)
    names = ["f0", "f1", "f2"]
    df = frame(spark, x, parity)
    model = gradient.fit_perceptron(df, names, "y", [32, 16], passes=150)
    right = df.select(((model.score(names) > 0.5).cast("int") == F.col("y")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.93
    noise = gradient.fit_perceptron(frame(spark, x, rng.integers(0, 2, 2000)), names, "y", [32, 16], passes=120)
    assert noise.passes < 60


def test_gradients_equal_differences():
    rng = np.random.default_rng(4)
    layers = gradient.Layers((3, 5, 4, 1))
    w, x, y = layers.start(1), rng.normal(size=(7, 3)), rng.integers(0, 2, 7).astype(float)
    _, slope = layers.gradient(w, x, y)
    for i in rng.integers(0, len(w), 25):
        up, down = w.copy(), w.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert slope[i] == pytest.approx((layers.gradient(up, x, y)[0] - layers.gradient(down, x, y)[0]) / 2e-6, abs=1e-5)


def test_hardly_any_rows(spark):
    model = gradient.fit_perceptron(frame(spark, np.zeros((1, 2)), np.ones(1)), ["f0", "f1"], "y", [3], passes=5)
    assert np.isfinite(model.weights).all()
    assert np.isfinite(gradient.squared_hinge(frame(spark, np.zeros((2, 2)), np.array([0, 1])), ["f0", "f1"], "y", 1.0)).all()
