"""Nearest-neighbour mutual information against a plain computation on 2,000 rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import information


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def plain_class(x, label, k=3):
    used = [i for i in range(len(x)) if (label == label[i]).sum() > 1]
    x, label = x[used], label[used]
    terms = []
    for i in range(len(x)):
        d = np.abs(x - x[i])
        same = np.delete(d, i)[np.delete(label == label[i], i)]
        near = np.sort(same)[:k]
        r = near[-1]
        inside = (d < r).sum() if r > 0 else (d == 0).sum()
        terms.append(psi(len(near) if r > 0 else int(((d == 0) & (label == label[i])).sum())) - psi(int((label == label[i]).sum())) - psi(int(inside)))
    return max(0.0, psi(len(x)) + np.mean(terms)) if len(x) else 0.0


def plain_number(x, y, k=3):
    terms = []
    for i in range(len(x)):
        dx, dy = np.abs(x - x[i]), np.abs(y - y[i])
        d = np.maximum(dx, dy)
        r = np.sort(np.delete(d, i))[:k][-1]
        nx, ny = ((v < r).sum() if r > 0 else (v == 0).sum() for v in (dx, dy))
        terms.append(psi(k if r > 0 else int((d == 0).sum())) - psi(int(nx)) - psi(int(ny)))
    return max(0.0, psi(len(x)) + np.mean(terms))


def table(spark, n=2000):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 3, n)
    label[0] = 9  # a class of one row
    columns = {
        "normal": rng.normal(size=n) + label, "noise": rng.normal(size=n), "tenths": np.round(rng.normal(size=n) + 0.3 * label, 1),
        "flag": (rng.random(n) < 0.2 + 0.3 * (label == 1)).astype(float), "third": np.where(rng.random(n) < 0.34, 7.0, rng.normal(size=n)), "constant": np.full(n, 4.0)}
    y = columns["normal"] ** 2 + 0.1 * rng.normal(size=n)
    names = list(columns)
    rows = [(i, int(label[i]), float(y[i]), *[float(columns[c][i]) for c in names]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label int, y double, " + ", ".join(f"{c} double" for c in names)).repartition(8), columns, label, y


def test_class(spark):
    df, columns, label, _ = table(spark)
    got = {r.feature: r.mutual_info for r in information.mutual_information_class(df, list(columns), "label").collect()}
    for c, x in columns.items():
        assert got[c] == pytest.approx(plain_class(x, label), abs=1e-9), c
    assert got["normal"] > 0.2 and got["noise"] < 0.05


def test_number(spark):
    df, columns, _, y = table(spark)
    got = {r.feature: r.mutual_info for r in information.mutual_information_number(df, list(columns), "y").collect()}
    deviation = df.agg(*[F.stddev_pop(c).alias(c) for c in [*columns, "y"]]).first()  # its last bits decide ties
    y = y / deviation["y"]
    for c, x in columns.items():
        assert got[c] == pytest.approx(plain_number(x / deviation[c] if deviation[c] > 0 else x * 0, y), abs=1e-9), c
    assert got["normal"] > 0.5 and got["noise"] < 0.05


def test_digamma(spark):
    got = spark.range(1, 400).select("id", information.digamma(F.col("id")).alias("p")).collect()
    assert all(r.p == pytest.approx(psi(r.id), abs=1e-12) for r in got)


def test_strict_ends_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(r)) for x, r in zip(rng.normal(size=500) * 10.0 ** rng.integers(-3, 6, 500), np.abs(rng.normal(size=500)) * 10.0 ** rng.integers(-6, 4, 500))] + [(0.3, 0.1), (1.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, r double")
    for row in df.select("x", "r", information.strict_ends("x", "r").alias("e")).select("x", "r", "e.*").collect():
        for end, sign in ((row.low, -math.inf), (row.high, math.inf)):
            assert end != row.x and (abs(end - row.x) >= row.r)
            assert row.r == 0 or abs(np.nextafter(end, -sign) - row.x) < row.r


def test_nothing_to_score(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1, None)], "id long, label int, y double")
    assert [tuple(r) for r in information.mutual_information_class(df, ["y"], "label").collect()] == [("y", 0.0)]
    assert [tuple(r) for r in information.mutual_information_number(df.filter("id = 0"), ["label"], "y").collect()] == [("label", 0.0)]
