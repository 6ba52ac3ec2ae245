"""The last merges of a linkage, on arrays: many clusters at once, as by one-at-a-time merging."""

import time

import numpy as np
import pyarrow as pa
import pytest

from tabforge.operators.agglomerative import Top
from test_agglomerative import compare, one_at_a_time


class Step:
    def __init__(self, a, b, height):
        self.a, self.b, self.height = a, b, height


def top_of(x, k, linkage):
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2) if len(x) < 2000 else None
    if d is not None:
        d = np.sqrt(d)
        pairs = sorted({(min(i, j), max(i, j)) for i in range(len(x)) for j in [j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:k]})
        a, b = np.array(pairs).T
        dist = d[a, b]
    else:  # a chain with some longer edges: neighbours in the order of the first dimension
        order = np.argsort(x[:, 0])
        a, b = (np.concatenate([order[:-s] if e else order[s:] for s in range(1, k)]) for e in (0, 1))
        dist = np.sqrt(((x[a] - x[b]) ** 2).sum(axis=1))
        a, b = np.minimum(a, b), np.maximum(a, b)
    cost = dist**2 / 2 if linkage == "ward" else dist
    clusters = pa.table({"id": np.arange(len(x)), "n": np.ones(len(x)), "total": list(x)})
    return Top(linkage, clusters, pa.table({"a": a, "b": b, "cost": cost, "links": np.ones(len(a))}), 0).run()


@pytest.mark.parametrize("linkage", ["ward", "complete", "average"])
def test_last_merges_are_those_of_one_at_a_time(linkage):
    x = np.random.default_rng(5).normal(size=(120, 2))
    rows = sorted(top_of(x, 12, linkage).to_pylist(), key=lambda r: (r["height"], r["round"], r["a"], r["b"]))
    compare([Step(r["a"], r["b"], r["height"]) for r in rows], one_at_a_time(x, 12, linkage))


@pytest.mark.parametrize("linkage", ["ward", "complete", "average"])
def test_many_last_clusters_take_seconds(linkage):
    x = np.random.default_rng(6).normal(size=(50_000, 5))
    began = time.perf_counter()
    assert top_of(x, 10, linkage).num_rows == len(x) - 1
    assert time.perf_counter() - began < 60
