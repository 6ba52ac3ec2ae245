"""Groups of blocks: what a task holds and sends stays bounded, and results are those of all pairs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import boxes, cluster_scores, density, neighbors


def vectors(spark, x):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "vec": list(x)}))


def test_rough_distances_are_made_exact_near_a_limit():
    rng = np.random.default_rng(0)
    a = 1e6 + rng.integers(0, 3, (200, 5)).astype(float)
    exact = np.sqrt(boxes.square_distances(a, a))
    for radius in (0.0, 1.0, float(np.sqrt(2)), 2.0):
        i, j, d = boxes.near_pairs(a, a, radius)
        assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(exact <= radius)))
        assert (d == exact[i, j]).all()
    assert np.allclose(boxes.distances(a, a), exact, atol=1e-6) and (np.diag(boxes.distances(a, a)) == 0).all()
    b = a.copy()
    b[3, 2] = np.inf
    assert len(boxes.near_pairs(b[:3], b, 9.0)[0]) == 3 * 199


def test_a_row_is_sent_once_for_each_group_and_not_for_each_block(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1600, 6))
    blocked = vectors(spark, x).withColumn("block", F.floor(F.col("id") / 16))
    seen = boxes.block_join(blocked, blocked, boxes.every_pair(100, 100, spark), lambda l, rs: {"rows": np.array([sum(len(r["id"]) for r in rs)]), "blocks": np.array([len(l["id"])])},
                            "rows long, blocks long", lambda made: {"rows": np.array([made["rows"].max()]), "blocks": np.array([len(made["rows"])])}, rows=16).toPandas()
    assert len(seen) == boxes.LEAST_PARTS ** 2 and set(seen.rows) == {320} and set(seen.blocks) == {20}


@pytest.mark.parametrize("side_bytes", [1 << 14, 32 << 20])
def test_neighbours_and_densities_do_not_depend_on_the_groups(spark, monkeypatch, side_bytes):
    monkeypatch.setattr(boxes, "SIDE_BYTES", side_bytes)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(0, 4, (150, 3)).astype(float), rng.normal(size=(250, 3)), np.zeros((50, 3))])
    d = np.sqrt(boxes.square_distances(x, x))
    near = neighbors.knn_join(vectors(spark, x), vectors(spark, x), "id", "id", "vec", 4, exclude_self=True, block=16).toPandas()
    want = [(i, j, k + 1) for i in range(len(x)) for k, j in enumerate([j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:4])]
    assert sorted(zip(near.id, near.neighbor, near["rank"])) == sorted(want)
    labelled, _ = density.dbscan_grid(vectors(spark, x), "id", "vec", [0.4, 1.0], [4, 60], block=16)
    got = {r["id"]: list(r["labels"]) for r in labelled.collect()}
    for place, (eps, least) in enumerate([(0.4, 4), (0.4, 60), (1.0, 4), (1.0, 60)]):
        core = (d <= eps).sum(axis=1) >= least
        label = np.where(core, np.arange(len(x)), len(x))
        links = (d <= eps) & core[:, None] & core[None, :]
        while True:
            new = np.where(core, np.where(links, label[None, :], len(x)).min(axis=1), len(x))
            if (new == label).all():
                break
            label = new
        border = np.where((d <= eps) & core[None, :], label[None, :], len(x)).min(axis=1)
        final = np.where(core, label, border)
        assert [got[i][place] for i in range(len(x))] == [int(v) if v < len(x) else -1 for v in final]


@pytest.mark.parametrize("few", [64, 1])
def test_exact_silhouettes_are_those_of_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(cluster_scores, "FEW_LABELS", few)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(1500, 4)) * 50, np.full((700, 4), 1000.0)])
    labels = np.column_stack([np.arange(len(x)) % 3, np.where(np.arange(len(x)) < 1500, 0, 1)])
    points = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "vec": list(x), "labels": list(labels)}))
    got = {r["run"]: r["silhouette"] for r in cluster_scores.silhouette(points, None).collect()}
    d = np.sqrt(boxes.square_distances(x, x))
    for run in range(2):
        names, code, size = np.unique(labels[:, run], return_inverse=True, return_counts=True)
        sums = np.stack([d[:, code == c].sum(axis=1) for c in range(len(names))], axis=1)
        a = sums[np.arange(len(x)), code] / (size[code] - 1)
        means = sums / size
        means[np.arange(len(x)), code] = np.inf
        b = means.min(axis=1)
        assert abs(got[run] - float(((b - a) / np.maximum(a, b)).mean())) < 1e-8
