"""Rules, metrics, neighbours and clusterings against hand values and brute force."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import cluster_scores as S
from tabforge.operators import clustering, components, density, evaluation, neighbors, ranking, rules


def test_market_rules(spark):
    sets = [["a", "b", "c"], ["a", "b", "c"], ["a", "b"], ["c"], []]
    baskets = spark.createDataFrame([(s,) for s in sets], "items array<string>")
    found = {tuple(r.items_): r.support for r in rules.frequent_itemsets(baskets, 0.2, 4).withColumnRenamed("items", "items_").collect()}
    for k in (1, 2, 3):
        for c in combinations("abc", k):
            assert found[c] == pytest.approx(sum(set(c) <= set(s) for s in sets) / 5)
    made = rules.association_rules(rules.frequent_itemsets(baskets, 0.2, 4))
    r = made.filter((rules.set_text(F.col("antecedents")) == "c") & (rules.set_text(F.col("consequents")) == "a, b")).first()
    assert r.confidence == pytest.approx(2 / 3) and r.lift == pytest.approx((2 / 3) / 0.6)
    sure = made.filter((rules.set_text(F.col("antecedents")) == "a") & (rules.set_text(F.col("consequents")) == "b")).first()
    assert math.isinf(sure.conviction) and sure.certainty == pytest.approx(1.0)


def test_itemsets_match_brute_force_and_sweep_matches_separate_minings(spark):
    rng = np.random.default_rng(1)
    rows = rng.random((300, 9)) < np.linspace(0.1, 0.8, 9)
    names = [f"i{j}" for j in range(9)]
    wide = spark.createDataFrame([tuple(int(v) for v in r) for r in rows], ", ".join(f"{n} int" for n in names))
    baskets = rules.baskets_from_flags(wide, names)
    want = {c for k in range(1, 5) for c in combinations(range(9), k) if rows[:, c].all(axis=1).mean() >= 0.05}
    sets = rules.frequent_itemsets(baskets, 0.05, 4)
    assert {tuple(int(x[1:]) for x in r[0]) for r in sets.select("items").collect()} == want
    sweep = {r.min_support: (r.n_itemsets, r.n_rules) for r in rules.support_sweep(sets, [0.05, 0.1, 0.2], 0.5).collect()}
    for s in (0.1, 0.2):
        alone = rules.frequent_itemsets(baskets, s, 4)
        assert sweep[s] == (alone.count(), rules.association_rules(alone, 0.5).count())


def test_auc_equals_pairwise_definition_and_single_class_is_null(spark):
    rng = np.random.default_rng(2)
    y, s = (rng.random(200) < 0.3).astype(int), rng.integers(0, 12, 200) / 12
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    p, n = s[y == 1], s[y == 0]
    want = ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))
    assert evaluation.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)
    assert evaluation.roc_auc(df.filter("y = 1"), "y", "s").first()[0] is None
    best = evaluation.best_threshold(df, "y", "s").first()
    f1 = {t: 2 * ((s >= t) & (y == 1)).sum() / ((s >= t).sum() + (y == 1).sum()) for t in set(s)}
    assert best.f1 == pytest.approx(max(f1.values())) and best.threshold == pytest.approx(max(t for t in f1 if f1[t] == max(f1.values())))


@pytest.mark.parametrize("diffs, want", [([1, 2, 3, 4, 5], (0.0, 0.0625)), ([1, -2, 3, 4, 5], (2.0, 0.1875)), ([0, 0, 0], (0.0, None))])
def test_wilcoxon(spark, diffs, want):
    df = spark.createDataFrame([(float(d), 0.0) for d in diffs], "a double, b double")
    r = evaluation.wilcoxon(df, "a", "b").first()
    assert r.statistic == want[0] and (r.p_value is None if want[1] is None else r.p_value == pytest.approx(want[1]))


def test_f_scores_agree_on_binary_labels(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(a), float(a + b), float(c), 1.0) for a, b, c in zip(rng.integers(0, 2, 300), rng.normal(size=300), rng.normal(size=300))], "y int, u double, v double, k double")
    a = {r.feature: r.f_score for r in ranking.anova_f(df, ["u", "v", "k"], "y").collect()}
    b = {r.feature: r.f_score for r in ranking.regression_f(df, ["u", "v", "k"], "y").collect()}
    assert a["u"] == pytest.approx(b["u"]) and a["v"] == pytest.approx(b["v"]) and a["k"] is None and b["k"] is None


def _points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")


def _planted(seed=4):
    """Three blobs, a third of all rows in copies of one point, one far outlier."""
    rng = np.random.default_rng(seed)
    blobs = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    return np.concatenate([blobs, np.tile([[6.0, 6.0]], (91, 1)), [[40.0, 40.0]]])


def test_knn_is_exact_over_many_cells_and_copies(spark):
    x = _planted()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    got = neighbors.knn_join(_points(spark, x), _points(spark, x), "id", "id", "vec", 4, exclude_self=True, block=32)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.id, {})[r["rank"]] = r.neighbor
    for i in range(len(x)):
        order = [j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:4]
        assert [rows[i][k] for k in range(1, 5)] == order
    kth = {r.id: r.dist for r in neighbors.kth_distance(_points(spark, x), "id", "vec", 5, block=32).collect()}
    assert all(kth[i] == pytest.approx(np.sort(d[i])[4]) for i in range(len(x)))


def _dbscan(x, eps, ms):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) <= eps
    core = d.sum(axis=1) >= ms
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if core[i] and label[i] == -1:
            todo, label[i] = [i], i
            while todo:
                for j in np.flatnonzero(d[todo.pop()] & core & (label == -1)):
                    label[j] = i
                    todo.append(j)
    for i in np.flatnonzero(~core):
        near = np.flatnonzero(d[i] & core)
        if len(near):
            label[i] = label[near].min()
    return label


def test_dbscan_grid_matches_brute_force(spark):
    x = _planted()
    labelled, grid = density.dbscan_grid(_points(spark, x), "id", "vec", [0.25, 0.5, 4.5], [3, 10], block=32)
    rows = {r.id: r.labels for r in labelled.collect()}
    for g, (eps, ms) in enumerate(grid):
        assert [rows[i][g] for i in range(len(x))] == list(_dbscan(x, eps, ms)), (eps, ms)


def test_dbscan_separates_rings(spark):
    a = np.linspace(0, 2 * math.pi, 80, endpoint=False)
    x = np.concatenate([np.stack([r * np.cos(a), r * np.sin(a)], axis=1) for r in (1.0, 3.0)])
    labelled, _ = density.dbscan_grid(_points(spark, x), "id", "vec", [0.5], [3], block=32)
    assert {r.id: r.labels[0] for r in labelled.collect()} == {i: 0 if i < 80 else 80 for i in range(160)}


def test_components_of_a_long_path(spark):
    edges = spark.range(199).select(F.lit(0).alias("g"), F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(
        spark.createDataFrame([(0, 500, 400), (1, 0, 7)], "g int, a long, b long"))
    got = {(r.g, r.node): r.root for r in components.connected_components(edges).collect()}
    assert all(got[(0, i)] == 0 for i in range(200)) and got[(0, 500)] == 400 and got[(1, 7)] == 0 and len(got) == 204


def _scores(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    names = np.unique(lab)
    cen = np.array([x[lab == k].mean(axis=0) for k in names])
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == k].mean() for k in names if k != lab[i])
        s.append((b - a) / max(a, b))
    spread = np.array([np.sqrt(((x[lab == k] - c) ** 2).sum(axis=1)).mean() for k, c in zip(names, cen)])
    db = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(cen[i] - cen[j]) for j in range(len(names)) if j != i) for i in range(len(names))])
    within = sum(((x[lab == k] - c) ** 2).sum() for k, c in zip(names, cen))
    between = sum((lab == k).sum() * ((c - x.mean(axis=0)) ** 2).sum() for k, c in zip(names, cen))
    return np.mean(s), db, (between / (len(names) - 1)) / (within / (len(x) - len(names)))


def test_cluster_scores_match_brute_force(spark):
    x = _planted()
    lab = {"a": np.repeat([0, 1, 2, 3, 9], [60, 60, 60, 91, 1]), "b": np.arange(len(x)) % 2}
    df = spark.createDataFrame([(i, float(p[0]), float(p[1]), int(lab["a"][i]), int(lab["b"][i])) for i, p in enumerate(x)], "id long, u double, v double, a int, b int")
    for r in S.score_clusterings(df, "id", ["u", "v"], ["a", "b"]).collect():
        want = _scores(x, lab[r.clustering])
        assert (r.silhouette, r.davies_bouldin, r.calinski_harabasz) == pytest.approx(want)


def _blobs(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, u double, v double")


def _groups(rows, label):
    parts = {}
    for r in rows:
        parts.setdefault(r[label], set()).add(r["id"])
    return sorted(sorted(p) for p in parts.values())


BLOBS = [list(range(0, 60)), list(range(60, 120)), list(range(120, 180))]


def test_kmeans_finds_blobs(spark):
    table, labelled = clustering.kmeans_sweep(_blobs(spark), "id", ["u", "v"], [2, 3, 4], n_init=3)
    assert clustering.best_k(table) == 3
    assert _groups(labelled.collect(), "k3") == BLOBS
    inertia = [r.inertia for r in table.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


def test_agglomerative_finds_blobs(spark):
    labelled, names, merges = clustering.agglomerative_labels(_blobs(spark), "id", ["u", "v"], ["ward", "complete", "average"], [2, 3], neighbors=5)
    rows = labelled.collect()
    assert all(_groups(rows, n) == BLOBS for n in names if n.endswith("k3"))
    assert all(len(_groups(rows, n)) == 2 for n in names if n.endswith("k2"))
    steps = merges.filter("linkage = 'ward'").orderBy("step").collect()
    assert [r.step for r in steps] == list(range(1, 180)) and [r.height for r in steps] == sorted(r.height for r in steps)


def test_pca_explains_everything(spark):
    table = clustering.pca_variance(_blobs(spark), ["u", "v"])
    assert table.orderBy("component").collect()[-1].cumulative == pytest.approx(1.0)
    assert clustering.pca_project(_blobs(spark), "id", ["u", "v"], variance=1.0).first().vec is not None
