"""Caps, prefixes and edge cases: what holds for small inputs holds for all."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions.columns import order_hash
from tabforge.operators import boxes, cluster_scores, clustering, encoding, experiments, folds, neighbors, ordering, profiling, rules
from tabforge.session import materialize
from tabforge.sources import tables


def test_far_cluster_is_found(spark):
    """Twenty far rows among 30,000 get a centre of their own."""
    x = F.when(F.col("id") % 1500 == 7, F.lit(1000.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    rows = spark.range(30_000).select("id", x.alias("a"), (x + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0).alias("b"))
    data = materialize(rows.withColumn("vec", F.array("a", "b")), "far")
    fits = clustering.kmeans_fits(data, 2, [2, 3], n_init=2)
    for centres in fits.values():
        assert np.isclose(centres[:, 0].max(), 1000.0)


def test_starts_with_few_different_points(spark):
    data = materialize(spark.range(50).select("id", F.array((F.col("id") % 2).cast("double")).alias("vec")), "two")
    fits = clustering.kmeans_fits(data, 1, [3], n_init=2)
    assert set(np.unique(fits[3].round(6))) == {0.0, 1.0}


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(labels):
        means = {k: d[i, labels == k].sum() / ((labels == k).sum() - (k == own)) for k in set(labels) if (labels == k).sum() > (k == own)}
        b = min((m for k, m in means.items() if k != own), default=None)
        out.append(0.0 if own not in means or b is None else (b - means[own]) / max(b, means[own]))
    return np.mean(out)


def test_silhouette_over_all_rows(spark):
    rng = np.random.default_rng(3)
    n = 2500  # more than two blocks
    x, labels = rng.normal(size=(n, 2)), rng.integers(0, 4, n)
    x += labels[:, None]
    labels[0] = 9  # a cluster of one
    df = spark.createDataFrame([(i, float(a), float(b), int(k), 0) for i, ((a, b), k) in enumerate(zip(x, labels))], "id long, a double, b double, k int, one int")
    points = cluster_scores.points_with_labels(df, "id", ["a", "b"], ["k", "one"])
    got = {r.run: r.silhouette for r in cluster_scores.silhouette(points, None).collect()}
    assert got[0] == pytest.approx(brute_silhouette(x, labels), abs=1e-9) and got[1] is None


def test_itemsets_of_any_size(spark):
    rng = random.Random(1)
    baskets = [sorted(rng.sample("abcdefgh", rng.randint(0, 8))) for _ in range(60)]
    got = {tuple(r["items"]): r["n"] for r in rules.frequent_itemsets(spark.createDataFrame([(b,) for b in baskets], "items array<string>"), 0.1, 7).collect()}
    want = {}
    for size in range(1, 8):
        for c in itertools.combinations("abcdefgh", size):
            n = sum(set(c) <= set(b) for b in baskets)
            if n / 60 >= 0.1:
                want[c] = n
    assert got == want and max(map(len, want)) >= 6


def test_buckets_follow_the_rows(spark, monkeypatch):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"))
    one_bucket = sorted(map(tuple, ordering.bucketed_rank(df, "id", ["g"]).collect()))
    sums = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 20)
    ranked = ordering.bucketed_rank(df, "id", ["g"])
    assert sorted(map(tuple, ranked.collect())) == one_bucket
    width = ordering.ORDER_HASH_RANGE // ordering.bucket_count(500) + 1
    assert ranked.groupBy("g", F.floor(order_hash("id") / width)).count().agg(F.max("count")).first()[0] <= 20


def brute_itemsets(baskets, support, longest):
    want = {}
    for size in range(1, longest + 1):
        for c in itertools.combinations(sorted(set().union(*baskets)), size):
            n = sum(set(c) <= set(b) for b in baskets)
            if n / len(baskets) >= support:
                want[c] = n
    return want


@pytest.mark.parametrize("shard_baskets", [1 << 16, 7])
def test_itemsets_over_shards(spark, shard_baskets):
    """Shards find different sets; a third of all baskets are copies of one; empty baskets, null and repeated items."""
    rng = random.Random(5)
    baskets = [sorted(rng.sample("abcdefghij", rng.randint(0, 6))) for _ in range(150)] + [["a", "d", "j"]] * 80 + [[], ["c", "c", "a"]]
    rows = spark.createDataFrame([(b,) for b in baskets] + [([None, "b"],)], "items array<string>").repartition(3)
    got = {tuple(r["items"]): r["n"] for r in rules.frequent_itemsets(rows, 0.06, 5, shard_baskets=shard_baskets).collect()}
    assert got == brute_itemsets([*baskets, ["b"]], 0.06, 5)


def test_a_basket_of_5000_items(spark):
    rows = [(i, f"x{(i * 7 + j) % 40}") for i in range(400) for j in range(5)] + [(1000, f"y{j}") for j in range(5000)]
    long = spark.createDataFrame(rows, "tid int, item string")
    for baskets in (rules.baskets_from_rows(long), rules.baskets_from_rows(long, min_support=0.05)):
        found = {tuple(r["items"]): r["n"] for r in rules.frequent_itemsets(baskets, 0.05, 3).collect()}
        assert len([s for s in found if len(s) == 1]) == 40 and not any(x.startswith("y") for s in found for x in s)
        assert found[("x0",)] == sum(item == "x0" for _, item in rows)


def test_pruned_baskets_keep_empty_transactions(spark):
    long = spark.createDataFrame([(1, "a"), (2, "a"), (3, "z"), (None, "a"), (4, None)], "tid int, item string")
    got = sorted(r["items"] for r in rules.baskets_from_rows(long, min_support=0.4).collect())
    assert got == [[], [], ["a"], ["a"], ["a"]]


def test_davies_bouldin_of_many_clusters(spark, monkeypatch):
    monkeypatch.setattr(cluster_scores, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(6)
    x, label = rng.normal(size=(900, 2)), rng.integers(0, 150, 900)
    df = spark.createDataFrame([(i, float(a), float(b), int(k), 0) for i, ((a, b), k) in enumerate(zip(x, label))], "id long, a double, b double, k int, one int")
    points = cluster_scores.points_with_labels(df, "id", ["a", "b"], ["k", "one"])
    names = np.unique(label)
    centres = np.array([x[label == k].mean(axis=0) for k in names])
    spread = np.array([np.sqrt(((x[label == k] - c) ** 2).sum(axis=1)).mean() for k, c in zip(names, centres)])
    gap = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    got = {r.run: r.davies_bouldin for r in cluster_scores.davies_bouldin(points, cluster_scores.cluster_stats(points, 2)).collect()}
    assert got[0] == pytest.approx(((spread[:, None] + spread[None]) / gap).max(axis=1).mean()) and got[1] is None


def test_neighbours_travel_a_bounded_number_of_times(spark):
    """On points along a line, a block meets only the blocks beside it."""
    points = materialize(spark.range(4000).select(F.lit("").alias("grp"), "id", F.array(F.col("id").cast("double"), F.lit(0.0)).alias("vec")), "line")
    curve = boxes.fit_curve(points, block=50)
    placed = boxes.lay_out(points, curve, block=50)
    around = materialize(boxes.boxes(placed.withColumn("reach", F.lit(10.0))), "around")
    assert around.agg(F.max("n")).first()[0] <= 50
    met = boxes.reachable(around, around).groupBy("lb").count().agg(F.max("count"), F.count("*")).first()
    assert met[0] <= 5 and met[1] >= 80


@pytest.fixture
def many_ranges(spark):
    """Small tables in as many ranges as large ones."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_totals_and_ranks_across_ranges(spark, many_ranges):
    """One group of two thirds of the rows lies in several ranges; a null group is a group."""
    group = F.when(F.col("id") % 6 == 5, F.lit(None)).when(F.col("id") % 6 == 4, 1).otherwise(0)
    df = spark.range(3000).select("id", group.alias("g"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("v"), (F.col("id") % 7).alias("n"))
    rows = df.collect()
    assert ordering.range_parts(df, ["g", "v"]).filter("g = 0").select("_b").distinct().count() > 2
    for descending, exclusive in itertools.product([False, True], [False, True]):
        got = {r.id: r.t for r in ordering.running_totals(df, "v", {"t": "n"}, ["g"], descending, exclusive).collect()}
        for g in (0, 1, None):
            before = 0
            for r in sorted([r for r in rows if r.g == g], key=lambda r: -r.v if descending else r.v):
                assert got[r.id] == (before if exclusive else before + r.n)
                before += r.n
    got = {r.id: r["rank"] for r in ordering.range_rank(df, ["n", "v"], ["g"]).collect()}
    for g in (0, 1, None):
        own = sorted([r for r in rows if r.g == g], key=lambda r: (r.n, r.v))
        assert [got[r.id] for r in own] == list(range(1, len(own) + 1))


def test_ids_of_any_size(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,), (-9_000_000_000_000_000_000,), (5,)], "id long")
    values = [r[0] for r in df.select(order_hash("id")).collect()]
    assert values[2] == (5 * 7919 + 104729) % 1000003 and all(0 <= v < 1000003 for v in values)


def test_holdout_rounds_up(spark):
    assert folds.holdout(spark.range(101), "id").agg(F.sum("is_test")).first()[0] == 21


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, None), (2.0, None)], "a double, b double")
    assert {r.column: r["skew"] for r in profiling.skewness(df, ["a", "b"]).collect()} == {"a": 0.0, "b": None}
    box = {r.column: r for r in profiling.box_stats(df, ["a", "b"]).collect()}
    assert box["b"].median is None and box["b"].n_outliers == 0 and box["a"].median == 2.0


@pytest.mark.parametrize("positives", [0, 1])
def test_smote_with_hardly_a_minority(spark, positives):
    df = spark.range(6).select("id", F.col("id").cast("double").alias("x"), (F.col("id") < positives).cast("int").alias("y"))
    made = neighbors.smote(df, "id", ["x"], "y")
    assert made.columns == ["id", "j", "x", "y", "synthetic"]
    assert [r.x for r in made.collect()] == [0.0] * (4 * positives)


def test_codes_lose_all_white_space(spark):
    df = spark.createDataFrame([("\t12\n",), (" 7 ",), ("x",)], "c string")
    got = [r[0] for r in df.select(encoding.code_category(F.col("c"), [("low", 0, 10), ("high", 11, 20)])).collect()]
    assert got == ["high", "low", "Unknown"]


def test_levels_without_a_limit(spark):
    df = spark.range(10_050).select(F.col("id").cast("string").alias("c"))
    assert len(encoding.fit_levels(df, ["c"])["c"]) == 10_050
    with pytest.raises(ValueError):
        encoding.fit_levels(df, ["c"], 10_000)


def test_target_summary_has_the_median(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (9.0,), (None,), (2.0,)], "y double")
    assert tables.target_summary(df, "y").first().median == 2.25
    assert [tuple(r) for r in tables.target_counts(df, "y").collect()] == [(1, 1), (2, 2), (9, 1)]


def test_importance_of_the_best_model(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 7 * 3).cast("double").alias("y"))
    e = experiments.find_experiment("tree_depth5", experiments.REGRESSORS, "least_squares_all")
    found = experiments.model_importance(df, "id", "y", ["a", "b"], e, classify=False).collect()
    assert [(r["rank"], r.feature) for r in found] == [(1, "a"), (2, "b")] and found[0].importance == pytest.approx(1.0)
    assert experiments.model_importance(df, "id", "y", ["a", "b"], experiments.find_experiment("?", experiments.REGRESSORS, "least_squares_all"), classify=False).count() == 0


def test_fallback_comes_from_the_registry():
    only = [e for e in experiments.CLASSIFIERS if e.name == "naive_bayes"]
    assert experiments.find_experiment("unknown", only, "forest_100_balanced").name == "forest_100_balanced"
