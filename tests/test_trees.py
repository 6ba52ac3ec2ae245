"""Trees that grow in the tasks: held against MLlib's single trees, whose every cut is fixed, and against its forests by quality."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import learners, trees
from tabforge.operators.clustering import assemble

FEATURES = ["a", "b", "c", "d"]


def table(n=600, seed=0, levels=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, (n, 3)).astype(float)
    chance = 1 / (1 + np.exp(-(12 / levels * x[:, 0] - 6 + (x[:, 1] > levels / 2) * 2) / 2))
    pdf = pd.DataFrame(np.column_stack([x, np.ones(n)]), columns=FEATURES)
    pdf["y"] = (rng.random(n) < chance).astype(float)
    pdf["id"] = np.arange(n)
    pdf["amount"] = np.round(3 * x[:, 0] + x[:, 1] * x[:, 2] + rng.integers(0, 9, n), 3)
    return pdf


def whole_tree(known, classify, depth=30, leaf=1):
    rows, n = known.rows, known.rows.n.astype(float)
    w = n * rows.weight
    stats = [np.where(rows.y == c, w, 0.0) for c in range(known.classes)] if classify else [w, w * rows.y, w * rows.y * rows.y]
    return trees.grow(rows.bins, known.sizes, stats, n, len(rows.bins), depth, leaf, np.random.default_rng(0), classify)


@pytest.mark.parametrize(("depth", "leaf"), [(3, 1), (30, 1), (30, 7)])
def test_single_trees_are_those_of_mllib(spark, depth, leaf):
    pdf = table()
    pdf["weight"] = np.where(pdf.y == 1, 0.5, 2.0)
    df = spark.createDataFrame(pdf)
    model = C.DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=leaf, maxBins=64, weightCol="weight", labelCol="y").fit(assemble(df, FEATURES))
    known = trees.prepare_rows(df, FEATURES, 64, True)
    tree = whole_tree(known, True, depth, leaf)
    scored = model.transform(assemble(df, FEATURES)).select("id", vector_to_array("probability")[1].alias("p")).toPandas().sort_values("id")
    bins = [np.searchsorted(c, pdf[f], side="left").astype(np.uint8) for f, c in zip(FEATURES, known.cuts)]
    total = tree.total[tree.leaves(bins)]
    assert np.isclose(total[:, 1] / total.sum(axis=1), scored.p, atol=1e-9).mean() > 0.98  # equal gains fall either way by rounding
    own = tree.importance(4, True)
    assert np.allclose(own / own.sum(), model.featureImportances.toArray(), atol=1e-2)

    numbers = df.drop("weight").withColumn("y", F.col("amount"))
    model = R.DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=leaf, maxBins=64, labelCol="y").fit(assemble(numbers, FEATURES))
    known = trees.prepare_rows(numbers, FEATURES, 64, False)
    tree = whole_tree(known, False, depth, leaf)
    scored = model.transform(assemble(numbers, FEATURES)).select("id", "prediction").toPandas().sort_values("id")
    total = tree.total[tree.leaves(bins)]
    assert np.allclose(total[:, 1] / total[:, 0], scored.prediction, atol=1e-6)
    own = tree.importance(4, False)
    assert np.allclose(own / own.sum(), model.featureImportances.toArray(), atol=1e-3)  # equal gains fall either way by rounding


def test_rows_that_come_more_often_count_as_often(spark):
    pdf = table(300)
    often = pd.concat([pdf] * 3)
    one, three = (trees.prepare_rows(spark.createDataFrame(p), FEATURES, 64, True) for p in (pdf, often))
    assert len(one.rows.n) == len(three.rows.n) and three.rows.n.sum() == 900
    a, b = whole_tree(one, True), whole_tree(three, True)
    assert (a.feature == b.feature).all() and np.allclose(3 * a.total, b.total)


@pytest.mark.parametrize("name", ["forest", "boosted", "forest_regressor", "boosted_regressor"])
def test_forests_and_boosting_are_as_good_as_mllibs_without_a_fit_of_it(spark, monkeypatch, name):
    p = {"trees": 30, "rate": 0.1, "depth": 6, "rows": 0.8, "columns": 0.8}
    pdf = table(3000, seed=2, levels=100)
    if "regressor" in name:
        pdf["y"] = pdf["amount"]
    df = spark.createDataFrame(pdf[[*FEATURES, "id", "y"]])
    train, test = df.filter("id % 3 <> 0"), df.filter("id % 3 = 0")

    def error(rows):
        got = rows.toPandas()
        assert sorted(got.id) == sorted(pdf.id[pdf.id % 3 == 0])
        return float(((got.y - (got.pred if "regressor" in name else got.score)) ** 2).mean())

    make, classify = learners.ESTIMATORS[name]
    mllib = error((learners._classify if classify else learners._regress)(make(p), train, test, FEATURES))

    def never(*_, **__):
        raise AssertionError("the forest was fitted by MLlib")

    monkeypatch.setitem(learners.ESTIMATORS, name, (never, classify))
    own = error(learners.LEARNERS[name](train, test, FEATURES, p))
    assert own < 1.15 * mllib and mllib < 1.15 * own
    if "boosted" not in name:
        assert own != error(learners.LEARNERS[name](train, test, FEATURES, p | {"trees": 1}))
    found = learners.fitted_importance(train, FEATURES, name, p)
    assert abs(sum(found.values()) - 1) < 1e-9 and found["d"] == 0


def test_too_many_different_rows_are_left_to_mllib(spark, monkeypatch):
    monkeypatch.setattr(trees, "MOST_BYTES", 1000)
    df = spark.createDataFrame(table(100)[[*FEATURES, "id", "y"]])
    settings = trees.Settings(3, 3)
    assert trees.forest_scores(df, df, FEATURES, settings, 64, True) is None
    assert learners.LEARNERS["forest"](df, df, FEATURES, {"trees": 3, "depth": 3}).count() == 100


def test_null_labels_and_features_are_refused(spark):
    df = spark.createDataFrame(table(50)[[*FEATURES, "id", "y"]])
    for bad in (df.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), df.withColumn("a", F.when(F.col("id") > 3, F.col("a")))):
        with pytest.raises(Exception, match="null"):
            trees.prepare_rows(bad, FEATURES, 64, True)


def test_codes_are_the_bins_of_every_feature(spark):
    rng = np.random.default_rng(4)
    names = [f"f{i}" for i in range(11)]
    x = np.round(rng.normal(size=(400, 11)) * 3, 1)
    df = spark.createDataFrame(pd.DataFrame(x, columns=names))
    cuts = [np.unique(np.round(rng.normal(size=n) * 3, 1)) for n in (0, 1, 2, 5, 40, 63, 63, 1, 200, 0, 3)]
    got = trees._bins_of(trees.with_code(df, names, cuts).toArrow().column("code"), 11)
    for j, c in enumerate(cuts):
        assert (got[j] == np.searchsorted(c, x[:, j], side="left")).all()
