"""Learners behind one signature: (train, test, features, settings) -> (id, y, score, pred) of the test rows.

``train`` and ``test`` hold id, y, the feature columns (standardised) and, where asked for, ``weight``.
Forests and boosted trees grow in the tasks (``operators/trees.py``); everything else that has an MLlib counterpart
uses it, and so do they where the different rows are too many for a task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators import gradient, trees
from tabforge.operators.clustering import assemble
from tabforge.operators.folds import k_folds
from tabforge.operators.neighbors import knn_vote
from tabforge.session import materialize

Learner = Callable[[DataFrame, DataFrame, Sequence[str], Mapping], DataFrame]
SEED = 42
DEEPEST = 30  # MLlib grows trees no deeper; an unlimited tree stops here


def _weighted(estimator, train: DataFrame):
    return estimator.setWeightCol("weight") if "weight" in train.columns else estimator


def _classify(estimator, train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    model = estimator.setFeaturesCol("features").setLabelCol("y").fit(assemble(train, features))
    return model.transform(assemble(test, features)).select(
        "id", "y", vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("double").alias("pred"))


def _regress(estimator, train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    model = estimator.setFeaturesCol("features").setLabelCol("y").fit(assemble(train, features))
    return model.transform(assemble(test, features)).select("id", "y", F.lit(None).cast("double").alias("score"), F.col("prediction").alias("pred"))


def _nearest(train, test, features, p):
    vec = F.array(*[F.col(c) for c in features]).alias("vec")
    votes = knn_vote(train.select("id", vec, "y"), test.select("id", vec), "id", "vec", "y", p["k"])
    return test.select("id", "y").join(votes, "id").select("id", "y", "score", F.col("pred").cast("double").alias("pred"))


def _naive_bayes(train, test, features, p):
    return _classify(C.NaiveBayes(modelType="gaussian"), train, test, features)


def _tree(p):
    return C.DecisionTreeClassifier(maxDepth=p["depth"], minInstancesPerNode=p.get("leaf", 1), maxBins=p.get("bins", 64), seed=SEED)


def _forest(p):
    return C.RandomForestClassifier(
        numTrees=p["trees"], maxDepth=p.get("depth", DEEPEST), minInstancesPerNode=p.get("leaf", 1), maxBins=p.get("bins", 64),
        featureSubsetStrategy="sqrt", seed=SEED)


def _boosted(p):
    return C.GBTClassifier(maxIter=p["trees"], stepSize=p["rate"], maxDepth=p["depth"], subsamplingRate=p["rows"],
                           featureSubsetStrategy=str(p["columns"]), maxBins=p.get("bins", 64), seed=SEED)


def _calibrated_svm(train, test, features, p):
    """Squared-hinge linear machine without each part of a 3-fold split, a sigmoid fitted on the margins of that part, mean probability."""
    k = p.get("folds", 3)
    parts = k_folds(train.withColumn("_row", F.xxhash64("id", F.coalesce("_copy", F.lit(-1)))), "_row", k, "y", "_part")
    parts = materialize(parts, "svm")
    machines = gradient.squared_hinge(parts, features, "y", p["c"], F.col("_part"), k)
    own = gradient.margins(features, machines)[F.col("_part").cast("int")]
    curves = gradient.sigmoids(parts, own, "y", F.col("_part"), k)
    scored = test.withColumn("_m", gradient.margins(features, machines))
    score = sum((1 / (1 + F.exp(-(F.col("_m")[i] * float(a) + float(b)))) for i, (a, b) in enumerate(curves)), F.lit(0.0)) / k
    return scored.select("id", "y", score.alias("score")).withColumn("pred", (F.col("score") > 0.5).cast("double"))


def _perceptron(train, test, features, p):
    model = gradient.fit_perceptron(train, features, "y", p["hidden"], p.get("alpha", 0.001), p["iterations"], seed=SEED)
    return test.select("id", "y", model.score(features).alias("score")).withColumn("pred", (F.col("score") > 0.5).cast("double"))


def _ridge(train, test, features, p):
    """Least squares with an L2 penalty alpha on the summed squares. MLlib scales its penalty by the target's
    deviation and the number of rows, hence the conversion."""
    alpha = p.get("alpha", 0.0)
    s = train.agg(F.stddev_pop("y").alias("s"), F.count("*").alias("n")).first()
    est = R.LinearRegression(regParam=alpha * s["s"] / s["n"], elasticNetParam=0.0, standardization=False, solver="normal")
    return _regress(est, train, test, features)


def _lasso(train, test, features, p):
    est = R.LinearRegression(regParam=p["alpha"], elasticNetParam=1.0, standardization=False, maxIter=p.get("iterations", 1000), tol=1e-8)
    return _regress(est, train, test, features)


def _poisson(train, test, features, p):
    """Log-link Poisson model with penalty alpha on the mean deviance; MLlib's penalty is per unit of the mean."""
    mean = train.agg(F.avg("y")).first()[0]
    est = R.GeneralizedLinearRegression(family="poisson", link="log", regParam=p["alpha"] / mean, maxIter=p.get("iterations", 100))
    return _regress(est, train, test, features)


def _tree_regressor(p):
    return R.DecisionTreeRegressor(maxDepth=p["depth"], minInstancesPerNode=p.get("leaf", 1), maxBins=p.get("bins", 64), seed=SEED)


def _forest_regressor(p):
    return R.RandomForestRegressor(numTrees=p["trees"], maxDepth=p.get("depth", DEEPEST), minInstancesPerNode=p.get("leaf", 1),
                                   maxBins=p.get("bins", 64), featureSubsetStrategy="all", seed=SEED)


def _boosted_regressor(p):
    return R.GBTRegressor(maxIter=p["trees"], stepSize=p["rate"], maxDepth=p["depth"], subsamplingRate=p["rows"],
                          featureSubsetStrategy=str(p["columns"]), maxBins=p.get("bins", 64), seed=SEED)


#: Learners whose fitted model has feature importances, as makers of MLlib estimators; True: classifiers.
ESTIMATORS = {
    "tree": (_tree, True), "forest": (_forest, True), "boosted": (_boosted, True),
    "tree_regressor": (_tree_regressor, False), "forest_regressor": (_forest_regressor, False), "boosted_regressor": (_boosted_regressor, False),
}


def _settings(name: str, p: Mapping) -> trees.Settings:
    if name.startswith("boosted"):
        return trees.Settings(p["trees"], p["depth"], 1, p["columns"], p["rate"], p["rows"], SEED)
    return trees.Settings(p["trees"], p.get("depth", DEEPEST), p.get("leaf", 1), "sqrt" if ESTIMATORS[name][1] else "all", seed=SEED)


def _of_estimator(name: str) -> Learner:
    make, classify = ESTIMATORS[name]
    own = {"forest": trees.forest_scores, "boosted": trees.boosted_scores}.get(name.removesuffix("_regressor"))

    def learner(train, test, features, p):
        if own is not None:
            rows = train if classify else train.drop("weight")
            scored = own(rows, test, features, _settings(name, p), p.get("bins", 64), classify)
            if scored is not None:
                return scored
        return _classify(_weighted(make(p), train), train, test, features) if classify else _regress(make(p), train, test, features)

    return learner


def fitted_importance(train: DataFrame, features: Sequence[str], name: str, params: Mapping) -> dict[str, float]:
    """Importance of each feature in one of ``ESTIMATORS`` fitted on ``train``."""
    make, classify = ESTIMATORS[name]
    if not name.startswith("tree"):
        found = trees.importances(train if classify else train.drop("weight"), features, _settings(name, params), params.get("bins", 64), classify, name.startswith("boosted"))
        if found is not None:
            return dict(zip(features, map(float, found)))
    estimator = _weighted(make(params), train) if classify else make(params)
    model = estimator.setFeaturesCol("features").setLabelCol("y").fit(assemble(train, features))
    return dict(zip(features, (float(v) for v in model.featureImportances.toArray())))


LEARNERS: dict[str, Learner] = {
    "nearest": _nearest, "naive_bayes": _naive_bayes, "calibrated_svm": _calibrated_svm, "perceptron": _perceptron,
    "ridge": _ridge, "lasso": _lasso, "poisson": _poisson, **{name: _of_estimator(name) for name in ESTIMATORS},
}


def forest_importance(df: DataFrame, features: Sequence[str], y: str, classify: bool, trees: int = 100, depth: int = DEEPEST) -> DataFrame:
    """(feature, importance) of a random forest; classes are weighted to balance."""
    from tabforge.operators.folds import with_class_weight

    data = df.withColumn("y", F.col(y).cast("double"))
    data = with_class_weight(data, "y") if classify else data.drop("weight")
    found = fitted_importance(data, features, "forest" if classify else "forest_regressor", {"trees": trees, "depth": depth})
    return df.sparkSession.createDataFrame(list(found.items()), "feature string, importance double")
