"""Queries that fit models: no SQL equivalent, tested on planted data and by invariants."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.frames_sql import VISITS
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import evaluation as V
from tabforge.operators import experiments as X
from tabforge.operators import information, ranking
from tabforge.operators.learners import forest_importance
from tabforge.plans import frames
from tabforge.plans.frames import DOCUMENT_COLUMNS
from tabforge.session import materialize


def _documents(spark, sf):
    return materialize(frames.document_features(spark, sf), "documents")


def _classify(spark, sf, *names):
    chosen = [e for e in X.CLASSIFIERS if e.name in names]
    predictions, counts = X.cross_validate(_documents(spark, sf), "doc_id", "toxic", DOCUMENT_COLUMNS, chosen, classify=True)
    return materialize(X.classification_folds(predictions), "scores"), counts


def _regress(spark, sf, *names):
    df, features = frames.visit_features(spark, sf)
    chosen = [e for e in X.REGRESSORS if e.name in names]
    predictions, counts = X.cross_validate(materialize(df, "visits"), "visit_id", "n_lines", features, chosen, classify=False, family="priority_")
    return materialize(X.regression_folds(predictions), "scores"), counts


@query("forest_rank")
def forest_rank(spark, sf):
    """Three scores per feature, best importance first."""
    df = _documents(spark, sf)
    return ranking.rank_table([
        ranking.anova_f(df, DOCUMENT_COLUMNS, "toxic"), information.mutual_information(df, DOCUMENT_COLUMNS, "toxic", classify=True),
        forest_importance(df, DOCUMENT_COLUMNS, "toxic", classify=True).withColumnRenamed("importance", "rf_importance"),
    ], "rf_importance")


@query("classifier_cv")
def classifier_cv(spark, sf):
    """Experiments on oversampled folds."""
    return X.classification_summary(*_classify(
        spark, sf, "nearest_5_all", "nearest_11_top20", "naive_bayes", "tree_depth5", "tree_depth10_leaf20"))


@query("svm_cv")
def svm_cv(spark, sf):
    """Every fold fits three machines and three calibration curves."""
    return X.classification_summary(*_classify(spark, sf, "calibrated_svm_top20"))


@query("perceptron_cv")
def perceptron_cv(spark, sf):
    """M19."""
    return X.classification_summary(*_classify(spark, sf, "perceptron_top30"))


@query("forest_cv")
def forest_cv(spark, sf):
    """M8 M16."""
    return X.classification_summary(*_classify(spark, sf, "forest_100_balanced", "forest_200_tuned_balanced"))


@query("boosted_cv")
def boosted_cv(spark, sf):
    """M8 M17."""
    return X.classification_summary(*_classify(spark, sf, "boosted_100"))


@query("classifier_test")
def classifier_test(spark, sf):
    """V9: best against second best over the folds."""
    scores, _ = _classify(spark, sf, "naive_bayes", "tree_depth5", "tree_depth10_leaf20")
    return X.compare_best_two(scores, "roc_auc", "roc_auc", largest=True)


@query("roc_compare")
def roc_compare(spark, sf):
    """V8: curves of several models on one split."""
    chosen = [e for e in X.CLASSIFIERS if e.name in ("boosted_100", "forest_100_balanced", "tree_depth10_leaf20", "calibrated_svm_top20", "perceptron_top30")]
    scored = X.holdout_predictions(_documents(spark, sf), "doc_id", "toxic", DOCUMENT_COLUMNS, chosen, classify=True)
    return V.roc_points(scored, "y", "score", ["experiment"]).join(V.roc_auc(scored, "y", "score", ["experiment"]), "experiment")


@query("best_model_report")
def best_model_report(spark, sf):
    """One model on the hold-out rows, at the default and the F1-optimal threshold."""
    e = X.find_experiment("naive_bayes", X.CLASSIFIERS, "forest_100_balanced")
    scored = X.holdout_predictions(_documents(spark, sf), "doc_id", "toxic", DOCUMENT_COLUMNS, [e], classify=True)
    best = V.best_threshold(scored, "y", "score").first()["threshold"]
    return V.threshold_metrics(scored, "y", "score", [0.5, best], ["experiment"])


@query("regressor_cv")
def regressor_cv(spark, sf):
    """M10 M12 M15 M20 M21."""
    return X.regression_summary(*_regress(
        spark, sf, "least_squares_all", "ridge_1_all", "ridge_10_top20", "lasso_001_all", "tree_depth5", "tree_depth10_leaf20", "poisson_1_all"))


@query("line_cv", f"""WITH {VISITS}, f AS (SELECT visit_id, n_lines::DOUBLE AS y, qty::DOUBLE AS x,
  ((row_number() OVER (ORDER BY (visit_id % 1000003 * 7919 + 104729) % 1000003, visit_id) - 1) % 5)::INT AS fold FROM visits),
fits AS (SELECT t.fold, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM (SELECT DISTINCT fold FROM f) t JOIN f ON f.fold <> t.fold GROUP BY t.fold),
p AS (SELECT f.fold, y, base + slope * x AS pred FROM f JOIN fits USING (fold)),
m AS (SELECT fold, avg(y) AS mean FROM p GROUP BY fold)
SELECT fold, round(avg(abs(y - pred)), 6) AS mae, round(sqrt(avg((y - pred) ** 2)), 6) AS rmse, round(1 - sum((y - pred) ** 2) / sum((y - mean) ** 2), 6) AS r2
FROM p JOIN m USING (fold) GROUP BY fold""")
def line_cv(spark, sf):
    """Five fits of a straight line, each scored on the rows it has not seen."""
    line = X.Experiment("line", "ridge", {"alpha": 0.0})
    predictions, _ = X.cross_validate(frames.visits(spark, sf), "visit_id", "n_lines", ["qty"], [line], classify=False)
    scores = X.regression_folds(predictions)
    return scores.select("fold", *[rounded(F.col(c)).alias(c) for c in ("mae", "rmse", "r2")])


@query("forest_regressor_cv")
def forest_regressor_cv(spark, sf):
    """M16."""
    return X.regression_summary(*_regress(spark, sf, "forest_100"))


@query("leakage_check")
def leakage_check(spark, sf):
    """Boosting with and without one feature family."""
    return X.regression_summary(*_regress(spark, sf, "boosted_100", "boosted_100_without_family"))


@query("regressor_test")
def regressor_test(spark, sf):
    """V9 on the fold RMSE of the two best by MAE."""
    scores, _ = _regress(spark, sf, "least_squares_all", "tree_depth5", "poisson_1_all")
    return X.compare_best_two(scores, "rmse", "mae", largest=False)


@query("regressor_residuals")
def regressor_residuals(spark, sf):
    """Hold-out residuals of one model in 50 bins."""
    from tabforge.operators.profiling import histogram

    df, features = frames.visit_features(spark, sf)
    e = X.find_experiment("tree_depth5", X.REGRESSORS, "least_squares_all")
    scored = X.holdout_predictions(df, "visit_id", "n_lines", features, [e], classify=False)
    return histogram(V.residuals(scored, "y", "pred"), "residual", 50)


@query("best_model_importance")
def best_model_importance(spark, sf):
    """The 20 most important features of a fitted regressor, the leaky family left out or not."""
    df, features = frames.visit_features(spark, sf)
    e = X.find_experiment("tree_depth10_leaf20", X.REGRESSORS, "least_squares_all")
    return X.model_importance(df, "visit_id", "n_lines", features, e, classify=False, family="priority_")
