"""Model comparison: named experiments, cross-validation with kept out-of-fold predictions, hold-out fits.

Every fit's predictions are written to one long table (experiment, fold, id, y, score, pred). Metrics,
curves, thresholds and paired tests all read that table, so nothing is refitted for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col
from tabforge.operators import evaluation as V
from tabforge.operators import information, ranking
from tabforge.operators.cleaning import without_prefix
from tabforge.operators.encoding import apply_standard, fit_standard
from tabforge.operators.folds import holdout, k_folds, with_class_weight
from tabforge.operators.learners import ESTIMATORS, LEARNERS, fitted_importance, forest_importance
from tabforge.operators.neighbors import smote
from tabforge.session import materialize


@dataclass(frozen=True)
class Experiment:
    """``features`` names a feature set, ``balance`` is none, smote, weights (balanced) or scale (positives
    weighted by negatives / positives)."""

    name: str
    learner: str
    params: Mapping = field(default_factory=dict)
    features: str = "all"
    balance: str = "none"


_BOOST = {"trees": 100, "rate": 0.1, "depth": 6, "rows": 0.8, "columns": 0.8}

CLASSIFIERS = [
    Experiment("nearest_5_all", "nearest", {"k": 5}, "all", "smote"),
    Experiment("nearest_11_top20", "nearest", {"k": 11}, "anova20", "smote"),
    Experiment("naive_bayes", "naive_bayes", {}, "all", "smote"),
    Experiment("tree_depth5", "tree", {"depth": 5}, "all", "smote"),
    Experiment("tree_depth10_leaf20", "tree", {"depth": 10, "leaf": 20}, "all", "smote"),
    Experiment("forest_100_balanced", "forest", {"trees": 100}, "all", "weights"),
    Experiment("forest_200_tuned_balanced", "forest", {"trees": 200, "depth": 20, "leaf": 5}, "forest30", "weights"),
    Experiment("boosted_100", "boosted", _BOOST, "all", "scale"),
    Experiment("calibrated_svm_top20", "calibrated_svm", {"c": 1.0}, "anova20", "smote"),
    Experiment("perceptron_top30", "perceptron", {"hidden": [128, 64], "iterations": 200, "alpha": 0.001}, "forest30", "smote"),
]

REGRESSORS = [
    Experiment("least_squares_all", "ridge", {"alpha": 0.0}),
    Experiment("ridge_1_all", "ridge", {"alpha": 1.0}),
    Experiment("ridge_10_top20", "ridge", {"alpha": 10.0}, "anova20"),
    Experiment("lasso_001_all", "lasso", {"alpha": 0.01}),
    Experiment("tree_depth5", "tree_regressor", {"depth": 5}),
    Experiment("tree_depth10_leaf20", "tree_regressor", {"depth": 10, "leaf": 20}),
    Experiment("forest_100", "forest_regressor", {"trees": 100}),
    Experiment("boosted_100", "boosted_regressor", _BOOST),
    Experiment("boosted_100_without_family", "boosted_regressor", _BOOST, "without_family"),
    Experiment("poisson_1_all", "poisson", {"alpha": 1.0}),
]


def find_experiment(name: str, experiments: Sequence[Experiment], fallback: str) -> Experiment:
    """Experiment by name; an unknown name gives the fallback, from the registry where it isn't among ``experiments``."""
    known = {e.name: e for e in (*CLASSIFIERS, *REGRESSORS)}
    by_name = {e.name: e for e in experiments}
    return by_name.get(name) or by_name.get(fallback) or known[fallback]


def feature_sets(
    df: DataFrame, features: Sequence[str], y: str, classify: bool, needed: Sequence[str] = ("all", "anova20", "forest30"),
    family: str | None = None, trees: int = 100,
) -> dict[str, list[str]]:
    """Named feature lists: all, the best 20 by F score, the best 30 by forest importance or by mutual information,
    those with variance, all but a prefix family."""
    sets = {"all": list(features)}
    if "without_family" in needed and family:
        sets["without_family"] = without_prefix(features, family)
    def best(scores: DataFrame, score: str, n: int) -> list[str]:
        return [r["feature"] for r in scores.orderBy(F.desc_nulls_last(score), "feature").limit(n).collect()]
    if "variance" in needed:
        sets["variance"] = [r["feature"] for r in ranking.variance_filter(df, features).filter("kept = 1").orderBy("feature").collect()]
    if "mutual30" in needed:
        sets["mutual30"] = best(information.mutual_information(df, features, y, classify), "mutual_info", 30)
    if "anova20" in needed:
        f = ranking.anova_f(df, features, y) if classify else ranking.regression_f(df, features, y)
        sets["anova20"] = best(f, "f_score", 20)
    if "forest30" in needed:
        sets["forest30"] = best(forest_importance(df, features, y, classify, trees), "importance", 30)
    return sets


def _training_table(train: DataFrame, features: Sequence[str], balance: str) -> DataFrame:
    """Balanced rows: synthetic minority rows added, or a weight column."""
    if balance == "smote":
        made = smote(train, "id", features, "y").select("id", F.col("j").alias("_copy"), *features, "y")
        return train.withColumn("_copy", F.lit(-1)).select("id", "_copy", *features, "y").unionByName(made.withColumn("_copy", F.col("_copy").cast("int")))
    if balance == "weights":
        return with_class_weight(train, "y")
    if balance == "scale":
        pos = F.count_if(F.col("y") == 1)
        scale = train.agg(((F.count("*") - pos) / F.greatest(pos, F.lit(1))).alias("s")).first()["s"]
        return train.withColumn("weight", F.when(F.col("y") == 1, F.lit(float(scale))).otherwise(1.0))
    return train


def fit_predict(train: DataFrame, test: DataFrame, experiment: Experiment, features: Sequence[str], prepared: dict | None = None) -> DataFrame:
    """Balance, standardise on the training rows only, fit, score the test rows."""
    key = (experiment.balance, tuple(features))
    cache = prepared if prepared is not None else {}
    if key not in cache:
        table = materialize(_training_table(train.select("id", "y", *features), features, experiment.balance), "train")
        cache[key] = (table, fit_standard(table, features))
    table, scale = cache[key]
    # Neighbour search needs unique ids: every training row gets one of its own from its id and copy number.
    if "_copy" in table.columns and experiment.learner == "nearest":
        table = table.withColumn("id", F.xxhash64("id", "_copy")).drop("_copy")
    elif "_copy" in table.columns and experiment.learner != "calibrated_svm":
        table = table.drop("_copy")
    return LEARNERS[experiment.learner](apply_standard(table, scale), apply_standard(test.select("id", "y", *features), scale), features, experiment.params)


def model_importance(df: DataFrame, id_col: str, y: str, features: Sequence[str], experiment: Experiment, classify: bool, top: int = 20,
                     family: str | None = None) -> DataFrame:
    """(experiment, rank, feature, importance): the ``top`` features of one experiment's model, fitted on all rows.

    No rows for a learner that isn't a tree, a forest or boosted.
    """
    data = prepare(df, id_col, y, features)
    used = feature_sets(data, features, "y", classify, {experiment.features}, family)[experiment.features]
    if experiment.learner not in ESTIMATORS:
        return df.sparkSession.createDataFrame([], "experiment string, rank int, feature string, importance double")
    table = materialize(_training_table(data, used, experiment.balance), "train")
    scores = fitted_importance(apply_standard(table, fit_standard(table, used)), used, experiment.learner, experiment.params)
    rows = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:top]
    return df.sparkSession.createDataFrame([(experiment.name, i + 1, f, v) for i, (f, v) in enumerate(rows)], "experiment string, rank int, feature string, importance double")


def prepare(df: DataFrame, id_col: str, y: str, features: Sequence[str]) -> DataFrame:
    """(id long, y double, features double), nulls as 0."""
    return df.select(F.col(id_col).cast("long").alias("id"), col(y).cast("double").alias("y"),
                     *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])


def cross_validate(
    df: DataFrame, id_col: str, y: str, features: Sequence[str], experiments: Sequence[Experiment], classify: bool,
    folds: int = 5, family: str | None = None, rank_within_fold: bool = False, parallelism: int = 5,
) -> tuple[DataFrame, dict[str, int]]:
    """Out-of-fold predictions (experiment, fold, id, y, score, pred) and each experiment's feature count.

    Folds run side by side. ``rank_within_fold`` selects features on the training rows of each fold; the
    default ranks once on all rows, which lets the ranking see the test rows.
    """
    data = materialize(k_folds(prepare(df, id_col, y, features), "id", folds, "y" if classify else None), "folds")
    needed = {e.features for e in experiments}
    shared = None if rank_within_fold else feature_sets(data, features, "y", classify, needed, family)

    def run(fold: int) -> list[tuple[str, DataFrame, int]]:
        train, test = data.filter(F.col("fold") != fold), data.filter(F.col("fold") == fold)
        sets = shared or feature_sets(train, features, "y", classify, needed, family)
        prepared: dict = {}
        out = []
        for e in experiments:
            used = sets[e.features]
            scored = fit_predict(train, test, e, used, prepared).select(F.lit(e.name).alias("experiment"), F.lit(fold).alias("fold"), "id", "y", "score", "pred")
            out.append((e.name, materialize(scored, "oof"), len(used)))
        return out

    with ThreadPoolExecutor(parallelism) as pool:
        results = [r for part in pool.map(run, range(folds)) for r in part]
    return reduce(DataFrame.unionByName, [r[1] for r in results]), {name: n for name, _, n in results}


def _with_counts(summary: DataFrame, counts: Mapping[str, int]) -> DataFrame:
    pairs = [F.lit(x) for item in counts.items() for x in item]
    return summary.withColumn("n_features", F.create_map(*pairs)[F.col("experiment")])


def classification_folds(predictions: DataFrame) -> DataFrame:
    """(experiment, fold, accuracy, precision, recall, f1, roc_auc)."""
    by = ["experiment", "fold"]
    return V.classification_metrics(predictions, "y", "pred", by).join(V.roc_auc(predictions, "y", "score", by), by)


def classification_summary(fold_scores: DataFrame, counts: Mapping[str, int]) -> DataFrame:
    """Result table: means of five metrics and deviations of three, 4 digits, best area first."""
    s = V.fold_summary(fold_scores, ["accuracy", "f1", "precision", "recall", "roc_auc"])
    names = ["accuracy", "f1", "precision", "recall", "roc_auc", "accuracy_std", "f1_std", "roc_auc_std"]
    return _with_counts(s, counts).select("experiment", "n_features", *[F.bround(n, 4).alias(n) for n in names]).orderBy(F.desc("roc_auc"), "experiment")


def regression_folds(predictions: DataFrame) -> DataFrame:
    return V.regression_metrics(predictions, "y", "pred", ["experiment", "fold"])


def regression_summary(fold_scores: DataFrame, counts: Mapping[str, int]) -> DataFrame:
    """Result table: mean and deviation of MAE, RMSE and R2, 4 digits, smallest MAE first."""
    s = V.fold_summary(fold_scores, ["mae", "rmse", "r2"])
    names = ["mae", "rmse", "r2", "mae_std", "rmse_std", "r2_std"]
    return _with_counts(s, counts).select("experiment", "n_features", *[F.bround(n, 4).alias(n) for n in names]).orderBy("mae", "experiment")


def compare_best_two(fold_scores: DataFrame, metric: str, rank_by: str, largest: bool) -> DataFrame:
    """Paired signed-rank test of the two best experiments over their folds, from kept fold scores."""
    means = fold_scores.groupBy("experiment").agg(F.avg(rank_by).alias("m"))
    order = F.desc("m") if largest else F.asc("m")
    top = [r["experiment"] for r in means.orderBy(order, "experiment").limit(2).collect()]
    pairs = fold_scores.filter(F.col("experiment").isin(top)).groupBy("fold").agg(
        *[F.max(F.when(F.col("experiment") == e, F.col(metric))).alias(n) for e, n in zip(top, ("a", "b"))])
    names = {"best": F.lit(top[0]), "second": F.lit(top[1])}
    return V.wilcoxon(pairs, "a", "b").withColumns(names).withColumn("significant", F.coalesce(F.col("p_value") < 0.05, F.lit(False)))


def holdout_predictions(
    df: DataFrame, id_col: str, y: str, features: Sequence[str], experiments: Sequence[Experiment], classify: bool,
    share_test: float = 0.2, family: str | None = None,
) -> DataFrame:
    """(experiment, id, y, score, pred) of several experiments on one shared split."""
    data = materialize(holdout(prepare(df, id_col, y, features), "id", share_test, "y" if classify else None), "holdout")
    sets = feature_sets(data, features, "y", classify, {e.features for e in experiments}, family)
    train, test, prepared = data.filter("is_test = 0"), data.filter("is_test = 1"), {}
    parts = [
        materialize(fit_predict(train, test, e, sets[e.features], prepared).select(F.lit(e.name).alias("experiment"), "id", "y", "score", "pred"), "holdout")
        for e in experiments
    ]
    return reduce(DataFrame.unionByName, parts)
