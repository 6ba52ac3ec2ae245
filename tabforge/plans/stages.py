"""The six stages over the hospital-encounter layout, from the raw CSV to compared models.

    raw = read_raw(spark, path)
    tables = explore(raw)
    encoded = preprocess(raw)
    baskets = transactions(encoded)

Each stage returns DataFrames; ``sources.tables`` writes them. The operators know nothing of this
layout: all names come from ``tabforge.constants``. ``encounter_id`` stays in the encoded table as the
row key, because rows have no position to align by.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge import constants as K
from tabforge.functions.columns import col
from tabforge.operators import cleaning, cluster_scores, clustering, density, encoding, evaluation, information, profiling, ranking, rules
from tabforge.operators import experiments as X
from tabforge.operators.learners import forest_importance
from tabforge.session import materialize
from tabforge.sources import tables

KEY, PERSON, LABEL, TARGET = "encounter_id", "patient_nbr", "early_readmit", "time_in_hospital"
DIAGNOSES = ["diag_1", "diag_2", "diag_3"]
SWEEP = [0.02, 0.03, 0.05, 0.07, 0.10, 0.15, 0.20]


def raw_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.LongType() if c in K.RAW_INTEGER_COLUMNS else T.StringType()) for c in K.RAW_COLUMNS])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV with its markers turned to null."""
    return cleaning.null_markers(tables.read_csv(spark, path, raw_schema()), K.MISSING_MARKERS)


def _category(c: str):
    return encoding.code_category(col(c), K.CODE_RANGES, K.CODE_FIRST, K.CODE_PREFIXES)


def explore(raw: DataFrame) -> dict[str, DataFrame]:
    """Report tables of the raw data, by name."""
    early = F.col("readmitted") == "<30"
    out = {
        "column_summary": profiling.column_profile(raw),
        "target": profiling.value_shares(raw, "readmitted"),
        "balance": profiling.class_balance(raw, early),
        "duplicate_rows": profiling.duplicate_keys(raw, KEY),
        "repeat_persons": profiling.duplicate_keys(raw, PERSON),
        "encounters_per_person": profiling.group_size_histogram(raw, PERSON, first=10),
        "discharge_counts": profiling.value_shares(raw, "discharge_disposition_id").orderBy("value"),
        "excluded": cleaning.excluded_share(raw, "discharge_disposition_id", K.EXCLUDED_DISCHARGE_IDS),
        "numeric": profiling.describe(raw, K.NUMERIC_COLUMNS),
        "skewness": profiling.skewness(raw, K.NUMERIC_COLUMNS),
        "categorical": profiling.top_values(raw, K.CATEGORICAL_COLUMNS, 10),
        "medication": profiling.level_pivot(raw, K.MEDICATION_COLUMNS, ["No", "Steady", "Up", "Down"]),
        "age": profiling.domain_counts(raw, "age", K.AGE_BANDS),
        "weight": profiling.sparse_report(raw, "weight"),
        "correlation": profiling.correlation_matrix(raw, K.NUMERIC_COLUMNS),
        "early_by_age": profiling.rate_by_domain(raw, "age", early, K.AGE_BANDS),
        "quality": profiling.quality_report(raw, K.MEDICATION_COLUMNS, "No", K.ID_COLUMNS, ("gender", "Unknown/Invalid")),
    }
    mapped = raw.select(*[_category(c).alias(c) for c in DIAGNOSES])
    out["diagnoses"] = profiling.top_values(mapped, DIAGNOSES, 50)
    return out


def preprocess(raw: DataFrame) -> DataFrame:
    """Encoded, all-numeric table: one row per person, the first surviving encounter.

    Two fit steps (near-constant columns, category levels) need values from the data; the surviving rows
    are written once and both read that table.
    """
    df = cleaning.exclude_values(raw, "discharge_disposition_id", K.EXCLUDED_DISCHARGE_IDS)
    df = cleaning.exclude_values(df, "gender", ["Unknown/Invalid"])
    df = materialize(cleaning.first_per_key(df, PERSON, [KEY]), "surviving")
    constant = cleaning.near_constant(df, K.MEDICATION_COLUMNS, "No", 0.98)
    dropped = {*K.DROPPED_COLUMNS, *constant}
    meds = [c for c in K.MEDICATION_COLUMNS if c not in dropped]

    flags = {c: encoding.level_flag(col(c)) for c in meds}
    flags |= {"change": encoding.equals_flag(F.col("change"), "Ch"), "diabetesMed": encoding.equals_flag(F.col("diabetesMed"), "Yes"),
              "gender": encoding.equals_flag(F.col("gender"), "Male")}
    groups = {
        "race": F.coalesce("race", F.lit("Unknown")),
        "admission_type": encoding.map_labels(F.col("admission_type_id").cast("int"), K.ADMISSION_TYPES),
        "discharge_disposition": encoding.map_labels(F.col("discharge_disposition_id").cast("int"), K.DISCHARGE_DISPOSITIONS),
        "admission_source": encoding.map_labels(F.col("admission_source_id").cast("int"), K.ADMISSION_SOURCES),
        **{f"{c}_cat": _category(c) for c in DIAGNOSES},
    }
    replaced = {"race", "age", "readmitted", "admission_type_id", "discharge_disposition_id", "admission_source_id", *DIAGNOSES}
    kept = [c for c in df.columns if c not in dropped | replaced]
    coded = df.select(
        KEY, *[(flags[c] if c in flags else col(c)).alias(c) for c in kept],
        encoding.equals_flag(F.col("readmitted"), "<30").alias(LABEL),
        encoding.ordinal(F.col("age"), K.AGE_BANDS).alias("age_num"),
        *[c.alias(n) for n, c in groups.items()],
    ).withColumn("n_active_meds", encoding.active_count(meds))
    coded = coded.select(*[c for c in coded.columns if c not in groups], *groups)
    hot = encoding.apply_one_hot(coded, encoding.fit_levels(coded, list(groups)))
    days = F.col("time_in_hospital")
    featured = hot.withColumns({
        "total_visits": F.col("number_outpatient") + F.col("number_emergency") + F.col("number_inpatient"),
        "procedures_per_day": encoding.ratio(F.col("num_procedures"), days),
        "meds_per_day": encoding.ratio(F.col("num_medications"), days),
        "lab_per_day": encoding.ratio(F.col("num_lab_procedures"), days),
    })
    return featured.na.fill(0)


def features_of(encoded: DataFrame, *without: str) -> list[str]:
    return [c for c in encoded.columns if c not in {KEY, *without}]


def transactions(encoded: DataFrame) -> DataFrame:
    """0/1 table for rule mining: two-valued columns, the label, and measures above their median."""
    encoded = materialize(encoded, "encoded")
    binary = encoding.two_valued(encoded, features_of(encoded, LABEL))
    measures = [c for c in [*K.NUMERIC_COLUMNS, "age_num", "n_active_meds", "total_visits"] if c in encoded.columns]
    high = encoding.apply_above(encoded, encoding.fit_medians(encoded, measures))
    chosen = high.select(KEY, *[col(c) for c in binary], LABEL, *[col(f"{c}_high") for c in measures])
    return tables.as_flags(chosen, keep=[KEY])


def mine(flags: DataFrame, min_support: float = 0.05, min_confidence: float = 0.5, min_lift: float = 1.0) -> dict[str, DataFrame]:
    """Itemsets, rules and the support sweep."""
    baskets = rules.baskets_from_flags(flags, features_of(flags))
    itemsets = materialize(rules.frequent_itemsets(baskets, min_support, 4), "itemsets")
    found = materialize(rules.association_rules(itemsets, min_confidence, min_lift), "rules")
    sweep = rules.frequent_itemsets(baskets, min(SWEEP), 3)
    return {
        "itemsets": itemsets, "lengths": rules.itemset_lengths(itemsets), "top_itemsets": rules.top_itemsets(itemsets, 15),
        "association_rules_all": rules.rules_as_text(found), "association_rules_top50": rules.rules_as_text(rules.top_rules(found, 50)),
        "association_rules_readmit": rules.rules_as_text(rules.top_rules(rules.rules_about(found, LABEL), 20)),
        "from_label": rules.rules_as_text(rules.rules_about(found, LABEL, "antecedents")),
        "ranges": rules.measure_ranges(found), "sensitivity": rules.support_sweep(sweep, SWEEP, min_confidence),
    }


def _profiles(labelled: DataFrame, encoded: DataFrame, label: str) -> DataFrame:
    columns = [c for c in K.PROFILE_COLUMNS if c in encoded.columns]
    return cluster_scores.cluster_profile(encoded.join(labelled.select(KEY, label), KEY), label, columns)


def cluster(
    encoded: DataFrame, ks: Sequence[int] = range(2, 12), hier_ks: Sequence[int] = range(2, 9), n_init: int = 10,
    eps: Sequence[float] = (0.3, 0.5, 0.7, 1.0, 1.5, 2.0), min_samples: Sequence[int] = (5, 10, 20, 50), components: int = 10,
) -> dict[str, DataFrame]:
    """K-means, agglomerative and density clusterings with scores, profiles and rates."""
    encoded = materialize(encoded, "encoded")
    columns = [c for c in K.CLUSTER_COLUMNS if c in encoded.columns]
    elbow, _ = clustering.kmeans_sweep(encoded, KEY, columns, ks, n_init)
    elbow = materialize(elbow, "elbow")
    k = clustering.best_k(elbow)
    means = clustering.kmeans_labels(encoded, KEY, columns, [k], 2 * n_init).select(KEY, F.col(f"k{k}").alias("kmeans_label"))
    tree_scores, trees = clustering.agglomerative_sweep(encoded, KEY, columns, ks=hier_ks)
    tree_scores = materialize(tree_scores, "trees")
    out = {"kmeans_elbow": elbow, "kmeans_cluster_profiles": _profiles(means, encoded, "kmeans_label"), "hierarchical_scores": tree_scores}
    best = evaluation.best_row(tree_scores, "silhouette", "k").collect()
    if best:
        name = f"{best[0]['linkage']}_k{best[0]['k']}"
        out["hierarchical_cluster_profiles"] = _profiles(trees.select(KEY, F.col(name).alias("hier_label")), encoded, "hier_label")
    reduced = materialize(clustering.pca_project(encoded, KEY, columns, k=min(components, len(columns))), "reduced")
    labelled, grid = density.dbscan_grid(reduced, "id", "vec", eps, min_samples)
    labelled = materialize(labelled, "labels")
    report = materialize(density.grid_report(labelled, grid), "grid")
    chosen = density.best_run(report)
    if chosen not in grid:  # the fallback setting is outside the grid
        labelled, grid = density.dbscan_grid(reduced, "id", "vec", [chosen[0]], [chosen[1]])
    final = labelled.select(F.col("id").alias(KEY), F.col("labels")[grid.index(chosen)].alias("dbscan_label"))
    out["dbscan_scores"] = report.drop("run")
    out["dbscan_rates"] = cluster_scores.cluster_rates(encoded.join(final, KEY), "dbscan_label", LABEL)
    out["clustering_comparison"] = clustering.compare_methods(encoded, KEY, columns, n_init)
    return out


def _published(results: DataFrame, names: dict[str, str]) -> DataFrame:
    """Results with ``published``: the experiment's name in the published tables, null for one that isn't there."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return results.withColumn("published", F.try_element_at(known, F.col("experiment")))


def _rankings(df: DataFrame, features: Sequence[str], y: str, classify: bool, trees: int) -> DataFrame:
    f = ranking.anova_f(df, features, y) if classify else ranking.regression_f(df, features, y)
    mi = information.mutual_information(df, features, y, classify)
    forest = forest_importance(df, features, y, classify, trees).withColumnRenamed("importance", "rf_importance")
    return ranking.rank_table([f, mi, forest], "rf_importance")


def classify(encoded: DataFrame, experiments: Sequence[X.Experiment] = tuple(X.CLASSIFIERS), trees: int = 100) -> dict[str, DataFrame]:
    """Feature ranking, cross-validated classifiers, the best model's threshold report, and the paired test."""
    encoded = materialize(tables.require_columns(encoded, [LABEL]), "encoded")
    features = features_of(encoded, LABEL)
    predictions, counts = X.cross_validate(encoded, KEY, LABEL, features, experiments, classify=True)
    folds = materialize(X.classification_folds(predictions), "folds")
    results = materialize(X.classification_summary(folds, counts), "results")
    best = X.find_experiment(results.orderBy(F.desc("roc_auc"), "experiment").first()["experiment"], experiments, "forest_100_balanced")
    scored = X.holdout_predictions(encoded, KEY, LABEL, features, [best], classify=True)
    threshold = evaluation.best_threshold(scored, "y", "score").first()["threshold"]
    out = {
        "feature_rankings": _rankings(encoded, features, LABEL, True, trees), "classification_results": _published(results, K.PUBLISHED_CLASSIFIERS),
        "thresholds": evaluation.threshold_metrics(scored, "y", "score", [0.5, threshold], ["experiment"]),
        "class_report": evaluation.class_report(scored.withColumn("p", (F.col("score") >= threshold).cast("int")), "y", "p"),
        "roc": evaluation.roc_points(scored, "y", "score", ["experiment"]), "f1_curve": evaluation.f1_curve(scored, "y", "score", ["experiment"]),
    }
    if len(experiments) > 1:
        out["significance"] = X.compare_best_two(folds, "roc_auc", "roc_auc", largest=True)
    return out


def regress(encoded: DataFrame, experiments: Sequence[X.Experiment] = tuple(X.REGRESSORS), trees: int = 100) -> dict[str, DataFrame]:
    """The same for the length of stay, without the ratios derived from it."""
    encoded = materialize(tables.require_columns(encoded, [TARGET]), "encoded")
    features = features_of(encoded, TARGET, *K.LEAKY_COLUMNS)
    predictions, counts = X.cross_validate(encoded, KEY, TARGET, features, experiments, classify=False, family="discharge_disposition")
    folds = materialize(X.regression_folds(predictions), "folds")
    results = materialize(X.regression_summary(folds, counts), "results")
    best = X.find_experiment(results.orderBy("mae", "experiment").first()["experiment"], experiments, "least_squares_all")
    scored = X.holdout_predictions(encoded, KEY, TARGET, features, [best], classify=False, family="discharge_disposition")
    shapes = [profiling.fixed_histogram(scored, c, 0.5, 1.0, 15).withColumn("series", F.lit(c)) for c in ("y", "pred")]
    out = {
        "target": tables.target_summary(encoded, TARGET), "target_counts": tables.target_counts(encoded, TARGET), "target_box": profiling.box_stats(encoded, [TARGET]),
        "importance": X.model_importance(encoded, KEY, TARGET, features, best, classify=False, family="discharge_disposition"),
        "regression_feature_rankings": _rankings(encoded, features, TARGET, False, trees), "regression_results": _published(results, K.PUBLISHED_REGRESSORS),
        "holdout": evaluation.regression_metrics(scored, "y", "pred", ["experiment"]), "errors": evaluation.error_summary(scored, "y", "pred"),
        "residual_histogram": profiling.histogram(evaluation.residuals(scored, "y", "pred"), "residual", 50),
        "distributions": reduce(DataFrame.unionByName, shapes),
    }
    if len(experiments) > 1:
        out["significance"] = X.compare_best_two(folds, "rmse", "mae", largest=False)
    return out
