"""Scores that rank features against a class or a numeric target, long form (feature, score)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import col, correlation
from tabforge.operators.encoding import apply_standard, fit_standard
from tabforge.operators.ordering import exact_quantiles
from tabforge.session import materialize


def variance_filter(df: DataFrame, features: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """(feature, variance, kept) of the standardised features: only constants fall below."""
    scaled = apply_standard(df, fit_standard(df, features))
    wide = scaled.agg(*[F.var_pop(col(c)).alias(c) for c in features])
    return wide.unpivot([], [col(c) for c in features], "feature", "variance").withColumn("kept", (F.col("variance") > threshold).cast("int"))


def anova_f(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """(feature, f_score): between-class over within-class variance; null for a constant feature.

    One pass: mean and variance of every feature per class, then arithmetic on (classes x features) rows.
    """
    per_class = df.groupBy(F.col(y).alias("_class")).agg(*[
        F.struct(F.count(col(c)).cast("double").alias("n"), F.avg(col(c)).alias("m"), F.var_pop(col(c)).alias("v")).alias(c) for c in features
    ])
    long = per_class.unpivot("_class", [col(c) for c in features], "feature", "s")
    stats = long.groupBy("feature").agg(F.collect_list("s").alias("s"))
    def over(f) -> Column:
        return F.aggregate("s", F.lit(0.0), lambda acc, s: acc + f(s))
    n, k = F.col("n"), F.size("s")
    between = over(lambda s: s["n"] * (s["m"] - F.col("mean")) * (s["m"] - F.col("mean"))) / (k - 1)
    within = over(lambda s: s["n"] * s["v"]) / (n - k)
    return (
        stats.withColumn("n", over(lambda s: s["n"])).withColumn("mean", over(lambda s: s["n"] * s["m"]) / F.col("n"))
        .select("feature", F.when(within > 0, between / within).alias("f_score"))
    )


def regression_f(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """(feature, f_score) = r^2 / (1 - r^2) * (n - 2); null for a constant feature."""
    wide = df.agg(*[F.struct(correlation(col(c), col(y)).alias("r"), F.count("*").alias("n")).alias(c) for c in features])
    long = wide.unpivot([], [col(c) for c in features], "feature", "s").select("feature", "s.*")
    r2 = F.col("r") * F.col("r")
    return long.select("feature", F.try_divide(r2 * (F.col("n") - 2), 1 - r2).alias("f_score"))


def bin_cuts(df: DataFrame, columns: Sequence[str], bins: int = 32) -> dict[str, list[float]]:
    """Exact quantile cuts per column: (columns x (bins - 1)) numbers."""
    cuts: dict[str, list[float]] = {c: [] for c in columns}
    for r in exact_quantiles(df, columns, [i / bins for i in range(1, bins)]).collect():
        cuts[r["column"]].append(r["quantile"])
    return {c: sorted(set(v)) for c, v in cuts.items()}


def bin_of(c: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts below the value."""
    if not cuts:
        return F.lit(0)
    points = F.array(*[F.lit(float(v)) for v in cuts])
    return F.size(F.filter(points, lambda p: p < c))


def mutual_information(df: DataFrame, features: Sequence[str], y: str, bins: int = 32, numeric_target: bool = False) -> DataFrame:
    """(feature, mutual_info) in nats, plug-in estimate over quantile bins.

    A feature with few values gets a bin per value wherever the cuts separate them. The pair counts are
    one pre-aggregated shuffle of (feature, bin, class); the logarithms run on the counts.
    """
    targets = [y] if numeric_target else []
    df = materialize(df.select(*[col(c) for c in {*features, y}]), "ranked")  # read for the cuts and for the counts
    cuts = bin_cuts(df, [*features, *targets], bins)
    label = bin_of(col(y).cast("double"), cuts[y]) if numeric_target else col(y)
    binned = df.select(label.alias("_y"), *[bin_of(col(c).cast("double"), cuts[c]).alias(c) for c in features])
    cells = binned.unpivot("_y", [col(c) for c in features], "feature", "_x").groupBy("feature", "_x", "_y").agg(F.count("*").alias("n"))
    by_x, by_y, all_of = Window.partitionBy("feature", "_x"), Window.partitionBy("feature", "_y"), Window.partitionBy("feature")
    counted = cells.withColumns({"nx": F.sum("n").over(by_x), "ny": F.sum("n").over(by_y), "total": F.sum("n").over(all_of)})
    part = F.col("n") / F.col("total") * F.ln(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))
    return counted.groupBy("feature").agg(F.greatest(F.sum(part), F.lit(0.0)).alias("mutual_info"))


def top_features(scores: DataFrame, method: str, score: str, n: int) -> DataFrame:
    """(method, feature, score, rank) of the best ``n`` features; ties by name, nulls last."""
    w = Window.orderBy(F.desc_nulls_last("score"), "feature")
    top = scores.select("feature", F.col(score).alias("score")).orderBy(F.desc_nulls_last("score"), "feature").limit(n)
    return top.select(F.lit(method).alias("method"), "feature", "score", F.row_number().over(w).alias("rank"))


def rank_table(tables: Sequence[DataFrame], order: str) -> DataFrame:
    """Join score tables on the feature and sort by one score, best first. Each has one row per feature."""
    joined = reduce(lambda a, b: a.join(b, "feature", "full"), tables)
    return joined.orderBy(F.desc_nulls_last(order), "feature")
