"""Metrics computed from a predictions table: one row per scored row with label, prediction or score.

``by`` names columns such as model or fold; each group gets its own metrics, so a whole comparison is
one job. Labels are 0/1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import share
from tabforge.operators.ordering import join_same, running_totals


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1 of the positive class; an empty denominator gives 0."""
    zero = F.lit(0.0)
    return {
        "accuracy": share(tp + tn, tp + fp + fn + tn),
        "precision": F.coalesce(share(tp, tp + fp), zero),
        "recall": F.coalesce(share(tp, tp + fn), zero),
        "f1": F.coalesce(share(2 * tp, 2 * tp + fp + fn), zero),
    }


def _cells(y: str, hit: Column) -> tuple[Column, Column, Column, Column]:
    pos = F.col(y) == 1
    return F.count_if(pos & hit), F.count_if(~pos & hit), F.count_if(pos & ~hit), F.count_if(~pos & ~hit)


def classification_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _rates(*_cells(y, F.col(pred) == 1)).items()])


def threshold_metrics(df: DataFrame, y: str, score: str, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``classification_metrics`` at several score thresholds (score >= t is positive), in one pass."""
    cells = []
    for t in thresholds:
        tp, fp, fn, tn = _cells(y, F.col(score) >= F.lit(float(t)))
        cells.append(F.struct(F.lit(float(t)).alias("threshold"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
                              *[c.alias(n) for n, c in _rates(tp, fp, fn, tn).items()]))
    names = [f"_t{i}" for i in range(len(cells))]
    wide = df.groupBy(*by).agg(*[c.alias(n) for n, c in zip(names, cells)])
    return wide.select(*by, F.inline(F.array(*names)))


def _score_counts(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score: everything the curve needs, pre-aggregated."""
    pos = F.count_if(F.col(y) == 1)
    return df.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(pos.alias("pos"), (F.count("*") - pos).alias("neg"))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; equal scores count half. Null when a class is missing."""
    below = running_totals(_score_counts(df, y, score, by), "threshold", {"neg_below": "neg"}, by, exclusive=True)
    area = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return below.groupBy(*by).agg(F.try_divide(area, (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc"))


def curve_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """threshold, tp, fp, n_pos, n_neg for every distinct score, cumulated from the highest score down."""
    counts = _score_counts(df, y, score, by)
    points = running_totals(counts, "threshold", {"tp": "pos", "fp": "neg"}, by, descending=True)
    totals = points.groupBy(*by).agg(F.max("tp").alias("n_pos"), F.max("fp").alias("n_neg"))
    # one row per model or fold
    joined = join_same(points, totals, by) if by else points.withColumns({
        "n_pos": totals.select("n_pos").scalar(), "n_neg": totals.select("n_neg").scalar()})
    return joined.select(*by, "threshold", "tp", "fp", "n_pos", "n_neg")


def roc_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """fpr, tpr, threshold at every distinct score, with the starting point (0, 0) at an infinite threshold.

    All points are kept; leaving out collinear ones would not change the curve.
    """
    points = curve_points(df, y, score, by).select(
        *by, "threshold", share(F.col("fp"), F.col("n_neg")).alias("fpr"), share(F.col("tp"), F.col("n_pos")).alias("tpr")
    )
    start = points.select(*by).distinct() if by else points.groupBy().count()
    zero = F.lit(0.0)
    start = start.select(*by, F.lit(float("inf")).alias("threshold"), zero.alias("fpr"), zero.alias("tpr"))
    return points.unionByName(start)


def f1_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """F1 at every distinct score used as threshold."""
    p = curve_points(df, y, score, by)
    return p.withColumn("f1", F.coalesce(share(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("n_pos")), F.lit(0.0)))


def best_threshold(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest F1; the highest threshold wins a tie."""
    best = F.max(F.struct("f1", "threshold")).alias("b")
    return f1_curve(df, y, score, by).groupBy(*by).agg(best).select(*by, "b.threshold", "b.f1")


def confusion(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(y, pred, n) for all four cells, empty ones as 0."""
    cells = [F.struct(F.lit(a).alias("y"), F.lit(b).alias("pred"), F.count_if((F.col(y) == a) & (F.col(pred) == b)).alias("n"))
             for a in (0, 1) for b in (0, 1)]
    names = [f"_c{i}" for i in range(4)]
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in zip(names, cells)]).select(*by, F.inline(F.array(*names)))


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted average rows."""
    tp, fp, fn, tn = _cells(y, F.col(pred) == 1)
    c = df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    one, zero = _rates(tp, fp, fn, tn), _rates(tn, fn, fp, tp)
    s1, s0 = tp + fn, tn + fp
    def row(name, f, support):
        return F.struct(F.lit(name).alias("class"), *[f(m).alias(m) for m in ("precision", "recall", "f1")], support.alias("support"))
    rows = [
        row("0", lambda m: zero[m], s0), row("1", lambda m: one[m], s1),
        row("accuracy", lambda m: one["accuracy"], s0 + s1),
        row("macro avg", lambda m: (zero[m] + one[m]) / 2, s0 + s1),
        row("weighted avg", lambda m: share(zero[m] * s0 + one[m] * s1, s0 + s1), s0 + s1),
    ]
    return c.select(F.inline(F.array(*rows)))


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 in one pass; R2 is null for a constant target."""
    e = F.col(y) - F.col(pred)
    sse, sst = F.sum(e * e), F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.try_divide(sse, sst)).alias("r2"))


def residuals(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(pred))


def error_summary(df: DataFrame, y: str, pred: str, large: float = 3.0) -> DataFrame:
    """Mean and population deviation of the residuals, count and share of large ones."""
    e = F.col(y) - F.col(pred)
    n_large = F.count_if(F.abs(e) > large)
    return df.agg(F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), n_large.alias("n_large"),
                  (share(n_large, F.count("*")) * 100).alias("pct_large"))


def fold_summary(scores: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("experiment",)) -> DataFrame:
    """Mean and population deviation of fold metrics per experiment."""
    return scores.groupBy(*by).agg(*[f(m).alias(f"{m}{s}") for m in metrics for f, s in ((F.avg, ""), (F.stddev_pop, "_std"))])


def best_row(scores: DataFrame, metric: str, order: str, largest: bool = True) -> DataFrame:
    """The row with the best non-null metric; the smallest ``order`` value wins a tie."""
    key = F.desc(metric) if largest else F.asc(metric)
    return scores.na.drop(subset=[metric]).orderBy(key, order).limit(1)


# --- paired test -----------------------------------------------------------------------------------

def signed_ranks(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n non-zero differences, n zero ones, W+, W-, tie term sum(t^3 - t).

    Equal absolute differences share their mean rank: count per absolute value, then a running count.
    """
    d = F.col(a) - F.col(b)
    counts = df.filter(d.isNotNull()).groupBy(F.abs(d).alias("size")).agg(
        F.count_if(d > 0).alias("plus"), F.count_if(d < 0).alias("minus"), F.count("*").alias("t"))
    counts = counts.withColumn("used", F.when(F.col("size") > 0, F.col("t")).otherwise(0))
    ranked = running_totals(counts, "size", {"before": "used"}, exclusive=True)
    rank = F.col("before") + (F.col("t") + 1) / 2
    live = F.col("size") > 0
    t = F.col("t").cast("double")
    total = lambda c: F.coalesce(F.sum(F.when(live, c)), F.lit(0.0))
    return ranked.agg(
        F.coalesce(F.sum("used"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(~live, F.col("t"))), F.lit(0)).alias("n_zero"),
        total(rank * F.col("plus")).alias("w_plus"), total(rank * F.col("minus")).alias("w_minus"),
        total(t * t * t - t).alias("tie_term"),
    )


def _exact_p(n: int, w: float) -> float:
    """Two-sided exact p of min(W+, W-) = w over ranks 1..n, by counting sign patterns per rank sum."""
    ways = [1] + [0] * (n * (n + 1) // 2)
    for r in range(1, n + 1):
        for s in range(len(ways) - 1, r - 1, -1):
            ways[s] += ways[s - r]
    return min(1.0, 2 * sum(ways[: int(math.floor(w)) + 1]) / 2 ** n)


def wilcoxon(df: DataFrame, a: str, b: str) -> DataFrame:
    """Paired signed-rank test: statistic = min(W+, W-), two-sided p, n, z.

    Zero differences are dropped. Up to 50 pairs without ties or zeros the p value is exact, else it is
    the tie-corrected normal approximation. No difference at all gives a null p: the test is skipped.
    """
    r = signed_ranks(df, a, b).first()  # one aggregate row
    n, stat = int(r["n"]), min(r["w_plus"], r["w_minus"])
    p = z = None
    if n > 0:
        var = n * (n + 1) * (2 * n + 1) / 24 - r["tie_term"] / 48
        z = (stat - n * (n + 1) / 4) / math.sqrt(var) if var > 0 else 0.0
        exact = n <= 50 and r["n_zero"] == 0 and r["tie_term"] == 0
        p = _exact_p(n, stat) if exact else math.erfc(abs(z) / math.sqrt(2))
    return df.sparkSession.createDataFrame([(n, float(stat), z, p)], "n int, statistic double, z double, p_value double")
