"""Queries over metrics, thresholds, folds and feature scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.frames_sql import DOCUMENTS, SCORED, VISITS
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import evaluation as V
from tabforge.operators import folds, information, ranking
from tabforge.plans import frames
from tabforge.plans.frames import DOCUMENT_COLUMNS
from tabforge.session import materialize
from tabforge.sources.tables import load_table


def _round(df, *names):
    return df.withColumns({n: rounded(F.col(n)) for n in names})


def _predicted(spark, sf):
    return frames.scored_visits(spark, sf).withColumn("pred_class", (F.col("score") >= 0.5).cast("int"))


def _models(spark, sf):
    """Long form: the two score columns as two models."""
    df = frames.scored_visits(spark, sf).select("visit_id", "fold", "y", "score", "score_b")
    return df.unpivot(["visit_id", "fold", "y"], ["score", "score_b"], "model", "p")


MODELS_SQL = SCORED + """,
models AS (SELECT visit_id, fold, y, 'score' AS model, score AS p FROM scored UNION ALL SELECT visit_id, fold, y, 'score_b', score_b FROM scored)"""


@query("confusion", f"""WITH {SCORED}, c AS (SELECT a.y::INT AS y, b.p::INT AS pred FROM (VALUES (0),(1)) a(y), (VALUES (0),(1)) b(p))
SELECT c.y, c.pred, count(visit_id) AS n FROM c LEFT JOIN scored s ON s.y = c.y AND (s.score >= 0.5)::INT = c.pred GROUP BY 1, 2""")
def confusion(spark, sf):
    """V5 E19."""
    return V.confusion(_predicted(spark, sf), "y", "pred_class")


_REPORT = """k AS (SELECT count(*) FILTER (y = 1 AND score >= 0.5)::DOUBLE tp, count(*) FILTER (y = 0 AND score >= 0.5)::DOUBLE fp,
  count(*) FILTER (y = 1 AND score < 0.5)::DOUBLE fn, count(*) FILTER (y = 0 AND score < 0.5)::DOUBLE tn FROM scored),
m AS (SELECT *, tp/(tp+fp) p1, tp/(tp+fn) r1, tn/(tn+fn) p0, tn/(tn+fp) r0, 2*tp/(2*tp+fp+fn) f1, 2*tn/(2*tn+fp+fn) f0, tp+fn s1, tn+fp s0, tp+fp+fn+tn s FROM k)"""


@query("class_report", f"""WITH {SCORED}, {_REPORT}
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0::BIGINT AS support FROM m
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1::BIGINT FROM m
UNION ALL SELECT 'accuracy', round((tp+tn)/s, 6), round((tp+tn)/s, 6), round((tp+tn)/s, 6), s::BIGINT FROM m
UNION ALL SELECT 'macro avg', round((p0+p1)/2, 6), round((r0+r1)/2, 6), round((f0+f1)/2, 6), s::BIGINT FROM m
UNION ALL SELECT 'weighted avg', round((p0*s0+p1*s1)/s, 6), round((r0*s0+r1*s1)/s, 6), round((f0*s0+f1*s1)/s, 6), s::BIGINT FROM m""")
def class_report(spark, sf):
    """V6."""
    return _round(V.class_report(_predicted(spark, sf), "y", "pred_class"), "precision", "recall", "f1")


@query("fold_metrics", f"""WITH {MODELS_SQL}, k AS (SELECT model, fold, count(*) FILTER (y = 1 AND p >= 0.5)::DOUBLE tp, count(*) FILTER (y = 0 AND p >= 0.5)::DOUBLE fp,
  count(*) FILTER (y = 1 AND p < 0.5)::DOUBLE fn, count(*) FILTER (y = 0 AND p < 0.5)::DOUBLE tn FROM models GROUP BY 1, 2)
SELECT model, fold, round((tp+tn)/(tp+fp+fn+tn), 6) AS accuracy, round(tp/(tp+fp), 6) AS precision, round(tp/(tp+fn), 6) AS recall,
  round(2*tp/(2*tp+fp+fn), 6) AS f1 FROM k""")
def fold_metrics(spark, sf):
    """All models and folds in one job."""
    df = _models(spark, sf).withColumn("pred_class", (F.col("p") >= 0.5).cast("int"))
    return _round(V.classification_metrics(df, "y", "pred_class", ["model", "fold"]), "accuracy", "precision", "recall", "f1")


_AUC = """a AS (SELECT model, fold, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM models GROUP BY 1, 2, 3),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM a),
auc AS (SELECT model, fold, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg))::DOUBLE AS roc_auc FROM b GROUP BY 1, 2)"""


@query("auc", f"WITH {MODELS_SQL}, {_AUC} SELECT model, fold, round(roc_auc, 6) AS roc_auc FROM auc")
def auc(spark, sf):
    """V2."""
    return _round(V.roc_auc(_models(spark, sf), "y", "p", ["model", "fold"]), "roc_auc")


@query("fold_summary", f"WITH {MODELS_SQL}, {_AUC} SELECT model, round(avg(roc_auc), 6) AS roc_auc, round(stddev_pop(roc_auc), 6) AS roc_auc_std FROM auc GROUP BY 1")
def fold_summary(spark, sf):
    """A27."""
    scores = V.roc_auc(_models(spark, sf), "y", "p", ["model", "fold"])
    return _round(V.fold_summary(scores, ["roc_auc"], ["model"]), "roc_auc", "roc_auc_std")


@query("best_row", f"""WITH {MODELS_SQL}, {_AUC} SELECT model, fold, round(roc_auc, 6) AS roc_auc FROM auc ORDER BY auc.roc_auc DESC, fold LIMIT 1""")
def best_row(spark, sf):
    """T4 T8 F13."""
    scores = V.roc_auc(_models(spark, sf), "y", "p", ["model", "fold"])
    unscored = scores.limit(1).withColumn("roc_auc", F.lit(None).cast("double"))
    return _round(V.best_row(scores.unionByName(unscored), "roc_auc", "fold"), "roc_auc")


@query("roc_points", f"""WITH {MODELS_SQL}, a AS (SELECT model, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM models GROUP BY 1, 2),
b AS (SELECT model, p, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
  FROM a WINDOW w AS (PARTITION BY model ORDER BY p DESC))
SELECT model, round(p, 6) AS threshold, round(fp::DOUBLE / nn, 6) AS fpr, round(tp::DOUBLE / np, 6) AS tpr FROM b
UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM models""")
def roc_points(spark, sf):
    """V3 V8: one curve per model."""
    points = V.roc_points(_models(spark, sf), "y", "p", ["model"])
    threshold = F.when(F.col("threshold") < float("inf"), rounded(F.col("threshold"))).otherwise(F.col("threshold"))
    return _round(points.withColumn("threshold", threshold), "fpr", "tpr")


_BEST = """a AS (SELECT model, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM models GROUP BY 1, 2),
b AS (SELECT model, p, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS np
  FROM a WINDOW w AS (PARTITION BY model ORDER BY p DESC)),
c AS (SELECT model, p, 2 * tp::DOUBLE / (tp + fp + np) AS f1 FROM b),
best AS (SELECT model, p AS threshold, f1 FROM c QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, p DESC) = 1)"""


@query("best_threshold", f"WITH {MODELS_SQL}, {_BEST} SELECT model, round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM best")
def best_threshold(spark, sf):
    """V4 T8."""
    return _round(V.best_threshold(_models(spark, sf), "y", "p", ["model"]), "threshold", "f1")


@query("threshold_effect", f"""WITH {MODELS_SQL}, {_BEST}, t AS (SELECT 0.5::DOUBLE AS t UNION ALL SELECT threshold FROM best WHERE model = 'score'),
k AS (SELECT t, count(*) FILTER (y = 1 AND score >= t) AS tp, count(*) FILTER (y = 0 AND score >= t) AS fp,
  count(*) FILTER (y = 1 AND score < t) AS fn, count(*) FILTER (y = 0 AND score < t) AS tn FROM scored, t GROUP BY 1)
SELECT round(t, 6) AS threshold, tp, fp, fn, tn, round((tp+tn)::DOUBLE/(tp+fp+fn+tn), 6) AS accuracy, round(tp::DOUBLE/(tp+fp), 6) AS precision,
  round(tp::DOUBLE/(tp+fn), 6) AS recall, round(2*tp::DOUBLE/(2*tp+fp+fn), 6) AS f1 FROM k""")
def threshold_effect(spark, sf):
    """The default and the F1-optimal threshold side by side."""
    df = frames.scored_visits(spark, sf).select("y", "score")
    best = V.best_threshold(df, "y", "score").first()["threshold"]
    return _round(V.threshold_metrics(df, "y", "score", [0.5, best]), "threshold", "accuracy", "precision", "recall", "f1")


@query("reg_metrics", f"""WITH {SCORED} SELECT fold, round(avg(abs(n_lines - pred)), 6) AS mae, round(sqrt(avg((n_lines - pred) ** 2)), 6) AS rmse,
  round(1 - sum((n_lines - pred) ** 2) / (var_pop(n_lines) * count(*)), 6) AS r2 FROM scored GROUP BY 1""")
def reg_metrics(spark, sf):
    """V7."""
    return _round(V.regression_metrics(frames.scored_visits(spark, sf), "n_lines", "pred", ["fold"]), "mae", "rmse", "r2")


@query("residuals", f"WITH {SCORED} SELECT visit_id, n_lines, round(pred, 6) AS pred, round(n_lines - pred, 6) + 0.0 AS residual FROM scored")
def residuals(spark, sf):
    """V11."""
    return _round(V.residuals(frames.scored_visits(spark, sf).select("visit_id", "n_lines", "pred"), "n_lines", "pred"), "pred", "residual")


@query("error_summary", f"""WITH {SCORED} SELECT round(avg(n_lines - pred), 6) + 0.0 AS mean, round(stddev_pop(n_lines - pred), 6) AS std,
  count(*) FILTER (abs(n_lines - pred) > 1) AS n_large, round(100.0 * count(*) FILTER (abs(n_lines - pred) > 1) / count(*), 6) AS pct_large FROM scored""")
def error_summary(spark, sf):
    """A26 F12."""
    return _round(V.error_summary(frames.scored_visits(spark, sf), "n_lines", "pred", 1.0), "mean", "std", "pct_large")


@query("wilcoxon", f"""WITH {MODELS_SQL}, {_AUC}, d AS (SELECT fold, max(roc_auc) FILTER (model = 'score') - max(roc_auc) FILTER (model = 'score_b') AS d FROM auc GROUP BY 1),
r AS (SELECT d, row_number() OVER (ORDER BY abs(d)) AS rk FROM d WHERE d <> 0),
s AS (SELECT least(coalesce(sum(rk) FILTER (d > 0), 0), coalesce(sum(rk) FILTER (d < 0), 0)) AS w, count(*) AS n FROM r),
e AS (SELECT m, (m & 1) * 1 + ((m >> 1) & 1) * 2 + ((m >> 2) & 1) * 3 + ((m >> 3) & 1) * 4 + ((m >> 4) & 1) * 5 AS total FROM range(32) t(m))
SELECT any_value(n)::INT AS n, any_value(w)::DOUBLE AS statistic, least(1.0, 2.0 * count(*) FILTER (total <= w) / 32)::DOUBLE AS p_value FROM e, s""")
def wilcoxon(spark, sf):
    """V9: fold-wise AUC of two models; exact p over all sign patterns."""
    auc_wide = V.roc_auc(_models(spark, sf), "y", "p", ["model", "fold"]).groupBy("fold").pivot("model", ["score", "score_b"]).agg(F.max("roc_auc"))
    return V.wilcoxon(auc_wide, "score", "score_b").drop("z")


@query("signed_ranks", f"""WITH {SCORED}, d AS (SELECT round(n_lines - pred, 6) AS d FROM scored),
r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2 AS rk FROM d WHERE d <> 0),
t AS (SELECT sum(k::DOUBLE ** 3 - k) AS tie FROM (SELECT abs(d), count(*) AS k FROM d WHERE d <> 0 GROUP BY 1))
SELECT count(*) AS n, (SELECT count(*) FROM d WHERE d = 0) AS n_zero, sum(rk) FILTER (d > 0) AS w_plus, sum(rk) FILTER (d < 0) AS w_minus,
  (SELECT tie FROM t) AS tie_term FROM r""")
def signed_ranks(spark, sf):
    """V9 over every visit: mean ranks of heavily tied differences."""
    df = frames.scored_visits(spark, sf).select(rounded(F.col("n_lines") - F.col("pred")).alias("a"), F.lit(0.0).alias("b"))
    return V.signed_ranks(df, "a", "b")


# --- folds and weights -----------------------------------------------------------------------------

_HASH = "(({0} * 7919 + 104729) % 1000003)"


@query("class_weights", """SELECT toxic AS class, count(*) AS n, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 6) AS weight,
  round((SELECT count(*) FILTER (toxic = 0) / count(*) FILTER (toxic = 1) FROM labels), 6) AS scale_pos_weight FROM labels GROUP BY 1""")
def class_weights(spark, sf):
    """M8."""
    df = load_table(spark, sf, "labels", "toxic")
    return _round(folds.class_weights(df, "toxic").withColumn("scale_pos_weight", folds.positive_scale(df, "toxic").scalar()), "weight", "scale_pos_weight")


@query("row_weights", """SELECT doc_id, toxic, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY toxic)), 6) AS weight FROM labels""")
def row_weights(spark, sf):
    """M8 as a weight column."""
    return _round(folds.with_class_weight(load_table(spark, sf, "labels", "doc_id", "toxic"), "toxic"), "weight")


@query("stratified_folds", f"""WITH {VISITS}, y AS (SELECT visit_id, (readmitted = '<30')::INT AS y FROM visits)
SELECT visit_id, y, ((row_number() OVER (PARTITION BY y ORDER BY {_HASH.format('visit_id')}, visit_id) - 1) % 5)::INT AS fold FROM y""")
def stratified_folds(spark, sf):
    """M9."""
    df = frames.visits(spark, sf).select("visit_id", (F.col("readmitted") == "<30").cast("int").alias("y"))
    return folds.k_folds(df, "visit_id", 5, "y")


@query("kfolds", f"SELECT o_orderkey, ((row_number() OVER (ORDER BY {_HASH.format('o_orderkey')}, o_orderkey) - 1) % 5)::INT AS fold FROM orders")
def kfolds(spark, sf):
    """M10."""
    return folds.k_folds(load_table(spark, sf, "orders", "o_orderkey"), "o_orderkey", 5)


@query("split", f"""WITH s AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {_HASH.format('doc_id')}, doc_id) AS r,
  count(*) OVER (PARTITION BY toxic) AS k, row_number() OVER (ORDER BY {_HASH.format('doc_id')}, doc_id) AS r_all, count(*) OVER () AS k_all FROM labels)
SELECT doc_id, toxic, (r <= ceil(k * 0.2::DOUBLE))::INT AS is_test, (r_all <= ceil(k_all * 0.2::DOUBLE))::INT AS is_test_plain FROM s""")
def split(spark, sf):
    """M11, stratified and plain."""
    df = load_table(spark, sf, "labels", "doc_id", "toxic")
    return folds.holdout(folds.holdout(df, "doc_id", 0.2, "toxic"), "doc_id", 0.2, None, "is_test_plain")


# --- feature scores --------------------------------------------------------------------------------

@query("variance_filter", f"WITH {DOCUMENTS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CASE WHEN stddev_pop({c}) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS variance, (stddev_pop({c}) > 0)::INT AS kept FROM feats"""
    for c in DOCUMENT_COLUMNS))
def variance_filter(spark, sf):
    """M1: on standardised data only constants fall below the threshold."""
    return _round(ranking.variance_filter(frames.document_features(spark, sf), DOCUMENT_COLUMNS), "variance")


def _anova_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, CASE WHEN sum(k * v) > 0 THEN round((sum(k * (m - g) ** 2) / (count(*) - 1)) / (sum(k * v) / (sum(k) - count(*))), 6) END AS f_score
  FROM (SELECT toxic, count(*)::DOUBLE AS k, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM feats) AS g FROM feats GROUP BY toxic)"""


@query("anova_f", f"WITH {DOCUMENTS} " + " UNION ALL ".join(_anova_sql(c) for c in DOCUMENT_COLUMNS))
def anova_f(spark, sf):
    """M2."""
    return _round(ranking.anova_f(frames.document_features(spark, sf), DOCUMENT_COLUMNS, "toxic"), "f_score")


VISIT_FEATURES = ["qty", "amount", "n_parts", "n_returned"]


@query("regression_f", f"WITH {VISITS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(corr({c}::DOUBLE, n_lines) ** 2 / (1 - corr({c}::DOUBLE, n_lines) ** 2) * (count(*) - 2), 1) AS f_score FROM visits""" for c in VISIT_FEATURES))
def regression_f(spark, sf):
    """M3."""
    scores = ranking.regression_f(frames.visits(spark, sf), VISIT_FEATURES, "n_lines")
    return scores.withColumn("f_score", rounded(F.col("f_score"), 1))


def _mi_sql(c: str, table: str, y: str) -> str:
    return f"""SELECT '{c}' AS feature, round(greatest(sum(n / total * ln(n * total / (nx * ny))), 0), 6) + 0.0 AS mutual_info FROM (
  SELECT n::DOUBLE AS n, sum(n) OVER (PARTITION BY b)::DOUBLE AS nx, sum(n) OVER (PARTITION BY yy)::DOUBLE AS ny, sum(n) OVER ()::DOUBLE AS total FROM (
    SELECT {y} AS yy, len(list_filter(q, lambda z: z < {c}::DOUBLE)) AS b, count(*) AS n
    FROM {table}, (SELECT quantile_cont({c}::DOUBLE, [{', '.join(str(i / 32) for i in range(1, 32))}]) AS q FROM {table}) GROUP BY 1, 2))"""


@query("mutual_info", f"WITH {DOCUMENTS} " + " UNION ALL ".join(_mi_sql(c, "feats", "toxic") for c in DOCUMENT_COLUMNS))
def mutual_info(spark, sf):
    """M4, class target."""
    return _round(ranking.mutual_information(frames.document_features(spark, sf), DOCUMENT_COLUMNS, "toxic"), "mutual_info")


@query("mutual_info_numeric", f"""WITH {VISITS}, t AS (SELECT v.*, len(list_filter(q, lambda z: z < n_lines::DOUBLE)) AS ybin FROM visits v,
  (SELECT quantile_cont(n_lines::DOUBLE, [{', '.join(str(i / 32) for i in range(1, 32))}]) AS q FROM visits)) """ + " UNION ALL ".join(
    _mi_sql(c, "t", "ybin") for c in VISIT_FEATURES))
def mutual_info_numeric(spark, sf):
    """M4, numeric target."""
    return _round(ranking.mutual_information(frames.visits(spark, sf), VISIT_FEATURES, "n_lines", numeric_target=True), "mutual_info")


def _psi(n: str) -> str:
    """Digamma of a whole number, from the table ``psi``."""
    return f"(SELECT list(p ORDER BY i) FROM psi)[{n}]"


_PSI = "psi AS (SELECT i, sum(CASE WHEN i > 1 THEN 1.0::DOUBLE / (i - 1) ELSE 0 END) OVER (ORDER BY i) - 0.57721566490153286 AS p FROM range(1, (SELECT count(*) + 2 FROM feats)) t(i))"


def _near_class_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(greatest(any_value({_psi('n')}) + avg({_psi('near')}) - avg({_psi('n_label')}) - avg({_psi('inside')}), 0), 6) + 0.0 AS mutual_info FROM (
  SELECT a.doc_id, any_value(radius) AS radius, any_value(n_label) AS n_label, any_value(n) AS n,
         CASE WHEN any_value(radius) = 0 THEN count(*) FILTER (a.toxic = b.toxic AND a.{c} = b.{c}) ELSE any_value(found) END AS near,
         count(*) FILTER (abs(a.{c}::DOUBLE - b.{c}::DOUBLE) < radius OR (radius = 0 AND a.{c} = b.{c})) AS inside
  FROM (SELECT *, count(*) OVER () AS n, count(*) OVER (PARTITION BY toxic) AS n_label FROM feats) a, feats b,
       (SELECT id, max(dist) AS radius, count(*) AS found FROM (
          SELECT x.doc_id AS id, abs(x.{c}::DOUBLE - y.{c}::DOUBLE) AS dist FROM feats x JOIN feats y ON x.toxic = y.toxic AND x.doc_id <> y.doc_id
          QUALIFY row_number() OVER (PARTITION BY x.doc_id ORDER BY dist) <= 3) GROUP BY id) k
  WHERE k.id = a.doc_id GROUP BY a.doc_id)"""


@query("mutual_info_neighbors", f"WITH {DOCUMENTS}, {_PSI} " + " UNION ALL ".join(_near_class_sql(c) for c in DOCUMENT_COLUMNS))
def mutual_info_neighbors(spark, sf):
    """M4, class target, by three nearest neighbours."""
    return _round(information.mutual_information_class(frames.document_features(spark, sf), DOCUMENT_COLUMNS, "toxic"), "mutual_info")


def _near_number_sql(c: str, y: str) -> str:
    return f"""SELECT '{c}' AS feature, round(greatest(any_value({_psi('n')}) + avg({_psi('near')}) - avg({_psi('inside_x')}) - avg({_psi('inside_y')}), 0), 6) + 0.0 AS mutual_info FROM (
  WITH p AS (SELECT doc_id, coalesce({c}::DOUBLE / nullif((SELECT stddev_pop({c}::DOUBLE) FROM feats), 0), 0) AS x,
                    coalesce({y}::DOUBLE / nullif((SELECT stddev_pop({y}::DOUBLE) FROM feats), 0), 0) AS y FROM feats),
  d AS (SELECT a.doc_id AS id, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy, a.doc_id = b.doc_id AS own FROM p a, p b),
  k AS (SELECT id, max(dist) AS radius, count(*) AS found FROM (
    SELECT id, greatest(dx, dy) AS dist FROM d WHERE NOT own QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist) <= 3) GROUP BY id)
  SELECT d.id, (SELECT count(*) FROM feats) AS n, CASE WHEN any_value(radius) = 0 THEN count(*) FILTER (dx = 0 AND dy = 0) ELSE any_value(found) END AS near,
         count(*) FILTER (dx < radius OR (radius = 0 AND dx = 0)) AS inside_x, count(*) FILTER (dy < radius OR (radius = 0 AND dy = 0)) AS inside_y
  FROM d JOIN k USING (id) GROUP BY d.id)"""


NUMBER_FEATURES = [c for c in DOCUMENT_COLUMNS if c != "n_chars"]


@query("mutual_info_neighbors_numeric", f"WITH {DOCUMENTS}, {_PSI} " + " UNION ALL ".join(_near_number_sql(c, "n_chars") for c in NUMBER_FEATURES))
def mutual_info_neighbors_numeric(spark, sf):
    """M4, numeric target, by three nearest neighbours."""
    return _round(information.mutual_information_number(frames.document_features(spark, sf), NUMBER_FEATURES, "n_chars"), "mutual_info")


_RANKED = f"""f AS ({' UNION ALL '.join(_anova_sql(c) for c in DOCUMENT_COLUMNS)}), {_PSI}, m AS ({' UNION ALL '.join(_near_class_sql(c) for c in DOCUMENT_COLUMNS)})"""


@query("rank_table", f"WITH {DOCUMENTS}, {_RANKED} SELECT feature, f_score, mutual_info FROM f JOIN m USING (feature)")
def rank_table(spark, sf):
    """M6 J3 T4."""
    df = materialize(frames.document_features(spark, sf), "documents")
    return _round(ranking.rank_table([ranking.anova_f(df, DOCUMENT_COLUMNS, "toxic"), information.mutual_information(df, DOCUMENT_COLUMNS, "toxic", classify=True)], "f_score"),
                  "f_score", "mutual_info")


@query("top_features", f"""WITH {DOCUMENTS}, {_RANKED}, u AS (SELECT 'anova' AS method, feature, f_score AS score FROM f UNION ALL SELECT 'mutual_info', feature, mutual_info FROM m)
SELECT method, feature, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY method ORDER BY score DESC NULLS LAST, feature) AS rank FROM u) WHERE rank <= 5""")
def top_features(spark, sf):
    """T6 U1."""
    df = materialize(frames.document_features(spark, sf), "documents")
    f = _round(ranking.anova_f(df, DOCUMENT_COLUMNS, "toxic"), "f_score")
    m = _round(information.mutual_information(df, DOCUMENT_COLUMNS, "toxic", classify=True), "mutual_info")
    return ranking.top_features(f, "anova", "f_score", 5).unionByName(ranking.top_features(m, "mutual_info", "mutual_info", 5))
