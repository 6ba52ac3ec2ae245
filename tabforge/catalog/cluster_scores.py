"""Queries over cluster quality and density clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.frames_sql import CUSTOMERS, SCORED
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import cluster_scores as S
from tabforge.operators import density
from tabforge.operators.encoding import apply_standard, fit_standard
from tabforge.plans import frames
from tabforge.plans.frames import CUSTOMER_COLUMNS
from tabforge.session import materialize
from tabforge.sources.tables import load_table


def _labelled(spark, sf):
    """Standardised customers with two rule-based labelings."""
    df = materialize(frames.customer_features(spark, sf), "customers")
    labels = df.withColumns({
        "by_visits": F.when(F.col("n_visits") > 12, 2).when(F.col("n_visits") > 8, 1).otherwise(0),
        "by_balance": (F.col("balance") > 5000).cast("int"),
    })
    return apply_standard(labels, fit_standard(df, CUSTOMER_COLUMNS))


_Z = CUSTOMERS + ", st AS (SELECT " + ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) s_{c}" for c in CUSTOMER_COLUMNS) + " FROM customers), z AS (SELECT person_id AS id, [" + \
    ", ".join(f"({c} - m_{c}) / s_{c}" for c in CUSTOMER_COLUMNS) + """] AS v, CASE WHEN n_visits > 12 THEN 2 WHEN n_visits > 8 THEN 1 ELSE 0 END AS by_visits,
  (balance > 5000)::INT AS by_balance FROM customers, st),
lab AS (SELECT 'by_visits' AS clustering, id, v, by_visits AS label FROM z UNION ALL SELECT 'by_balance', id, v, by_balance FROM z),
cen AS (SELECT clustering, label, count(*) AS n, [avg(v[1]), avg(v[2]), avg(v[3]), avg(v[4]), avg(v[5])] AS c FROM lab GROUP BY 1, 2)"""


@query("davies_bouldin", f"""WITH {_Z}, s AS (SELECT l.clustering, l.label, any_value(c) AS c, avg(list_distance(v, c)) AS s FROM lab l JOIN cen USING (clustering, label) GROUP BY 1, 2),
w AS (SELECT a.clustering, a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS w FROM s a JOIN s b ON a.clustering = b.clustering AND a.label <> b.label GROUP BY 1, 2)
SELECT clustering, round(avg(w), 6) AS davies_bouldin FROM w GROUP BY 1""")
def davies_bouldin(spark, sf):
    """K6."""
    names = ["by_visits", "by_balance"]
    points = materialize(S.points_with_labels(_labelled(spark, sf), "person_id", CUSTOMER_COLUMNS, names))
    scores = S.davies_bouldin(points, materialize(S.cluster_stats(points, len(CUSTOMER_COLUMNS))))
    return scores.select(F.array(*[F.lit(n) for n in names])[F.col("run")].alias("clustering"), rounded(F.col("davies_bouldin")).alias("davies_bouldin"))


@query("calinski", f"""WITH {_Z}, g AS (SELECT clustering, count(*) AS n, [avg(v[1]), avg(v[2]), avg(v[3]), avg(v[4]), avg(v[5])] AS m FROM lab GROUP BY 1),
w AS (SELECT l.clustering, sum(list_distance(v, c) ** 2) AS w FROM lab l JOIN cen USING (clustering, label) GROUP BY 1),
b AS (SELECT c.clustering, sum(c.n * list_distance(c.c, m) ** 2) AS b, count(*) AS k FROM cen c JOIN g USING (clustering) GROUP BY 1)
SELECT clustering, k AS n_clusters, round(w, 6) AS inertia, round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM g JOIN w USING (clustering) JOIN b USING (clustering)""")
def calinski(spark, sf):
    """K7, with the inertia."""
    names = ["by_visits", "by_balance"]
    points = S.points_with_labels(_labelled(spark, sf), "person_id", CUSTOMER_COLUMNS, names)
    scores = S.calinski_harabasz(S.cluster_stats(points, len(CUSTOMER_COLUMNS)))
    return scores.select(F.array(*[F.lit(n) for n in names])[F.col("run")].alias("clustering"), "n_clusters",
                         rounded(F.col("inertia")).alias("inertia"), rounded(F.col("calinski_harabasz")).alias("calinski_harabasz"))


_SILHOUETTE = f"""WITH {_Z}, smp AS (SELECT * FROM z ORDER BY (id * 7919 + 104729) % 1000003, id {{limit}}),
pd AS (SELECT a.id, a.by_visits AS la1, a.by_balance AS la2, b.by_visits AS lb1, b.by_balance AS lb2, list_distance(a.v, b.v) AS d FROM smp a JOIN smp b ON a.id <> b.id),
m AS (SELECT 'by_visits' AS clustering, id, la1 AS own, lb1 AS other, avg(d) AS m FROM pd GROUP BY ALL UNION ALL SELECT 'by_balance', id, la2, lb2, avg(d) FROM pd GROUP BY ALL),
s AS (SELECT clustering, id, max(m) FILTER (own = other) AS a, min(m) FILTER (own <> other) AS b FROM m GROUP BY 1, 2)
SELECT clustering, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) + 0.0 AS silhouette FROM s GROUP BY 1"""


@query("silhouette", _SILHOUETTE.format(limit="LIMIT 5000"))
def silhouette(spark, sf):
    """K5."""
    names = ["by_visits", "by_balance"]
    scores = S.silhouette(S.points_with_labels(_labelled(spark, sf), "person_id", CUSTOMER_COLUMNS, names))
    return scores.select(F.array(*[F.lit(n) for n in names])[F.col("run")].alias("clustering"), rounded(F.col("silhouette")).alias("silhouette"))


@query("silhouette_all", _SILHOUETTE.format(limit=""))
def silhouette_all(spark, sf):
    """K5 over all rows, exact."""
    names = ["by_visits", "by_balance"]
    scores = S.silhouette(S.points_with_labels(_labelled(spark, sf), "person_id", CUSTOMER_COLUMNS, names), None)
    return scores.select(F.array(*[F.lit(n) for n in names])[F.col("run")].alias("clustering"), rounded(F.col("silhouette")).alias("silhouette"))


_RULE = "CASE WHEN n_visits > 12 THEN 2 WHEN n_visits > 8 THEN 1 ELSE 0 END"
_PROFILE = CUSTOMERS + f""", prof AS (SELECT {_RULE} AS by_visits, round_even(avg(n_visits), 3) AS n_visits, round_even(avg(n_lines), 3) AS n_lines,
  round_even(avg(balance), 3) AS balance, round_even(avg(early), 3) AS early FROM customers GROUP BY 1)"""
_PROFILED = ["n_visits", "n_lines", "balance", "early"]


def _profile(spark, sf):
    df = frames.customer_features(spark, sf).withColumn("by_visits", F.when(F.col("n_visits") > 12, 2).when(F.col("n_visits") > 8, 1).otherwise(0))
    return S.cluster_profile(df, "by_visits", _PROFILED)


@query("cluster_profile", f"WITH {_PROFILE} SELECT * FROM prof")
def cluster_profile(spark, sf):
    """A19 S9."""
    return _profile(spark, sf)


@query("profile_z", f"WITH {_PROFILE} SELECT by_visits, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}" for c in _PROFILED) + " FROM prof")
def profile_z(spark, sf):
    """A21."""
    z = S.profile_z(_profile(spark, sf), "by_visits", _PROFILED)
    return z.select("by_visits", *[rounded(F.col(c)).alias(c) for c in _PROFILED])


@query("cluster_rates", f"""WITH {SCORED} SELECT label, count(*) AS n, round(avg(y), 6) AS mean, round(100 * avg(y), 6) AS mean_pct FROM scored GROUP BY 1""")
def cluster_rates(spark, sf):
    """A20."""
    r = S.cluster_rates(frames.scored_visits(spark, sf), "label", "y")
    return r.select("label", "n", rounded(F.col("mean")).alias("mean"), rounded(F.col("mean_pct")).alias("mean_pct"))


@query("cluster_sizes", f"""WITH {SCORED} SELECT CASE WHEN label = 3 THEN -1 ELSE label END AS label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM scored), 6) AS pct,
  (label = 3)::INT AS is_noise FROM scored GROUP BY label""")
def cluster_sizes(spark, sf):
    """Labels joined back to the rows by id; label 3 plays the noise."""
    df = frames.scored_visits(spark, sf)
    labels = df.select("visit_id", F.when(F.col("label") == 3, -1).otherwise(F.col("label")).alias("label"))
    joined = df.drop("label").join(labels, "visit_id")
    return S.cluster_sizes(joined, "label").withColumn("pct", rounded(F.col("pct")))


EPS, MIN_SAMPLES = [1.13, 1.16, 1.19, 1.23], [3, 5, 10]


def _grid(spark, sf, eps, min_samples):
    vectors = load_table(spark, sf, "embeddings", "vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    return density.dbscan_grid(vectors, "vec_id", "vec", eps, min_samples)


_DB = """WITH RECURSIVE e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
d AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON list_distance(a.v, b.v) <= 1.19),
core AS MATERIALIZED (SELECT a AS id FROM d GROUP BY 1 HAVING count(*) >= 5),
cc AS MATERIALIZED (SELECT a, b FROM d WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(a, b) AS (SELECT a, b FROM cc UNION SELECT r.a, cc.b FROM reach r JOIN cc ON r.b = cc.a),
root AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY 1),
border AS (SELECT d.a AS id, min(root) AS root FROM d JOIN root ON root.id = d.b WHERE d.a NOT IN (SELECT id FROM core) GROUP BY 1)"""


@query("dbscan", f"{_DB} SELECT e.id, coalesce(root.root, border.root, -1) AS label FROM e LEFT JOIN root USING (id) LEFT JOIN border ON border.id = e.id")
def dbscan(spark, sf):
    """K10 K12 J8."""
    labelled, _ = _grid(spark, sf, [1.19], [5])
    return labelled.select("id", F.col("labels")[0].alias("label"))


def _grid_sql() -> str:
    parts, ctes = [], []
    for i, (e, ms) in enumerate((e, ms) for e in EPS for ms in MIN_SAMPLES):
        ctes.append(f"""core{i} AS MATERIALIZED (SELECT a AS id FROM d WHERE dist <= {e} GROUP BY 1 HAVING count(*) >= {ms}),
cc{i} AS MATERIALIZED (SELECT a, b FROM d WHERE dist <= {e} AND a IN (SELECT id FROM core{i}) AND b IN (SELECT id FROM core{i})),
reach{i}(a, b) AS (SELECT a, b FROM cc{i} UNION SELECT r.a, c.b FROM reach{i} r JOIN cc{i} c ON r.b = c.a),
root{i} AS MATERIALIZED (SELECT a AS id, min(b) AS root FROM reach{i} GROUP BY 1),
bord{i} AS MATERIALIZED (SELECT DISTINCT d.a AS id FROM d JOIN core{i} c ON c.id = d.b WHERE dist <= {e} AND d.a NOT IN (SELECT id FROM core{i}))""")
        parts.append(f"""SELECT {e}::DOUBLE AS eps, {ms}::INT AS min_samples, (SELECT count(DISTINCT root) FROM root{i})::INT AS n_clusters,
(SELECT count(*) FROM e) - (SELECT count(*) FROM root{i}) - (SELECT count(*) FROM bord{i}) AS n_noise""")
    return f"""WITH RECURSIVE e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
d AS MATERIALIZED (SELECT a.id AS a, b.id AS b, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON list_distance(a.v, b.v) <= {max(EPS)}),
{', '.join(ctes)}, r AS ({' UNION ALL '.join(parts)})
SELECT eps, min_samples, n_clusters, n_noise, round_even(n_noise / (SELECT count(*) FROM e) * 100, 1) AS noise_pct FROM r"""


@query("eps_grid", _grid_sql())
def eps_grid(spark, sf):
    """The whole grid in shared passes. The radii span the 5-NN distances of these vectors."""
    labelled, grid = _grid(spark, sf, EPS, MIN_SAMPLES)
    sizes = density.grid_sizes(labelled, grid)
    return sizes.select("eps", "min_samples", "n_clusters", "n_noise", F.bround("pct", 1).alias("noise_pct"))


@query("eps_grid_scores")
def eps_grid_scores(spark, sf):
    """Gated silhouettes of the grid and the chosen configuration."""
    labelled, grid = _grid(spark, sf, EPS, MIN_SAMPLES)
    report = materialize(density.grid_report(materialize(labelled, "labels"), grid), "grid")
    eps, ms = density.best_run(report)
    return report.drop("run").withColumn("chosen", ((F.col("eps") == eps) & (F.col("min_samples") == ms)).cast("int"))
