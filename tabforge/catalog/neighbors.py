"""Queries over neighbour joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.frames_sql import DOCUMENTS
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import neighbors as N
from tabforge.plans import frames
from tabforge.sources.tables import load_table

_E = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
_NEAR = _E + """, d AS (SELECT a.vec_id AS id, b.vec_id AS nb, list_distance(a.v, b.v) AS dist FROM e a, e b),
near AS (SELECT id, nb, dist, row_number() OVER (PARTITION BY id ORDER BY dist, nb) AS rank FROM d WHERE id <> nb)"""


def _embeddings(spark, sf):
    return load_table(spark, sf, "embeddings", "vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


@query("knn_graph", f"""WITH {_NEAR}, o AS (SELECT id AS src, nb AS dst FROM near WHERE rank <= 10)
SELECT src, dst, count(*) * 0.5::DOUBLE AS w FROM (SELECT src, dst FROM o UNION ALL SELECT dst, src FROM o) GROUP BY 1, 2""")
def knn_graph(spark, sf):
    """J6."""
    return N.knn_graph(_embeddings(spark, sf), "vec_id", "vec", 10)


@query("kth_distance", f"""WITH {_E}, d AS (SELECT a.vec_id AS id, list_distance(a.v, b.v) AS dist FROM e a, e b)
SELECT id, round(dist, 6) AS dist FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist) = 5""")
def kth_distance(spark, sf):
    """J7."""
    d = N.kth_distance(_embeddings(spark, sf), "vec_id", "vec", 5)
    return d.withColumn("dist", rounded(F.col("dist")))


@query("kth_distance_blocks", """WITH p AS (SELECT c_custkey AS id, [c_acctbal::DOUBLE / 1000, c_nationkey::DOUBLE] AS v FROM customer),
d AS (SELECT a.id, list_distance(a.v, b.v) AS dist FROM p a, p b)
SELECT id, round(dist, 6) AS dist FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist) = 7""")
def kth_distance_blocks(spark, sf):
    """J7 over many small blocks: a row meets only the blocks that its seventh neighbour can lie in."""
    vec = F.array(F.col("c_acctbal").cast("double") / 1000, F.col("c_nationkey").cast("double")).alias("vec")
    d = N.kth_distance(load_table(spark, sf, "customer", "c_custkey", vec), "c_custkey", "vec", 7, block=64)
    return d.withColumn("dist", rounded(F.col("dist")))


@query("elbow_curve", f"""WITH {_E}, d AS (SELECT a.vec_id AS id, list_distance(a.v, b.v) AS dist FROM e a, e b),
k AS (SELECT id, dist FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist) = 5)
SELECT id, round(dist, 6) AS dist, row_number() OVER (ORDER BY round(dist, 6) DESC, (id * 7919 + 104729) % 1000003, id)::BIGINT AS position FROM k""")
def elbow_curve(spark, sf):
    """Descending k-th distance, with the position on the curve (equal distances in hash order)."""
    d = N.kth_distance(_embeddings(spark, sf), "vec_id", "vec", 5).withColumn("dist", rounded(F.col("dist")))
    return N.descending_curve(d, "id", "dist")


@query("knn_vote", f"""WITH {_E}, d AS (SELECT a.vec_id AS id, b.vec_id AS nb, (b.label >= 5)::INT AS y, list_distance(a.v, b.v) AS dist
  FROM e a, e b WHERE a.vec_id % 5 = 0 AND b.vec_id % 5 <> 0),
near AS (SELECT id, y FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, nb) <= 11)
SELECT id, round(avg(y), 6) AS score, (avg(y) > 0.5)::INT AS pred FROM near GROUP BY 1""")
def knn_vote(spark, sf):
    """Every fifth row is a test row, all others are training rows."""
    df = _embeddings(spark, sf).withColumn("y", (F.col("label") >= 5).cast("int"))
    votes = N.knn_vote(df.filter("vec_id % 5 <> 0"), df.filter("vec_id % 5 = 0"), "vec_id", "vec", "y", 11)
    return votes.withColumn("score", rounded(F.col("score")))


SMOTE_FEATURES = ["n_chars", "n_words", "n_digits", "upper_share"]


@query("smote", f"""WITH {DOCUMENTS}, mn AS (SELECT doc_id AS id, [n_chars, n_words, n_digits, upper_share] AS v FROM feats WHERE toxic = 1),
c AS (SELECT count(*) FILTER (toxic = 1) AS n1, count(*) FILTER (toxic = 0) - count(*) FILTER (toxic = 1) AS deficit FROM feats),
near AS (SELECT a.id, b.id AS nb, b.v AS t, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank FROM mn a JOIN mn b ON a.id <> b.id),
r AS (SELECT id, v, row_number() OVER (ORDER BY (id * 7919 + 104729) % 1000003, id) AS rk FROM mn),
g AS (SELECT id, v, unnest(range(deficit // n1 + (rk <= deficit % n1)::INT)) AS j FROM r, c),
p AS (SELECT id, v, j, (id * 31 + j * 17 + 7) % 5 + 1 AS pick, ((id * 7919 + j * 104729) % 1000) / 1000.0::DOUBLE AS gap FROM g)
SELECT p.id, j::INT AS j, round(v[1] + (t[1] - v[1]) * gap, 6) AS n_chars, round(v[2] + (t[2] - v[2]) * gap, 6) AS n_words,
  round(v[3] + (t[3] - v[3]) * gap, 6) AS n_digits, round(v[4] + (t[4] - v[4]) * gap, 6) AS upper_share, 1::INT AS toxic, 1::INT AS synthetic
FROM p JOIN near ON near.id = p.id AND rank = pick""")
def smote(spark, sf):
    """M7."""
    made = N.smote(frames.document_features(spark, sf), "doc_id", SMOTE_FEATURES, "toxic", 5)
    return made.withColumns({c: rounded(F.col(c)) for c in SMOTE_FEATURES})
