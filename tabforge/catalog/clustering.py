"""Queries over fitted clusterings. Iterative fits: no SQL equivalent, tested on planted data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import cluster_scores, clustering
from tabforge.plans import frames
from tabforge.plans.frames import CUSTOMER_COLUMNS
from tabforge.session import materialize
from tabforge.sources.tables import load_table


def _customers(spark, sf):
    return materialize(frames.customer_features(spark, sf), "customers")


@query("pca_variance")
def pca_variance(spark, sf):
    """K1: components until 95 % of the variance."""
    table = clustering.pca_variance(_customers(spark, sf), CUSTOMER_COLUMNS)
    return table.withColumn("kept", (F.col("cumulative") - F.col("explained") < 0.95).cast("int"))


@query("pca_coordinates")
def pca_coordinates(spark, sf):
    """K2: two-dimensional coordinates."""
    xy = clustering.pca_project(_customers(spark, sf), "person_id", CUSTOMER_COLUMNS, k=2)
    return xy.select("id", F.col("vec")[0].alias("pc1"), F.col("vec")[1].alias("pc2"))


_PARTS = """z AS (SELECT p_partkey AS id, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS a,
  (p_retailprice::DOUBLE - avg(p_retailprice::DOUBLE) OVER ()) / stddev_pop(p_retailprice::DOUBLE) OVER () AS b FROM part), r AS (SELECT corr(a, b) AS r FROM z)"""


def _parts(spark, sf):
    return load_table(spark, sf, "part", "p_partkey", F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").cast("double").alias("b"))


@query("pca_two", f"""WITH {_PARTS} SELECT component::INT AS component, round((1 + CASE component WHEN 1 THEN abs(r) ELSE -abs(r) END) / 2, 6) AS explained,
  round(CASE component WHEN 1 THEN (1 + abs(r)) / 2 ELSE 1 END, 6) AS cumulative FROM r, (SELECT unnest([1, 2]) AS component)""")
def pca_two(spark, sf):
    """K1 in closed form: the eigenvalues of a correlation matrix of two columns are 1 +- |r|."""
    table = clustering.pca_variance(_parts(spark, sf), ["a", "b"])
    return table.withColumns({c: rounded(F.col(c)) for c in ("explained", "cumulative")})


@query("pca_two_coordinates", f"""WITH {_PARTS} SELECT id, round(abs(a + sign(r) * b) / sqrt(2), 6) AS pc1, round(abs(a - sign(r) * b) / sqrt(2), 6) AS pc2 FROM z, r""")
def pca_two_coordinates(spark, sf):
    """K2 in closed form, without the signs, which are arbitrary."""
    xy = clustering.pca_project(_parts(spark, sf), "p_partkey", ["a", "b"], k=2)
    return xy.select("id", *[rounded(F.abs(F.col("vec")[i])).alias(f"pc{i + 1}") for i in range(2)])


@query("elbow_table")
def elbow_table(spark, sf):
    """K3 K5 K6 K7 V10."""
    return clustering.kmeans_sweep(_customers(spark, sf), "person_id", CUSTOMER_COLUMNS, range(2, 12), n_init=10)[0]


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    """The sweep's best k refitted with more starts, and its cluster profile."""
    df = _customers(spark, sf)
    table, _ = clustering.kmeans_sweep(df, "person_id", CUSTOMER_COLUMNS, range(2, 12), n_init=10)
    k = clustering.best_k(table)
    labels = clustering.kmeans_labels(df, "person_id", CUSTOMER_COLUMNS, [k], n_init=20).select("person_id", F.col(f"k{k}").alias("kmeans_label"))
    joined = df.join(labels, "person_id")
    sizes = joined.groupBy("kmeans_label").agg(F.count("*").alias("n"))
    return cluster_scores.cluster_profile(joined, "kmeans_label", [*CUSTOMER_COLUMNS, "early"]).join(sizes, "kmeans_label")


@query("hier_sweep")
def hier_sweep(spark, sf):
    """K8 K9."""
    return clustering.agglomerative_sweep(_customers(spark, sf), "person_id", CUSTOMER_COLUMNS)[0]


@query("merge_table")
def merge_table(spark, sf):
    """K8: the order in which clusters merge."""
    return clustering.agglomerative_labels(_customers(spark, sf), "person_id", CUSTOMER_COLUMNS, ["ward"], [2])[2]


@query("method_compare")
def method_compare(spark, sf):
    """K13 U1."""
    return clustering.compare_methods(_customers(spark, sf), "person_id", CUSTOMER_COLUMNS)
