"""Principal components, k-means sweeps and agglomerative clustering."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.agglomerative import NEIGHBORS, TOP_CLUSTERS, cut_labels, merge_steps, merge_tree
from tabforge.operators.cluster_scores import SAMPLE_ROWS, score_clusterings
from tabforge.operators.encoding import apply_standard, fit_standard
from tabforge.operators.neighbors import square_distances, stack
from tabforge.session import materialize


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def standardized(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features filled with 0 where null, then scaled to mean 0 and population deviation 1."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return apply_standard(filled, fit_standard(filled, features))


# --- principal components ---------------------------------------------------------------------------

def pca_variance(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(component, explained, cumulative) of standardised features."""
    shares = PCA(k=len(features), inputCol="features", outputCol="pcs").fit(assemble(standardized(df, features), features)).explainedVariance.toArray()
    rows = [(i + 1, float(s), float(c)) for i, (s, c) in enumerate(zip(shares, np.cumsum(shares)))]
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")


def pca_project(df: DataFrame, id_col: str, features: Sequence[str], k: int | None = None, variance: float | None = None) -> DataFrame:
    """(id, vec): coordinates on the first ``k`` components, or on as many as explain ``variance``.

    MLlib projects without centring, so the input is standardised first. Signs are arbitrary.
    """
    data = assemble(standardized(df, features), features)
    model = PCA(k=k or len(features), inputCol="features", outputCol="pcs").fit(data)
    coords = vector_to_array("pcs")
    if variance is not None:
        keep = int(np.searchsorted(np.cumsum(model.explainedVariance.toArray()), variance - 1e-12) + 1)
        coords = F.slice(coords, 1, keep)
    return model.transform(data).select(F.col(id_col).cast("long").alias("id"), coords.alias("vec"))


# --- k-means ----------------------------------------------------------------------------------------

START_ROUNDS = 3


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) per id and salt: a fixed scramble, so a rerun draws the same rows."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64(salt + 1) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def _far_rows(chosen: list[np.ndarray], draw: int, salt: int):
    """Per partition and start: ``draw`` rows of a weighted sample without replacement. A row's weight is its squared
    distance from the rows chosen so far, its key an exponential waiting time; the shortest waits win."""
    def fn(batches):
        kept = [(np.empty(0), None) for _ in chosen]
        for pdf in batches:
            if not len(pdf):
                continue
            x, ids = stack(pdf["vec"]), pdf["id"].to_numpy()
            for i, points in enumerate(chosen):
                d2 = square_distances(x, points).min(axis=1) if len(points) else np.ones(len(x))
                wait = np.where(d2 > 0, -np.log(_uniform(ids, salt + 1000 * i)) / np.where(d2 > 0, d2, 1.0), np.inf)
                key = np.concatenate([kept[i][0], wait])
                rows = x if kept[i][1] is None else np.concatenate([kept[i][1], x])
                near = np.argsort(key, kind="stable")[:draw]
                near = near[np.isfinite(key[near])]
                kept[i] = key[near], rows[near]
        for i, (key, rows) in enumerate(kept):
            if len(key):
                yield pd.DataFrame({"start": np.full(len(key), i, dtype="int32"), "wait": key, "vec": list(rows)})
    return fn


def _candidate_weights(chosen: list[np.ndarray]):
    """Per partition: how many rows are nearest to each candidate of each start."""
    def fn(batches):
        n = [np.zeros(len(points)) for points in chosen]
        for pdf in batches:
            if len(pdf):
                x = stack(pdf["vec"])
                for i, points in enumerate(chosen):
                    n[i] += np.bincount(square_distances(x, points).argmin(axis=1), minlength=len(points))
        for i, counts in enumerate(n):
            yield pd.DataFrame({"start": np.full(len(counts), i, dtype="int32"), "candidate": np.arange(len(counts), dtype="int32"), "n": counts})
    return fn


def kmeans_starts(data: DataFrame, ks: Sequence[int], n_init: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """Centres to begin with for each (k, start), from all rows (k-means||).

    Each round draws rows in proportion to their squared distance from those drawn before; all starts
    share its pass. Candidates, weighted by the rows nearest to them, are reduced to k by k-means++ on
    the driver: their number depends on k and the rounds only.
    """
    draw = 2 * max(ks)
    chosen: list[np.ndarray] = [np.empty((0, 0)) for _ in range(n_init)]
    for step in range(START_ROUNDS + 1):
        wanted = draw if step else 1
        found = data.select("id", "vec").mapInPandas(_far_rows(chosen, wanted, seed + 7919 * step), "start int, wait double, vec array<double>")
        first = Window.partitionBy("start").orderBy("wait", "vec")
        rows = found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= wanted).collect()
        for i in range(n_init):
            new = [r["vec"] for r in rows if r["start"] == i]
            if new:
                chosen[i] = np.array(new) if not len(chosen[i]) else np.concatenate([chosen[i], np.array(new)])
    weights = [np.zeros(len(points)) for points in chosen]
    counted = data.select("vec").mapInPandas(_candidate_weights(chosen), "start int, candidate int, n double")
    for r in counted.groupBy("start", "candidate").agg(F.sum("n").alias("n")).collect():
        weights[r["start"]][r["candidate"]] = r["n"]
    return {(k, i): _spread_start(chosen[i], weights[i], k, np.random.default_rng(seed + i)) for k in ks for i in range(n_init)}


def _spread_start(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means++: each next centre is drawn in proportion to weight times squared distance from those chosen."""
    chosen = [points[rng.choice(len(points), p=weights / weights.sum())]]
    d2 = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        share = weights * d2
        chosen.append(points[rng.choice(len(points), p=share / share.sum() if share.sum() > 0 else None)])
        d2 = np.minimum(d2, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _partial_sums(centers: list[np.ndarray]):
    """Per partition and run: size, vector sum and cost of every cluster. One output row per (run, cluster)."""
    bounds = np.cumsum([0] + [len(c) for c in centers])
    flat = np.concatenate(centers)
    norms = (flat ** 2).sum(axis=1)

    def fn(batches):
        n, sums, cost = np.zeros(len(flat)), np.zeros_like(flat), np.zeros(len(flat))
        for pdf in batches:
            if not len(pdf):
                continue
            x = stack(pdf["vec"])
            gaps = norms[None, :] - 2 * (x @ flat.T)  # squared distance less the row's own norm
            own = (x ** 2).sum(axis=1)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                near = gaps[:, lo:hi].argmin(axis=1)
                hot = np.zeros((len(x), hi - lo))
                hot[np.arange(len(x)), near] = 1.0
                n[lo:hi] += hot.sum(axis=0)
                sums[lo:hi] += hot.T @ x
                cost[lo:hi] += hot.T @ np.maximum(own + gaps[np.arange(len(x)), lo + near], 0.0)
        run = np.repeat(np.arange(len(centers)), np.diff(bounds))
        yield pd.DataFrame({"run": run.astype("int32"), "cluster": (np.arange(len(flat)) - bounds[run]).astype("int32"),
                            "n": n, "sums": list(sums), "cost": cost})
    return fn


def kmeans_fits(data: DataFrame, dim: int, ks: Sequence[int], n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> dict[int, np.ndarray]:
    """Per k the centres with the lowest cost of ``n_init`` starts. ``data`` is a stored table with ``vec``.

    All fits of the sweep advance together: one pass over the rows per iteration serves every k and every
    start, instead of one pass per fit and iteration. A pass returns (clusters x dim) sums per
    partition, which are added up before they reach the driver: their number does not depend on the rows.
    Starts (``kmeans_starts``), the stopping tolerance and the iterations use all rows.
    """
    jobs = [(k, i) for k in ks for i in range(n_init)]
    spread = data.agg(F.count("*"), *[F.var_pop(F.col("vec")[d]) for d in range(dim)]).first()
    if not spread[0]:
        raise ValueError("k-means needs rows")
    limit = tol * float(np.mean([v or 0.0 for v in spread[1:]]))
    centers = kmeans_starts(data, ks, n_init, seed)
    cost: dict[tuple[int, int], float] = {}
    moving, closing = list(jobs), False
    for step in range(max_iter + 1):
        # The last pass prices the final centres of every fit.
        closing = not moving or step == max_iter
        active = jobs if closing else moving
        parts = data.select("vec").mapInPandas(_partial_sums([centers[j] for j in active]), "run int, cluster int, n double, sums array<double>, cost double")
        rows = parts.groupBy("run", "cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(dim)]).alias("sums"), F.sum("cost").alias("cost")).collect()
        if closing:
            for r in rows:
                cost[active[r["run"]]] = cost.get(active[r["run"]], 0.0) + r["cost"]
            break
        moved = {j: centers[j].copy() for j in active}
        for r in rows:
            if r["n"] > 0:  # an empty cluster keeps its centre
                moved[active[r["run"]]][r["cluster"]] = np.array(r["sums"]) / r["n"]
        moving = [j for j in active if ((moved[j] - centers[j]) ** 2).sum() > limit]
        centers.update(moved)
    best = {k: min((cost[j], j[1]) for j in jobs if j[0] == k)[1] for k in ks}
    return {k: centers[(k, best[k])] for k in ks}


def kmeans_labels(df: DataFrame, id_col: str, features: Sequence[str], ks: Iterable[int], n_init: int = 10, seed: int = 42) -> DataFrame:
    """The standardised rows with one label column ``k<k>`` per k."""
    ks = list(ks)
    rows = standardized(df, features)
    data = materialize(rows.select(F.col(id_col).cast("long").alias("id"), *rows.columns, F.array(*features).alias("vec"))
                       if "id" not in rows.columns else rows.withColumn("vec", F.array(*features)), "kmeans")
    fits = kmeans_fits(data, len(features), ks, n_init, seed)

    @F.pandas_udf("array<int>")
    def nearest(v: pd.Series) -> pd.Series:
        x = stack(v)
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.stack([square_distances(x, fits[k]).argmin(axis=1) for k in ks], axis=1).astype("int32")))

    labelled = data.withColumn("_l", nearest("vec"))
    return labelled.select(*rows.columns, *[F.col("_l")[i].alias(f"k{k}") for i, k in enumerate(ks)])


def kmeans_sweep(df: DataFrame, id_col: str, features: Sequence[str], ks: Sequence[int] = range(2, 12), n_init: int = 10,
                 seed: int = 42, sample: int = SAMPLE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Elbow table (k, inertia, silhouette, davies_bouldin, calinski_harabasz) and the labelled rows."""
    labelled = materialize(kmeans_labels(df, id_col, features, ks, n_init, seed), "labels")
    scores = score_clusterings(labelled, id_col, features, [f"k{k}" for k in ks], sample)
    table = scores.select(F.expr("cast(substring(clustering, 2) as int)").alias("k"), "inertia", "silhouette", "davies_bouldin", "calinski_harabasz")
    return table, labelled


def best_k(table: DataFrame) -> int:
    """k with the best silhouette; the smallest k wins a tie."""
    return table.na.drop(subset=["silhouette"]).orderBy(F.desc("silhouette"), "k").first()["k"]


# --- agglomerative ----------------------------------------------------------------------------------

def agglomerative_labels(
    df: DataFrame, id_col: str, features: Sequence[str], linkages: Sequence[str], ks: Sequence[int], neighbors: int = NEIGHBORS, top: int = TOP_CLUSTERS,
) -> tuple[DataFrame, list[str], DataFrame]:
    """Standardised rows with a label column ``<linkage>_k<k>`` per setting, those columns' names, and the
    merge table (linkage, step, a, b, height) of all rows."""
    rows = materialize(standardized(df, features), "rows")
    points = rows.select(F.col(id_col).cast("long").alias("id"), F.array(*features).alias("vec"))
    tree = merge_tree(points, linkages, neighbors, top)
    labels, names = cut_labels(points.select("id"), tree, linkages, ks)
    return rows.join(labels.withColumnRenamed("id", id_col), id_col), names, merge_steps(tree)


def agglomerative_sweep(
    df: DataFrame, id_col: str, features: Sequence[str], linkages: Sequence[str] = ("ward", "complete", "average"),
    ks: Sequence[int] = range(2, 9), neighbors: int = NEIGHBORS, min_size: int = 10, sample: int = SAMPLE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Score table (linkage, k, silhouette, davies_bouldin, calinski_harabasz) and the labelled rows.

    Settings with fewer than two clusters or a cluster under ``min_size`` rows are left out.
    """
    labelled, names, _ = agglomerative_labels(df, id_col, features, linkages, ks, neighbors)
    labelled = materialize(labelled, "labels")
    sizes = labelled.unpivot([], names, "clustering", "label").groupBy("clustering", "label").agg(F.count("*").alias("n"))
    usable = sizes.groupBy("clustering").agg(F.min("n").alias("smallest"), F.count("*").alias("k")).filter(
        (F.col("smallest") >= min_size) & (F.col("k") >= 2)).collect()  # one row per setting
    kept = [n for n in names if n in {r["clustering"] for r in usable}]
    if not kept:
        return df.sparkSession.createDataFrame([], "linkage string, k int, silhouette double, davies_bouldin double, calinski_harabasz double"), labelled
    scores = score_clusterings(labelled, id_col, features, kept, sample)
    return scores.select(
        F.split("clustering", "_k")[0].alias("linkage"), F.split("clustering", "_k")[1].cast("int").alias("k"),
        F.bround("silhouette", 4).alias("silhouette"), F.bround("davies_bouldin", 4).alias("davies_bouldin"),
        F.bround("calinski_harabasz", 1).alias("calinski_harabasz"),
    ), labelled


def compare_methods(df: DataFrame, id_col: str, features: Sequence[str], n_init: int = 10, neighbors: int = NEIGHBORS,
                    sample: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """(method, silhouette, davies_bouldin, calinski_harabasz): k-means 4 and 6, ward 4 and complete 4."""
    means = kmeans_labels(df, id_col, features, [4, 6], n_init, seed)
    trees, _, _ = agglomerative_labels(df, id_col, features, ["ward", "complete"], [4], neighbors)
    joined = means.join(trees.select(id_col, "ward_k4", "complete_k4"), id_col)
    names = {"k4": "KMeans_k4", "k6": "KMeans_k6", "ward_k4": "Hierarchical_ward_k4", "complete_k4": "Hierarchical_complete_k4"}
    scores = score_clusterings(joined.withColumnsRenamed(names), id_col, features, list(names.values()), sample)
    return scores.select(
        F.col("clustering").alias("method"), F.bround("silhouette", 4).alias("silhouette"),
        F.bround("davies_bouldin", 4).alias("davies_bouldin"), F.bround("calinski_harabasz", 1).alias("calinski_harabasz"))
