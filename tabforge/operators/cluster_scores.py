"""Quality of one or several clusterings of the same points.

Points: (id, vec array<double>, labels array<long>), one label per clustering. All clusterings of a sweep
are scored by the same jobs; results are keyed by position in the label array.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import col, order_hash, square_distance
from tabforge.operators.boxes import BLOCK_ROWS, Columns, block_join, distances, every_pair, hash_blocks, square_distances
from tabforge.session import materialize

SAMPLE_ROWS = 5000


def points_with_labels(df: DataFrame, id_col: str, features: Sequence[str], label_cols: Sequence[str]) -> DataFrame:
    return df.select(
        F.col(id_col).cast("long").alias("id"), F.array(*[col(c).cast("double") for c in features]).alias("vec"),
        F.array(*[col(c).cast("long") for c in label_cols]).alias("labels"),
    )


def _long(points: DataFrame) -> DataFrame:
    return points.select("id", "vec", F.posexplode("labels").alias("run", "label"))


def cluster_stats(points: DataFrame, dim: int) -> DataFrame:
    """(run, label, n, center, spread): size, centroid and within sum of squares of every cluster."""
    v = [F.col("vec")[i] for i in range(dim)]
    spread = F.count("*") * sum((F.var_pop(c) for c in v[1:]), F.var_pop(v[0]))
    return _long(points).groupBy("run", "label").agg(F.count("*").alias("n"), F.array(*[F.avg(c) for c in v]).alias("center"), spread.alias("spread"))


def calinski_harabasz(stats: DataFrame) -> DataFrame:
    """(run, n_clusters, inertia, calinski_harabasz) from cluster statistics alone: no second pass over the rows."""
    per_run = stats.groupBy("run").agg(
        F.collect_list(F.struct("n", "center")).alias("cs"), F.sum("n").cast("double").alias("rows"),
        F.count("*").alias("k"), F.sum("spread").alias("within"))
    def weighted(c: Column, size: Column) -> Column:
        return F.transform(c, lambda x: x * size)
    zero = F.transform(F.col("cs")[0]["center"], lambda x: F.lit(0.0))
    mean = F.aggregate("cs", zero, lambda acc, c: F.zip_with(acc, weighted(c["center"], c["n"] / F.col("rows")), lambda x, y: x + y))
    between = F.aggregate("cs", F.lit(0.0), lambda acc, c: acc + c["n"] * square_distance(c["center"], F.col("mean")))
    out = per_run.withColumn("mean", mean).withColumn("between", between)
    k, n = F.col("k"), F.col("rows")
    score = F.when((k > 1) & (n > k), F.try_divide(F.col("between") / (k - 1), F.col("within") / (n - k)))
    return out.select("run", k.alias("n_clusters"), F.col("within").alias("inertia"), score.alias("calinski_harabasz"))


def _worst_ratio(l: Columns, rs: list[Columns]) -> Columns:
    """Per left cluster the greatest (s_i + s_j) / d_ij against the others of the right blocks; 0 where centres coincide."""
    worst = np.full(len(l["s"]), -1.0)
    for r in rs:
        d = np.sqrt(square_distances(l["center"], r["center"]))
        ratio = np.divide(l["s"][:, None] + r["s"][None, :], d, out=np.zeros_like(d), where=d > 0)
        ratio[l["label"][:, None] == r["label"][None, :]] = -1.0
        worst = np.maximum(worst, ratio.max(axis=1))
    return {"run": l["run"], "label": l["label"], "worst": worst}


def davies_bouldin(points: DataFrame, stats: DataFrame) -> DataFrame:
    """(run, davies_bouldin): mean over clusters of the worst (s_i + s_j) / d_ij; null for one cluster.

    The rows are joined to their centroid once. The clusters of a run are compared in pairs of blocks,
    of which only each cluster's worst ratio is left.
    """
    centers = stats.select("run", "label", "center")
    mean_dist = _long(points).join(centers, ["run", "label"]).groupBy("run", "label").agg(
        F.avg(F.sqrt(square_distance(F.col("vec"), F.col("center")))).alias("s"))
    per_run = -(-(stats.groupBy("run").count().agg(F.max("count")).first()[0] or 1) // BLOCK_ROWS)
    block = F.col("run").cast("long") * per_run + F.pmod(F.xxhash64("label"), F.lit(per_run))
    clusters = materialize(mean_dist.join(centers, ["run", "label"]).withColumn("block", block), "clusters")
    blocks = clusters.select("run", "block").distinct()
    pairs = blocks.withColumnRenamed("block", "lb").join(blocks.withColumnRenamed("block", "rb"), "run").select("lb", "rb", F.lit(0.0).alias("gap"))
    worst = block_join(clusters, clusters, pairs, _worst_ratio, "run int, label long, worst double").groupBy("run", "label").agg(F.max("worst").alias("worst"))
    return worst.groupBy("run").agg(F.when(F.count("*") > 1, F.avg("worst")).alias("davies_bouldin"))


def _silhouettes(l: Columns, rs: list[Columns]) -> Columns:
    """Silhouette of every left row and run against the whole sample, one block on the right."""
    (r,) = rs
    out: dict[str, list] = {"run": [], "s": [], "n_labels": []}
    d = np.sqrt(square_distances(l["vec"], r["vec"]))
    for run in range(r["labels"].shape[1]):
        names, code = np.unique(r["labels"][:, run], return_inverse=True)
        size = np.bincount(code, minlength=len(names)).astype(float)
        order = np.argsort(code, kind="stable")
        starts = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(int)
        sums = np.add.reduceat(d[:, order], starts, axis=1)
        own = np.searchsorted(names, l["labels"][:, run])
        rows = np.arange(len(own))
        own_size = size[own]
        a = sums[rows, own] / np.maximum(own_size - 1, 1)
        means = sums / size
        means[rows, own] = np.inf
        b = means.min(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where((own_size > 1) & np.isfinite(b), (b - a) / np.maximum(a, b), 0.0)
        out["run"].append(np.full(len(own), run))
        out["s"].append(np.nan_to_num(s))
        out["n_labels"].append(np.full(len(own), len(names)))
    return {k: np.concatenate(v) for k, v in out.items()}


#: Left rows whose distances are computed at once, so that they stay in the cache, and labels that are summed by a product.
ROWS_AT_ONCE, FEW_LABELS = 256, 64


def _distance_sums(l: Columns, rs: list[Columns]) -> Columns:
    """Per left row, run and label of the right blocks: summed distances and rows."""
    names = [np.unique(np.concatenate([r["labels"][:, run] for r in rs])) for run in range(l["labels"].shape[1])]
    bounds = np.cumsum([0] + [len(x) for x in names])
    totals, sizes = np.zeros((len(l["id"]), bounds[-1])), np.zeros(bounds[-1], np.int64)
    for r in rs:
        codes = [np.searchsorted(x, r["labels"][:, run]) for run, x in enumerate(names)]
        for run, code in enumerate(codes):
            sizes[bounds[run] : bounds[run + 1]] += np.bincount(code, minlength=len(names[run]))
        hot = None
        if bounds[-1] <= FEW_LABELS:
            hot = np.zeros((len(r["id"]), bounds[-1]))
            for run, code in enumerate(codes):
                hot[np.arange(len(code)), bounds[run] + code] = 1.0
        for lo in range(0, len(totals), ROWS_AT_ONCE):
            d = distances(l["vec"][lo : lo + ROWS_AT_ONCE], r["vec"])
            if hot is not None:
                totals[lo : lo + ROWS_AT_ONCE] += d @ hot
                continue
            for run, code in enumerate(codes):
                there, size = np.unique(code, return_counts=True)
                totals[lo : lo + ROWS_AT_ONCE, bounds[run] + there] += np.add.reduceat(d[:, np.argsort(code, kind="stable")], np.cumsum(size) - size, axis=1)
    out: dict[str, list] = {"id": [], "run": [], "own": [], "label": [], "total": [], "n": []}
    for run, x in enumerate(names):
        out["id"].append(np.repeat(l["id"], len(x)))
        out["run"].append(np.full(len(totals) * len(x), run))
        out["own"].append((l["labels"][:, run, None] == x[None, :]).ravel())
        out["label"].append(np.tile(x, len(totals)))
        out["total"].append(totals[:, bounds[run] : bounds[run + 1]].ravel())
        out["n"].append(np.tile(sizes[bounds[run] : bounds[run + 1]], len(totals)))
    return {k: np.concatenate(v) for k, v in out.items()}


def _exact_silhouette(points: DataFrame) -> DataFrame:
    """Every row against every row, in pairs of blocks: a task sees one left block, sums per label leave it."""
    points = materialize(points, "points")
    n = points.count()
    blocked = hash_blocks(points, n, "id")
    n_blocks = max(1, -(-n // BLOCK_ROWS))
    parts = block_join(blocked, blocked, every_pair(n_blocks, n_blocks, points.sparkSession), _distance_sums, "id long, run int, own boolean, label long, total double, n long")
    sums = parts.groupBy("id", "run", "own", "label").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own, other = F.col("own"), ~F.col("own")
    row = sums.groupBy("id", "run").agg(
        F.max(F.when(own, F.col("n"))).alias("size"), F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(other, F.col("total") / F.col("n"))).alias("b"), F.count("*").alias("k"))
    s = F.when((F.col("size") > 1) & F.col("b").isNotNull(), F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).otherwise(0.0)
    per_run = row.groupBy("run").agg(F.avg(s).alias("s"), F.max("k").alias("k"))
    return per_run.select("run", F.when((F.col("k") > 1) & (F.col("k") < n), F.col("s")).alias("silhouette"))


def silhouette(points: DataFrame, sample: int | None = SAMPLE_ROWS) -> DataFrame:
    """(run, silhouette): mean Euclidean silhouette over the first ``sample`` rows in hash order, or over all with None.

    A sample is compared with itself as one right-hand block, so its size, the caller's choice, bounds a
    task; over all rows, both sides are cut into blocks and per-label sums leave a task, one for each row,
    run and label. Null where the rows hold fewer than two labels, or only singletons.
    """
    if sample is None:
        return _exact_silhouette(points)
    drawn = materialize(points.orderBy(order_hash("id"), "id").limit(sample), "sample")
    pairs = every_pair(max(1, -(-sample // BLOCK_ROWS)), 1, points.sparkSession)
    per_row = block_join(hash_blocks(drawn, sample, "id"), drawn.withColumn("block", F.lit(0).cast("long")), pairs, _silhouettes, "run int, s double, n_labels int")
    k, n = F.max("n_labels"), F.count("*")
    return per_row.groupBy("run").agg(F.when((k > 1) & (k < n), F.avg("s")).alias("silhouette"))


def score_clusterings(df: DataFrame, id_col: str, features: Sequence[str], label_cols: Sequence[str], sample: int | None = SAMPLE_ROWS) -> DataFrame:
    """(clustering, n_clusters, inertia, silhouette, davies_bouldin, calinski_harabasz) per label column."""
    points = materialize(points_with_labels(df, id_col, features, label_cols), "points")
    stats = materialize(cluster_stats(points, len(features)), "stats")
    names = F.array(*[F.lit(c) for c in label_cols])
    return (
        calinski_harabasz(stats).join(davies_bouldin(points, stats), "run").join(silhouette(points, sample), "run", "left")
        .select(names[F.col("run")].alias("clustering"), "n_clusters", "inertia", "silhouette", "davies_bouldin", "calinski_harabasz")
    )


def cluster_profile(df: DataFrame, label: str, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Mean of many columns per cluster, half-even rounded."""
    return df.groupBy(label).agg(*[F.bround(F.avg(col(c)), digits).alias(c) for c in columns])


def profile_z(profile: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Each profile column as z-score over the clusters (deviation n - 1); the profile has a row per cluster."""
    w = Window.partitionBy()
    return profile.select(label, *[
        F.coalesce(F.try_divide(col(c) - F.avg(col(c)).over(w), F.stddev_samp(col(c)).over(w)), F.lit(0.0)).alias(c) for c in columns
    ])


def cluster_rates(df: DataFrame, label: str, positive: str) -> DataFrame:
    """(label, n, mean, mean_pct) of a 0/1 column per label, the noise label included."""
    m = F.avg(F.col(positive).cast("double"))
    return df.groupBy(label).agg(F.count("*").alias("n"), m.alias("mean"), (m * 100).alias("mean_pct"))


def cluster_sizes(df: DataFrame, label: str, noise: int = -1) -> DataFrame:
    """(label, n, pct, is_noise)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.select(label, "n", (F.col("n") / total * 100).alias("pct"), (F.col(label) == noise).cast("int").alias("is_noise"))
