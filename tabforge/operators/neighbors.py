"""Exact neighbour joins in Euclidean space without a cross join.

Rows lie in blocks of a Z-curve (``operators/boxes.py``). A first pass searches each left row's own
block, which bounds the distance of its k-th neighbour; a second visits only the blocks whose boxes lie
within the bound of some row, and in a task only the rows that reach the box. What leaves a task is, per
left row, its best k, never the pairs. Copies of a vector are collapsed before any of this, so a group
of copies costs one point.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import order_hash
from tabforge.operators.boxes import (
    BLOCK_ROWS, Columns, arrow_table, block_join, box_span, boxes, columns_of, fit_curve, greatest_differences, lay_out, pair_squares, reachable, rough_squares, rows_of, runs_of, square_distances,
    PAIRS,
)
from tabforge.operators.ordering import bucketed_rank, running_totals
from tabforge.session import materialize


def stack(s: pd.Series) -> np.ndarray:
    return np.stack(s.to_numpy()).astype(np.float64) if len(s) else np.empty((0, 0))


# --- k nearest neighbours ---------------------------------------------------------------------------

FOUND = "id long, neighbor long, dist double"


def _best(df: DataFrame, k: int) -> DataFrame:
    """The k nearest per id; ties by neighbour id. The rank filter is pushed below the shuffle."""
    w = Window.partitionBy("id").orderBy("dist", "neighbor")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _rough(a: np.ndarray, b: np.ndarray, greatest: bool) -> tuple[np.ndarray, float]:
    return (greatest_differences(a, b), 0.0) if greatest else rough_squares(a, b)


def _exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, greatest: bool) -> np.ndarray:
    """Distances of the rows ``i`` of a and ``j`` of b."""
    parts = [(a[i[k : k + PAIRS]], b[j[k : k + PAIRS]]) for k in range(0, len(i), PAIRS)]
    found = [np.abs(x - y).max(axis=1, initial=0) if greatest else np.sqrt(pair_squares(x, y)) for x, y in parts]
    return np.concatenate(found) if found else np.zeros(0)


def _nearest(l: Columns, r: Columns, k: int, greatest: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places on the right, distances) of the k nearest of each left row, ties by neighbour id."""
    rough, off = _rough(l["vec"], r["vec"], greatest)
    k = min(k, rough.shape[1])
    if not rough.size or not k:
        return np.zeros((len(l["id"]), 0), np.int64), np.zeros((len(l["id"]), 0))
    # All that could be among the k, ties with the last included, then in order.
    last = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
    i, j = np.nonzero(~(rough > last + 2 * off))
    dist = _exact(l["vec"], r["vec"], i, j, greatest)
    order = np.lexsort((r["id"][j], dist, i))
    starts = np.searchsorted(i, np.arange(len(rough)))
    top = order[(starts[:, None] + np.arange(k))]
    return j[top], dist[top]


def _merged(best: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
    """The k best of each row, (distance, id, whether found here), with pairs found; ``rows`` ascend."""
    k = best[0].shape[1]
    touched = np.unique(rows)
    row = np.concatenate([rows, np.repeat(touched, k)])
    d = np.concatenate([dist, best[0][touched].ravel()])
    neighbor = np.concatenate([ids, best[1][touched].ravel()])
    new = np.concatenate([np.ones(len(rows), bool), best[2][touched].ravel()])
    order = np.lexsort((neighbor, ~new, d, row))
    first = np.searchsorted(row[order], touched)
    top = order[first[:, None] + np.arange(k)]
    for held, found in zip(best, (d, neighbor, new)):
        held[touched] = found[top]


def _top_k(k: int, greatest: bool):
    """The k nearest right rows of the left rows, of those whose ``reach`` touches a block's box and that are nearer than the ``bounds`` already found."""
    def fn(l: Columns, rs: list[Columns]) -> Columns:
        reach = np.where(np.isnan(l["reach"]), np.inf, l["reach"])
        best = l["bounds"].copy(), np.zeros((len(reach), k), np.int64), np.zeros((len(reach), k), bool)
        for r in rs:
            limit = np.minimum(reach, best[0][:, -1]) * (1 + 1e-9) + 1e-9
            apart = np.maximum(np.maximum(r["vec"].min(axis=0) - l["vec"], l["vec"] - r["vec"].max(axis=0)), 0)
            gap = apart.max(axis=1, initial=0) if greatest else np.sqrt((apart * apart).sum(axis=1))
            rows = np.flatnonzero(gap <= limit)
            if not len(rows):
                continue
            vec, limit = l["vec"][rows], limit[rows]
            rough, off = _rough(vec, r["vec"], greatest)
            most = limit if greatest else limit * limit + off
            open_rows = np.flatnonzero(np.isinf(limit))
            if len(open_rows) and rough.shape[1] > k:
                most[open_rows] = np.partition(rough[open_rows], k - 1, axis=1)[:, k - 1] + 2 * off
            i, j = np.nonzero(rough <= most[:, None])
            if len(i):
                _merged(best, rows[i], _exact(vec, r["vec"], i, j, greatest), r["id"][j])
        row, place = np.nonzero(best[2])
        return {"id": l["id"][row], "neighbor": best[1][row, place], "dist": best[0][row, place]}
    return fn


def _own_blocks(placed: DataFrame, k: int, greatest: bool) -> DataFrame:
    """(grp, id, vec, block, run, neighbors, dists, reach, bounds) of the left rows (side 0): the nearest right rows (side 1) of their own block.

    ``reach`` is the distance of the k-th, null where the block has fewer; ``bounds`` are k distances, infinite beyond those found.
    """
    schema = "id long, vec array<double>, block long, run long, neighbors array<long>, dists array<double>, reach double, bounds array<double>, grp string"

    def run(table: pa.Table) -> pa.Table:
        grp = table.column("grp")[0].as_py()
        rows = columns_of(table.drop_columns(["grp"]))
        l, r = rows_of(rows, rows["side"] == 0), rows_of(rows, rows["side"] == 1)
        near, dist = _nearest(l, r, k, greatest) if len(l["id"]) and len(r["id"]) else (np.zeros((len(l["id"]), 0), np.int64), np.zeros((len(l["id"]), 0)))
        l["neighbors"], l["dists"] = r["id"][near] if len(r["id"]) else near, dist
        reach = dist[:, -1] if near.shape[1] == k else np.full(len(near), np.nan)
        bounds = np.concatenate([dist, np.full((len(dist), k - dist.shape[1]), np.inf)], axis=1)
        out = arrow_table(l | {"reach": reach, "bounds": bounds, "grp": np.full(len(near), grp, object)}, schema)
        return out if near.shape[1] == k else out.set_column(6, "reach", pa.nulls(len(near), pa.float64()))

    return placed.groupBy("block").applyInArrow(run, schema)


def _with_reach(lefts: DataFrame, rights: DataFrame, k: int, greatest: bool) -> DataFrame:
    """Left boxes without a reach get the greatest distance of the run, of those that hold k right rows, where it is least."""
    full = runs_of(rights).filter(F.col("n") >= k).select("grp", F.col("low").alias("r_low"), F.col("high").alias("r_high"))
    span = box_span("l", "r", greatest)
    open_ends = lefts.filter("reach is null").select("grp", "block", "run", "n", F.col("low").alias("l_low"), F.col("high").alias("l_high"))
    bounded = open_ends.join(full, "grp", "left").groupBy("grp", "block", "run").agg(
        F.first("n").alias("n"), F.first("l_low").alias("low"), F.first("l_high").alias("high"), F.min(span).alias("reach"))
    return lefts.filter("reach is not null").unionByName(bounded)


def nearest_lists(left: DataFrame, right: DataFrame, k: int, greatest: bool = False, block: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(id, neighbor, dist, rank) of the k nearest right rows of the same group, and the left rows (grp, id, vec) as a table.

    Both frames are (grp string, id, vec). Left ids tell rows apart across groups. Distances are
    Euclidean, or with ``greatest`` the greatest difference in any dimension.
    """
    both = materialize(left.select("grp", "id", "vec").withColumn("side", F.lit(0)).unionByName(right.select("grp", "id", "vec").withColumn("side", F.lit(1))), "points")
    curve = fit_curve(both, block=2 * block)
    placed = lay_out(both, curve, block=2 * block)
    own = materialize(_own_blocks(placed, k, greatest), "near")
    found = own.select("id", F.inline(F.arrays_zip(F.col("neighbors").alias("neighbor"), F.col("dists").alias("dist"))))
    if curve.rows > 2 * block:
        rights = placed.filter("side = 1").select("id", "vec", "block")
        left_boxes = materialize(boxes(own), "boxes")
        right_boxes = materialize(boxes(placed.filter("side = 1")), "boxes")
        pairs = reachable(_with_reach(left_boxes, right_boxes, k, greatest), right_boxes, greatest).filter("lb <> rb")
        found = found.unionByName(block_join(own.select("id", "vec", "block", "reach", "bounds"), rights, pairs, _top_k(k, greatest), FOUND, rows=2 * block))
    return _best(found, k), own.select("grp", "id", "vec")


def knn_join(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, vec: str, k: int, exclude_self: bool = False, block: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, neighbor, dist, rank): the exact k nearest right rows of every left row, ties by neighbour id.

    Ids are integers, ``vec`` is an array of doubles in both frames. ``exclude_self`` drops the row with
    the same id. Among copies of a right vector only the k + 1 smallest ids can ever be chosen, so only
    they take part; copies on the left are searched once.
    """
    wanted = k + 1 if exclude_self else k
    l = left.select(F.col(left_id).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    r = right.select(F.col(right_id).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    copies = Window.partitionBy("vec").orderBy("id")
    r = r.withColumn("_n", F.row_number().over(copies)).filter(F.col("_n") <= wanted)
    searched = l.groupBy("vec").agg(F.min("id").alias("id"))
    one = F.lit("").alias("grp")
    near, kept = nearest_lists(searched.select(one, "id", "vec"), r.select(one, "id", "vec"), wanted, block=block)
    lists = near.groupBy("id").agg(F.collect_list(F.struct("neighbor", "dist")).alias("near"))
    by_vec = kept.join(lists, "id").select("vec", "near")
    hits = l.join(by_vec, "vec").select("id", F.inline("near"))
    return _best(hits.filter("neighbor <> id") if exclude_self else hits, k)


def knn_graph(points: DataFrame, id_col: str, vec: str, k: int = 10, **kw) -> DataFrame:
    """Symmetric neighbour graph (src, dst, w): w = 1 for mutual neighbours, 0.5 for one-sided ones."""
    near = knn_join(points, points, id_col, id_col, vec, k, exclude_self=True, **kw)
    one = near.select(F.col("id").alias("src"), F.col("neighbor").alias("dst"))
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.groupBy("src", "dst").agg((F.count("*") * F.lit(0.5)).alias("w"))


def kth_distance(points: DataFrame, id_col: str, vec: str, k: int = 5, **kw) -> DataFrame:
    """(id, dist) to the k-th nearest point, the point itself counting as the first."""
    return knn_join(points, points, id_col, id_col, vec, k, **kw).filter(F.col("rank") == k).select("id", "dist")


def descending_curve(df: DataFrame, id_col: str, value: str) -> DataFrame:
    """(id, value, position): rows from the largest value down; equal values in hash order of the id.

    A running count over distinct values gives the first position of each value; rows of one value are
    ranked in buckets, so a value shared by a third of the rows is no single task.
    """
    df = materialize(df.select(id_col, value), "curve")
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    before = running_totals(counts, value, {"before": "n"}, descending=True, exclusive=True).select(value, "before")
    ranked = bucketed_rank(df, id_col, [value], "_r")
    return ranked.join(before, value).select(id_col, value, (F.col("before") + F.col("_r")).cast("bigint").alias("position")).orderBy("position")


def knn_vote(
    train: DataFrame, test: DataFrame, id_col: str, vec: str, y: str, k: int, **kw
) -> DataFrame:
    """(id, score, pred): share of positive labels among the k nearest training rows, uniform votes."""
    near = knn_join(test, train, id_col, id_col, vec, k, **kw)
    labels = train.select(F.col(id_col).alias("neighbor"), F.col(y).cast("double").alias("_y"))
    return near.join(labels, "neighbor").groupBy("id").agg(F.avg("_y").alias("score")).withColumn("pred", (F.col("score") > 0.5).cast("int"))


# --- synthetic minority rows -------------------------------------------------------------------------

def smote(df: DataFrame, id_col: str, features: Sequence[str], y: str, k: int = 5, **kw) -> DataFrame:
    """Synthetic minority rows that balance a 0/1 label: (id, features..., y, synthetic = 1).

    The deficit is spread over the minority rows in hash order. Copy number j of a row moves towards
    its (hash(id, j) mod k)-th nearest minority neighbour by a fraction in [0, 1) that is arithmetic too,
    so a rerun, or another engine, draws the same rows. A single minority row has no neighbour and is
    copied; with one class there is no deficit and no row.
    """
    counts = {r[y]: r["count"] for r in df.groupBy(y).count().collect()}  # two classes
    if len(counts) < 2:
        return df.select(F.col(id_col).cast("long").alias("id"), F.lit(0).alias("j"), *[F.col(c).cast("double").alias(c) for c in features], y, F.lit(1).alias("synthetic")).limit(0)
    minority = min(counts, key=lambda c: (counts[c], -c))
    n_min, deficit = counts[minority], abs(counts[0] - counts[1])
    small = df.filter(F.col(y) == minority).select(F.col(id_col).cast("long").alias("id"), *[F.col(c).cast("double").alias(c) for c in features])
    small = materialize(small.withColumn("vec", F.array(*features)), "minority")
    if n_min > 1:
        near = knn_join(small, small, "id", "id", "vec", k, exclude_self=True, **kw)
    else:
        near = small.select("id", F.col("id").alias("neighbor"), F.lit(1).alias("rank"))
    ranked = bucketed_rank(small.select("id", "vec"), "id", (), "_rank")
    base, extra = divmod(deficit, n_min)
    n_near = min(k, n_min - 1)
    draws = (
        ranked.withColumn("j", F.explode(F.expr(f"filter(sequence(0, {base}), j -> j < {base} + int(_rank <= {extra}))")))
        .withColumn("pick", (F.pmod(F.pmod("id", F.lit(max(n_near, 1))) * 31 + F.col("j") * 17 + 7, F.lit(max(n_near, 1))) + 1).cast("int"))
        .withColumn("gap", F.pmod(F.pmod("id", F.lit(1000)) * 7919 + F.col("j") * 104729, F.lit(1000)) / F.lit(1000.0))
    )
    target = small.select(F.col("id").alias("neighbor"), F.col("vec").alias("_to"))
    moved = (
        draws.join(near.select("id", "neighbor", F.col("rank").alias("pick")), ["id", "pick"]).join(target, "neighbor")
        .withColumn("new", F.zip_with("vec", "_to", lambda a, b: a + (b - a) * F.col("gap")))
    )
    return moved.select("id", "j", *[F.col("new")[i].alias(c) for i, c in enumerate(features)], F.lit(minority).alias(y), F.lit(1).alias("synthetic"))
