"""Blocks of nearby rows in their bounding boxes, and the joins of those that can reach each other.

Rows are ordered along a Z-curve over the quantiles of their dimensions and cut into runs of bounded
length, in ranges that Spark deals out. A block is known by its box, a run of blocks by the box around
theirs, about as many runs as blocks in a run. Pairs of runs whose boxes are too far apart go first,
then pairs of blocks; only then do rows travel, whole blocks at a time. A task holds a bounded group of left
blocks and one of right blocks, so a row travels once for each group that it can meet, not for each block.
Distances are one matrix product, and those near a limit are computed again exactly. Nothing about blocks
reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import materialize

#: Rows of a block.
BLOCK_ROWS = 1024
#: Bytes of the blocks of one side that a task holds, and parts into which a side is cut at least, if it has as many blocks.
SIDE_BYTES, LEAST_PARTS = 32 << 20, 5
#: Dimensions (those of the largest variance) and bits of a place on the curve.
CURVE_DIMS, CURVE_BITS, DIM_BITS = 12, 60, 10
#: Rows, at most, that choose the dimensions.
SOME_ROWS = 1000
#: Room for the numbers of blocks in one range.
RANGE_BLOCKS = 1 << 32


def greatest_differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances by the greatest difference of any dimension."""
    out = np.zeros((len(a), len(b)))
    if len(a) and len(b):
        for j in range(a.shape[1]):
            np.maximum(out, np.abs(a[:, j, None] - b[None, :, j]), out=out)
    return out


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, one dimension at a time: exact for equal points, no (a x b x d) array."""
    out = np.zeros((len(a), len(b)))
    if len(a) and len(b):
        for j in range(a.shape[1]):
            diff = a[:, j, None] - b[None, :, j]
            out += diff * diff
    return out


def rough_squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by a matrix product, and a bound of what they are off; exact where a value isn't finite."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b))), 0.0
    with np.errstate(all="ignore"):
        middle = b.mean(axis=0)  # about the middle little cancels
        x, y = a - middle, b - middle
        xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
        off = 8 * (a.shape[1] + 8) * np.finfo(float).eps * float(xx.max() + yy.max())
    if not np.isfinite(off):
        return square_distances(a, b), 0.0
    one = np.ones
    left = np.concatenate([-2 * x, xx[:, None], one((len(x), 1))], axis=1)
    right = np.concatenate([y, one((len(y), 1)), yy[:, None]], axis=1)
    return left @ right.T, off


def pair_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``a`` and the row of ``b`` beside it, summed as in ``square_distances``."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        diff = a[:, j] - b[:, j]
        out += diff * diff
    return out


def near_pairs(a: np.ndarray, b: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, place in b, exact distance) of the pairs not further apart than ``radius``."""
    rough, off = rough_squares(a, b)
    i, j = np.nonzero(rough <= radius * radius * (1 + 1e-12) + off)
    dist = np.sqrt(np.concatenate([pair_squares(a[i[k : k + PAIRS]], b[j[k : k + PAIRS]]) for k in range(0, len(i), PAIRS)])) if len(i) else np.zeros(0)
    near = dist <= radius
    return i[near], j[near], dist[near]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances to about seven digits or better: the small ones, where the product cancels, are exact."""
    d, off = rough_squares(a, b)
    i, j = np.nonzero(d < off * 1e6)
    for k in range(0, len(i), PAIRS):
        d[i[k : k + PAIRS], j[k : k + PAIRS]] = pair_squares(a[i[k : k + PAIRS]], b[j[k : k + PAIRS]])
    return np.sqrt(d, out=d)


#: Pairs whose vectors are gathered at once.
PAIRS = 1 << 16


@dataclass(frozen=True)
class Curve:
    """How to order vectors of ``size`` components: cut points of some of them, a fixed number for any number of rows."""

    rows: int
    size: int
    dims: list[int]
    cuts: list[np.ndarray]

    def place(self, vec: Column) -> Column:
        dims, cuts = self.dims, self.cuts
        bits = DIM_BITS if not dims else min(DIM_BITS, CURVE_BITS // len(dims))

        @F.pandas_udf("long")
        def on_curve(v: pd.Series) -> pd.Series:
            place = np.zeros(len(v), np.int64)
            if len(v) and dims:
                x = np.stack(v.to_numpy())
                codes = [np.searchsorted(c, x[:, d], side="right") for d, c in zip(dims, cuts)]
                for bit in range(bits - 1, -1, -1):
                    for code in codes:
                        place = (place << 1) | ((code >> bit) & 1)
            return pd.Series(place)

        return on_curve(vec)


def fit_curve(points: DataFrame, vec: str = "vec", block: int = BLOCK_ROWS) -> Curve:
    """Quantiles of the dimensions of largest variance among some rows; none where all rows fit in one block."""
    rows, size = points.agg(F.count("*"), F.coalesce(F.max(F.size(vec)), F.lit(0))).first()
    if rows <= block or not size:
        return Curve(rows, size, [], [])
    # The choice of dimensions only says which rows lie side by side, so some rows are enough for it.
    some = columns_of(points.select(vec).limit(SOME_ROWS).toArrow())[vec]
    dims = sorted(np.argsort(-some.var(axis=0), kind="stable")[:CURVE_DIMS].tolist())
    parts = 1 << min(DIM_BITS, CURVE_BITS // len(dims))
    probs = [i / parts for i in range(1, parts)]
    cuts = points.agg(*[F.percentile_approx(F.col(vec)[i], probs, max(1000, 10 * parts)) for i in dims]).first()
    return Curve(rows, size, dims, [np.array(c or [], np.float64) for c in cuts])


def lay_out(points: DataFrame, curve: Curve, vec: str = "vec", block: int = BLOCK_ROWS) -> DataFrame:
    """``points`` (grp, vec, ...) as a table with ``block`` and ``run``: at most ``block`` rows of one group and of
    neighbouring places, and the blocks around."""
    per_run = max(1, math.ceil(math.sqrt(curve.rows / block)))
    order = ["grp", "_place", vec]
    ranges = max(1, min(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), curve.rows // (2 * block)))
    ranged = points.withColumn("_place", curve.place(F.col(vec))).repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id().cast("long"))
    in_range = Window.partitionBy("_range")
    # Groups come one after the other, so adding the number of the group keeps their blocks apart.
    number = F.floor((F.row_number().over(in_range.orderBy(*order)) - 1) / block) + F.dense_rank().over(in_range.orderBy("grp")) - 1
    placed = ranged.withColumn("_number", number)
    return materialize(placed.select(
        *points.columns, (F.col("_range") * RANGE_BLOCKS + F.col("_number")).alias("block"),
        (F.col("_range") * RANGE_BLOCKS + F.floor(F.col("_number") / per_run)).alias("run")), "blocks")


BOX = "grp string, block long, run long, n long, low array<double>, high array<double>, reach double"


def _box_table(table: pa.Table, low: np.ndarray, high: np.ndarray, n: int, block: int) -> pa.Table:
    reach = table.column("reach")
    return pa.table([pa.array([table.column("grp")[0].as_py()], pa.string()), pa.array([block], pa.int64()), pa.array([table.column("run")[0].as_py()], pa.int64()), pa.array([n], pa.int64()),
                     pa.array([low], pa.list_(pa.float64())), pa.array([high], pa.list_(pa.float64())),
                     pa.array([None if reach.null_count else max(reach.to_pylist())], pa.float64())], names=["grp", "block", "run", "n", "low", "high", "reach"])


def boxes(placed: DataFrame) -> DataFrame:
    """(grp, block, run, n, low, high, reach) of every block; ``reach`` is the greatest of a column of that name, null where a row's is."""

    def run(table: pa.Table) -> pa.Table:
        vec = columns_of(table.select(["vec"]))["vec"]
        return _box_table(table, vec.min(axis=0), vec.max(axis=0), len(vec), table.column("block")[0].as_py())

    reach = F.col("reach") if "reach" in placed.columns else F.lit(None).cast("double").alias("reach")
    return placed.select("grp", "block", "run", "vec", reach).groupBy("block").applyInArrow(run, BOX)


def runs_of(blocks: DataFrame) -> DataFrame:
    """The boxes around the blocks of each group and run."""

    def run(table: pa.Table) -> pa.Table:
        rows = columns_of(table.select(["n", "low", "high"]))
        return _box_table(table, rows["low"].min(axis=0), rows["high"].max(axis=0), int(rows["n"].sum()), -1)

    return blocks.select("grp", "block", "run", "n", "low", "high", "reach").groupBy("grp", "run").applyInArrow(run, BOX)


def _length(apart: Column, greatest: bool) -> Column:
    return F.aggregate(apart, F.lit(0.0), lambda s, x: F.greatest(s, x)) if greatest else F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x))


def box_gap(a: str, b: str, greatest: bool = False) -> Column:
    """Least distance of the boxes in columns ``<a>_low``, ``<a>_high`` and ``<b>_...``; Euclidean, or the greatest difference."""
    above = F.zip_with(f"{b}_low", f"{a}_high", lambda x, y: x - y)
    below = F.zip_with(f"{a}_low", f"{b}_high", lambda x, y: x - y)
    return _length(F.zip_with(above, below, lambda x, y: F.greatest(x, y, F.lit(0.0))), greatest)


def box_span(a: str, b: str, greatest: bool = False) -> Column:
    """Greatest distance of two boxes."""
    above = F.zip_with(f"{b}_high", f"{a}_low", lambda x, y: x - y)
    below = F.zip_with(f"{a}_high", f"{b}_low", lambda x, y: x - y)
    return _length(F.zip_with(above, below, lambda x, y: F.greatest(x, y)), greatest)


def widened(bound: Column) -> Column:
    """A distance with room for rounding: no neighbour may get lost."""
    return bound * (1 + 1e-9) + 1e-9


def _named(df: DataFrame, side: str, *plain: str) -> DataFrame:
    return df.select(*plain, *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in plain])


def reachable(left: DataFrame, right: DataFrame, greatest: bool = False) -> DataFrame:
    """(lb, rb, gap) of the blocks of one group not further apart than the left one's ``reach``; null: any distance."""
    left = left.withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
    near = F.col("gap") <= widened(F.col("l_reach"))
    left_runs, right_runs = _named(runs_of(left), "l", "grp"), _named(runs_of(right), "r", "grp")
    runs = left_runs.join(right_runs, "grp").withColumn("gap", box_gap("l", "r", greatest)).filter(near).select("grp", "l_run", "r_run")
    pairs = _named(left, "l", "grp").join(runs, ["grp", "l_run"]).join(_named(right, "r", "grp"), ["grp", "r_run"])
    return pairs.withColumn("gap", box_gap("l", "r", greatest)).filter(near).select(F.col("l_block").alias("lb"), F.col("r_block").alias("rb"), "gap")


# --- tasks -------------------------------------------------------------------------------------------

Columns = dict[str, np.ndarray]


def columns_of(table: pa.Table) -> Columns:
    """Columns as arrays; lists, all of one length, as matrices."""
    out = {}
    for name in table.column_names:
        c = table.column(name).combine_chunks()
        if pa.types.is_list(c.type):
            flat = c.flatten().to_numpy(zero_copy_only=False)
            out[name] = flat.reshape(len(c), len(flat) // max(1, len(c)))
        else:
            out[name] = c.to_numpy(zero_copy_only=False)
    return out


def rows_of(columns: Columns, chosen: np.ndarray) -> Columns:
    return {n: c[chosen] for n, c in columns.items()}


def arrow_table(columns: Columns, schema: str) -> pa.Table:
    """Arrays as a table with the types of a DDL schema of plain types and arrays of numbers."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    names, types = zip(*[field.strip().split(" ") for field in schema.split(",")])
    lists = [columns[n].ndim > 1 or t.startswith("array") for n, t in zip(names, types)]
    return pa.table([pa.array(list(columns[n]) if many else columns[n], kinds[t]) for n, t, many in zip(names, types, lists)], names=list(names))


def _row_bytes(df: DataFrame) -> int:
    row = df.first()
    return 8 * sum(len(v) if isinstance(v, list) else 1 for v in row) if row else 8


def _grouped(pairs: DataFrame, left: DataFrame, right: DataFrame, rows: int) -> DataFrame:
    """``pairs`` with the groups ``lg`` and ``rg`` of their blocks: neighbouring numbers, whole ranges where those are small."""
    number = {c: F.col(c).bitwiseAND(F.lit(RANGE_BLOCKS - 1)) for c in ("lb", "rb")}
    span = {c: F.shiftright(F.col(c), 32) for c in ("lb", "rb")}
    most = pairs.agg(*[F.coalesce(F.max(x), F.lit(0)) for c in ("lb", "rb") for x in (span[c], number[c])]).first()
    for k, (c, out, df) in enumerate((("lb", "lg", left), ("rb", "rg", right))):
        ranges, in_range = most[2 * k] + 1, most[2 * k + 1] + 1
        size = min(max(1, SIDE_BYTES // (_row_bytes(df) * rows)), math.ceil(ranges * in_range / LEAST_PARTS))
        if size > in_range:
            pairs = pairs.withColumn(out, F.floor(span[c] / (size // in_range)))
        else:
            pairs = pairs.withColumn(out, span[c] * RANGE_BLOCKS + F.floor(number[c] / size))
    return materialize(pairs.select("lb", "rb", "gap", "lg", "rg"), "pairs")


def block_join(left: DataFrame, right: DataFrame, pairs: DataFrame, fn: Callable[[Columns, list[Columns]], Columns], schema: str,
               finish: Callable[[Columns], Columns] | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    """Run ``fn`` on every left block and the right blocks that it meets in a task, the nearest first.

    Both sides carry ``block``, of about ``rows`` rows; all rows of the two blocks of a pair (lb, rb, gap) meet once.
    Blocks lie in groups of ``SIDE_BYTES``, and a task takes the pairs of two groups. ``finish`` takes all that a task made.
    """
    grouped = _grouped(pairs, left, right, rows)
    lefts = left.join(grouped.select(F.col("lb").alias("block"), "lg", "rg").distinct(), "block")
    # Both sides may stem from one table: the right one gets names, so identities, of its own.
    met = right.join(grouped.select(F.col("rb").alias("block"), F.col("lg").alias("_lg"), F.col("rg").alias("_rg")).distinct(), "block")
    rights = met.select(F.col("_lg").alias("r__lg"), F.col("_rg").alias("r__rg"), *[F.col(c).alias(f"r_{c}") for c in right.columns])
    # The pairs come with the left rows.
    lefts = lefts.select("lg", "rg", *left.columns, *[F.lit(None).cast(t).alias(f"p_{c}") for c, t in (("lb", "long"), ("rb", "long"), ("gap", "double"))])
    listed = grouped.select("lg", "rg", *[F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema], *[F.col(c).alias(f"p_{c}") for c in ("lb", "rb", "gap")])
    empty = arrow_table({f.strip().split(" ")[0]: np.zeros(0) for f in schema.split(",")}, schema)
    names = left.columns

    def run(l: pa.Table, r: pa.Table) -> pa.Table:
        is_pair = l.column("p_lb").is_valid()
        todo = l.filter(is_pair).select(["p_lb", "p_gap", "p_rb"]).sort_by([(c, "ascending") for c in ("p_lb", "p_gap", "p_rb")])
        l = l.filter(l.column("p_lb").is_null()).select(names)
        if not l.num_rows or not r.num_rows or not todo.num_rows:
            return empty
        sides = []
        for t in (l, r.select([c for c in r.column_names if c not in ("r__lg", "r__rg")]).rename_columns([c.removeprefix("r_") for c in r.column_names if c not in ("r__lg", "r__rg")])):
            columns = columns_of(t)
            order = np.argsort(columns["block"], kind="stable")
            blocks, starts = np.unique(columns["block"][order], return_index=True)
            sides.append((columns, dict(zip(blocks.tolist(), np.split(order, starts[1:])))))
        (l_columns, l_rows), (r_columns, r_rows) = sides
        held: dict[int, Columns] = {}
        lb, rb = todo.column("p_lb").to_numpy(), todo.column("p_rb").to_numpy()
        out = []
        for chosen in np.split(np.arange(len(lb)), np.flatnonzero(lb[1:] != lb[:-1]) + 1):
            own = int(lb[chosen[0]])
            others = [int(b) for b in rb[chosen] if int(b) in r_rows]
            if own not in l_rows or not others:
                continue
            for b in others:
                if b not in held:
                    held[b] = rows_of(r_columns, r_rows[b])
            out.append(fn(rows_of(l_columns, l_rows[own]), [held[b] for b in others]))
        if not out:
            return empty
        made = {c: np.concatenate([o[c] for o in out]) for c in out[0]}
        return arrow_table(finish(made) if finish else made, schema)

    return lefts.unionByName(listed).groupBy("lg", "rg").cogroup(rights.groupBy("r__lg", "r__rg")).applyInArrow(run, schema)


def hash_blocks(df: DataFrame, rows: int, id_col: str, block: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with blocks of about ``block`` rows by a hash of the id, for joins of all rows with all rows."""
    return df.withColumn("block", F.pmod(F.xxhash64(id_col), F.lit(max(1, -(-rows // block)))))


def every_pair(left: int, right: int, spark) -> DataFrame:
    """All (lb, rb, gap) of so many blocks on each side."""
    lb = spark.range(left).withColumnRenamed("id", "lb")
    return lb.select("lb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(right - 1).cast("long"))).alias("rb"), F.lit(0.0).alias("gap"))
