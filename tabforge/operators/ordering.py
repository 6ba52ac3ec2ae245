"""Ranks, running totals and neighbours-in-order that never put one whole group into one task.

A window over an unbounded group runs in a single task. The operators here cut every group into
ordered buckets (slices of a uniform hash, or range partitions), run the window inside a bucket, and
add per-bucket offsets, which are few.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import ORDER_HASH_RANGE, order_hash
from tabforge.session import materialize

#: Rows that one window task may hold; the number of buckets follows from the number of rows.
BUCKET_ROWS = 100_000


def bucket_count(rows: int) -> int:
    return max(1, min(ORDER_HASH_RANGE, math.ceil(rows / BUCKET_ROWS)))


def join_same(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi join where null keys match null keys, keeping ``df``'s key columns."""
    renamed = other.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return df.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])


def _bucket_offsets(df: DataFrame, by: Sequence[str], bucket: str, sums: Mapping[str, Column]) -> DataFrame:
    """Per (group, bucket) the totals of all earlier buckets; one row a group and bucket."""
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*by, bucket).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return totals.select(
        *by, bucket, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in sums]
    )


def bucketed_rank(df: DataFrame, id_col: str, by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """1-based rank inside each ``by`` group in hash order of an integer id (ties by id).

    The hash is uniform, so equal slices of its range are equal-sized buckets and no statistics are
    needed. A group holding a third of the rows is spread over all its buckets.
    """
    width = ORDER_HASH_RANGE // bucket_count(df.count()) + 1
    df = df.withColumn("_h", order_hash(id_col)).withColumn("_b", F.floor(F.col("_h") / width).cast("int"))
    offsets = _bucket_offsets(df, by, "_b", {"_n": F.lit(1)})
    within = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", id_col))
    return join_same(df, offsets, [*by, "_b"]).withColumn(out, (within + F.col("_before__n")).cast("bigint")).drop("_h", "_b", "_before__n")


def range_parts(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` as a table of consecutive ranges of ``order``, numbered by ``_b``.

    Spark draws the range bounds from a sample, so ranges are about equal and there are as many as the
    session has shuffle partitions. The number is written with the row: all that reads it sees one cut.
    """
    return materialize(df.repartitionByRange(*order).withColumn("_b", F.spark_partition_id()), "ranges")


def running_totals(
    df: DataFrame, order: str, sums: Mapping[str, str], by: Sequence[str] = (), descending: bool = False, exclusive: bool = False,
) -> DataFrame:
    """Running totals of columns in the order of a numeric column, per group.

    ``df`` must hold one row per (group, order value) -- aggregate first. ``sums`` maps output name to
    input column. ``exclusive`` leaves the row's own value out. Rows are cut into ranges of (group,
    value); a range adds one offset per group that it holds.
    """
    key = (-F.col(order) if descending else F.col(order)).cast("double")
    placed = range_parts(df.withColumn("_k", key), [*by, "_k"])
    offsets = _bucket_offsets(placed, by, "_b", {n: F.col(c) for n, c in sums.items()})
    last = -1 if exclusive else 0
    inside = Window.partitionBy(*by, "_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, last)
    joined = join_same(placed, offsets, [*by, "_b"])
    return joined.select(
        *df.columns, *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_before_{n}")).alias(n) for n, c in sums.items()])


def range_rank(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """1-based rank inside each ``by`` group in the order of several columns; rows equal in all of them in any order."""
    placed = range_parts(df, [*by, *order])
    offsets = _bucket_offsets(placed, by, "_b", {"_n": F.lit(1)})
    within = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order))
    return join_same(placed, offsets, [*by, "_b"]).select(*df.columns, (within + F.col("_before__n")).cast("bigint").alias(out))


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, cnt) of non-null numeric values: the pre-aggregated form quantiles work on."""
    long = df.unpivot([], [F.col(f"`{c}`").cast("double").alias(c) for c in columns], "column", "value")
    return long.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("cnt"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles, long form (column, prob, quantile).

    The built-in exact ``percentile`` keeps every distinct value of a column in one buffer. Here the
    distinct values stay distributed: count per value, running count, then pick the one or two rows
    that cover position prob * (n - 1).
    """
    counts = materialize(value_counts_long(df, columns), "counts")
    ranked = running_totals(counts, "value", {"hi": "cnt"}, by=["column"])
    n = counts.groupBy("column").agg(F.sum("cnt").alias("n"))
    probs_col = F.array(*[F.lit(float(p)) for p in probs])
    hits = (
        ranked.join(n, "column")  # one row per profiled column
        .withColumn("prob", F.explode(probs_col))
        .withColumn("pos", F.col("prob") * (F.col("n") - 1))
        .withColumn("lo_pos", F.floor("pos")).withColumn("hi_pos", F.ceil("pos"))
        .withColumn("first", F.col("hi") - F.col("cnt"))
    )
    covers_lo = (F.col("first") <= F.col("lo_pos")) & (F.col("lo_pos") < F.col("hi"))
    covers_hi = (F.col("first") <= F.col("hi_pos")) & (F.col("hi_pos") < F.col("hi"))
    picked = hits.filter(covers_lo | covers_hi).groupBy("column", "prob").agg(
        F.max(F.when(covers_lo, F.col("value"))).alias("lo"),
        F.max(F.when(covers_hi, F.col("value"))).alias("up"),
        F.max(F.col("pos") - F.col("lo_pos")).alias("frac"),
    )
    return picked.select("column", "prob", (F.col("lo") + (F.col("up") - F.col("lo")) * F.col("frac")).alias("quantile"))


def next_in_key(df: DataFrame, key: str, slot: Column, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``value`` of the next row of the same key, null for the last one.

    ``slot`` is a coarse, order-preserving bucket (a year, a month), so even a key that owns a third of
    the table is cut into slots: the window runs inside a slot, and the last row of a slot takes the
    head of the key's next slot.
    """
    df = df.withColumn("_slot", slot)
    inside = df.withColumn("_next", F.lead(value).over(Window.partitionBy(key, "_slot").orderBy(*order)))
    heads = df.groupBy(key, "_slot").agg(F.min(value).alias("_head"))
    following = heads.select(
        key, "_slot", F.lead("_head").over(Window.partitionBy(key).orderBy("_slot")).alias("_later")
    )
    return (
        join_same(inside, following, [key, "_slot"])
        .withColumn(out, F.coalesce("_next", "_later")).drop("_slot", "_next", "_later")
    )
