"""Class weights, folds and splits. Assignment is a rank in hash order, never a random draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import share
from tabforge.operators.ordering import bucketed_rank, join_same


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """(class, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(F.col(y).alias("class")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.withColumn("_t", totals).select("class", "n", share(F.col("_t.rows"), F.col("_t.classes") * F.col("n")).alias("weight"))


def with_class_weight(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """Attach the balanced weight to every row; the class table has one row per class."""
    w = class_weights(df, y).select(F.col("class").alias(y), F.col("weight").alias(out))
    return join_same(df, w, [y])


def positive_scale(df: DataFrame, y: str) -> DataFrame:
    """Negatives per positive."""
    pos = F.count_if(F.col(y) == 1)
    return df.agg(share(F.count("*") - pos, pos).alias("scale_pos_weight"))


def k_folds(df: DataFrame, id_col: str, k: int = 5, stratify: str | None = None, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; fold sizes differ by at most one, per class when stratified."""
    ranked = bucketed_rank(df, id_col, [stratify] if stratify else [], "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def holdout(df: DataFrame, id_col: str, share_test: float = 0.2, stratify: str | None = None, out: str = "is_test") -> DataFrame:
    """1 for the first ``share_test`` of the rows in hash order, rounded up; per class when stratified."""
    by = [stratify] if stratify else []
    ranked = bucketed_rank(df, id_col, by, "_rank")
    sizes = df.groupBy(*by).agg(F.count("*").alias("_size"))
    ranked = join_same(ranked, sizes, by) if by else ranked.withColumn("_size", sizes.scalar())
    return ranked.withColumn(out, (F.col("_rank") <= F.ceil(F.col("_size") * F.lit(share_test))).cast("int")).drop("_rank", "_size")
