"""Marker cleaning, row exclusion, first row per key and column dropping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col, is_true, share


def null_markers(df: DataFrame, markers: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-cell markers in string columns become null, in one projection."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = strings if columns is None else strings & set(columns)
    return df.select(*[
        F.when(~col(c).isin(list(markers)), col(c)).alias(c) if c in targets else col(c) for c in df.columns
    ])


def count_markers(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Number of cells equal to a marker, per string column (null cells do not count)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[F.count_if(col(c).isin(list(markers))).alias(c) for c in strings])
    return counts.unpivot([], strings, "column", "n_markers")


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows whose value is listed; a null value is kept."""
    return df.filter(~is_true(col(column).isin(list(values))))


def excluded_share(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    n = F.count_if(col(column).isin(list(values)))
    return df.agg(n.alias("n_excluded"), F.count("*").alias("n_rows"), (share(n, F.count("*")) * 100).alias("pct_excluded"))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` values of every key (null keys form one group).

    ``row_number() = 1`` lets Spark put a group limit before the shuffle, so a key that owns a third
    of the table sends one row per input partition, not its whole history.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; absent ones are ignored."""
    return df.drop(*columns)


def keep_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select the listed columns that exist, in the listed order."""
    return df.select(*[col(c) for c in columns if c in df.columns])


def without_prefix(columns: Sequence[str], prefix: str) -> list[str]:
    return [c for c in columns if not c.startswith(prefix)]


def level_shares(df: DataFrame, columns: Sequence[str], level: str) -> DataFrame:
    """(column, share of ``level``); nulls count in the denominator. One pass for all columns."""
    present = [c for c in columns if c in df.columns]
    wide = df.agg(*[F.avg(is_true(col(c) == level).cast("double")).alias(c) for c in present])
    return wide.unpivot([], [col(c) for c in present], "column", "share")


def near_constant(df: DataFrame, columns: Sequence[str], level: str, threshold: float = 0.98) -> list[str]:
    """Names of columns whose share of ``level`` reaches the threshold. Fit step: one row per column."""
    rows = level_shares(df, columns, level).filter(F.col("share") >= threshold).collect()
    hits = {r["column"] for r in rows}
    return [c for c in columns if c in hits]


def null_audit(df: DataFrame) -> DataFrame:
    """Nulls per column, one pass."""
    wide = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], [col(c) for c in df.columns], "column", "n_null")


def type_breakdown(df: DataFrame) -> DataFrame:
    """Number of columns per type: schema metadata only."""
    rows = [(dtype,) for _, dtype in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "dtype string").groupBy("dtype").agg(F.count("*").alias("n_columns"))
