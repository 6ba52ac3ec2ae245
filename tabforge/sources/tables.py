"""Readers and writers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    """Precondition of a stage: fail early, naming every absent column."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def load_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One parquet table of a folder, optionally narrowed so that the scan reads only ``columns``."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a declared schema. A missing path raises Spark's PATH_NOT_FOUND error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV without a row index. Keys such as a cluster label are ordinary columns."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def column_reference(df: DataFrame) -> DataFrame:
    """Name, type and number of values of every column, in order."""
    cells = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(dtype).alias("dtype"), F.count(F.col(f"`{name}`")).alias("n_values"))
             for i, (name, dtype) in enumerate(df.dtypes)]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def flag_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Split numeric columns into those holding only 0/1 (or null) and the others, in one pass."""
    checks = df.agg(*[
        F.coalesce(F.bool_and(F.col(f"`{c}`").isin(0, 1)), F.lit(True)).alias(c) for c in df.columns
    ]).first()
    flags = [c for c in df.columns if checks[c]]
    return flags, [c for c in df.columns if c not in flags]


def as_flags(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Force every column outside ``keep`` to 0/1: columns that are not 0/1 already become ``> 0``."""
    _, other = flag_columns(df.drop(*keep))
    return df.select(*[
        F.coalesce(F.col(f"`{c}`") > 0, F.lit(False)).cast("int").alias(c) if c in other else F.col(f"`{c}`")
        for c in df.columns
    ])


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Count, mean, median, population deviation, minimum and maximum of a numeric target."""
    from tabforge.operators.ordering import exact_quantiles

    y = F.col(target).cast("double")
    median = exact_quantiles(df, [target], [0.5]).agg(F.max("quantile")).scalar()
    return df.agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.stddev_pop(y).alias("std"),
        F.min(y).alias("min"), F.max(y).alias("max"),
    ).withColumn("median", median)


def target_counts(df: DataFrame, target: str) -> DataFrame:
    """(value, n) of the target's whole parts in order of the value; nulls are left out."""
    value = F.col(target).cast("double").cast("long")
    return df.filter(F.col(target).isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy("value")
