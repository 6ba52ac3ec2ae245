"""Column profiles, distributions, correlations, histograms and quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col, correlation, is_true, share
from tabforge.operators.ordering import exact_quantiles
from tabforge.session import materialize


def _cell_counts(df: DataFrame) -> DataFrame:
    """(column, value as text, cnt) for every column, nulls kept: one scan and one shuffle, pre-aggregated, written out."""
    cells = df.unpivot([], [col(c).cast("string").alias(c) for c in df.columns], "column", "value")
    return materialize(cells.groupBy("column", "value").agg(F.count("*").alias("cnt")), "cells")


def _typed_cell(place: int, f: T.StructField) -> Column:
    """(place, whole, real, text) of a cell in the narrowest form that tells its values apart; a missing one is null in all."""
    c = col(f.name)
    whole, real, text = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        whole = c.cast("long")
    elif isinstance(f.dataType, T.DateType):
        whole = F.unix_date(c).cast("long")
    elif isinstance(f.dataType, T.TimestampType):
        whole = F.unix_micros(c)
    elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        real = c.cast("double")
    else:
        text = c.cast("string")
    return F.struct(F.lit(place).alias("place"), whole.alias("whole"), real.alias("real"), text.alias("text"))


def column_profile(df: DataFrame, top: int = 4) -> DataFrame:
    """column, dtype, n_missing, pct_missing, n_unique, min, mean, max, std, top_values.

    The table is scanned once: each row gives its cells, typed, and those are counted by value in one
    pre-aggregated shuffle. Missing, distinct and top values and the moments all come from the counts.
    """
    fields = df.schema.fields
    cells = df.select(F.inline(F.array(*[_typed_cell(i, f) for i, f in enumerate(fields)])))
    cells = materialize(cells.groupBy("place", "whole", "real", "text").agg(F.count("*").alias("cnt")), "cells")
    there = F.coalesce(F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull(), F.lit(False))
    numeric = F.array(*[F.lit(isinstance(f.dataType, T.NumericType)) for f in fields])[F.col("place")]
    number = F.when(numeric, F.coalesce(F.col("real"), F.col("whole").cast("double"), F.col("text").try_cast("double")))
    cells = cells.withColumn("number", number)
    n = F.sum(F.when(F.col("number").isNotNull(), F.col("cnt")))
    counts = cells.groupBy("place").agg(
        F.sum(F.when(there, 0).otherwise(F.col("cnt"))).alias("n_missing"), F.count_if(there).alias("n_unique"), F.sum("cnt").alias("n_rows"),
        F.min("number").alias("min"), F.max("number").alias("max"), n.alias("n_numbers"), F.try_divide(F.sum(F.col("number") * F.col("cnt")), n).alias("mean"))
    around = cells.join(F.broadcast(counts.select("place", "mean")), "place")  # one row a column
    spread = around.groupBy("place").agg(F.sum(F.col("cnt") * (F.col("number") - F.col("mean")) * (F.col("number") - F.col("mean"))).alias("squares"))
    names = F.array(*[F.lit(f.name) for f in fields])[F.col("place")]
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])[F.col("place")]
    is_text = F.array(*[F.lit(isinstance(f.dataType, T.StringType)) for f in fields])[F.col("place")]
    ranked = Window.partitionBy("place").orderBy(F.desc("cnt"), "text")
    tops = (
        cells.filter(is_text & F.col("text").isNotNull()).withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") <= top)
        .groupBy("place").agg(F.array_sort(F.collect_list(F.struct("rn", "text", "cnt"))).alias("t"))
        .select("place", F.array_join(F.transform("t", lambda s: F.concat_ws("=", s["text"], s["cnt"])), ", ").alias("top_values"))
    )
    std = F.sqrt(F.when(F.col("n_numbers") > 1, F.col("squares") / (F.col("n_numbers") - 1)))
    return counts.join(spread, "place").join(tops, "place", "left").select(
        names.alias("column"), types.alias("dtype"), "n_missing", (share(F.col("n_missing"), F.col("n_rows")) * 100).alias("pct_missing"), "n_unique",
        "min", "mean", "max", std.alias("std"), "top_values",
    )


def quality_report(
    df: DataFrame, level_columns: Sequence[str] = (), level: str = "No", identifiers: Sequence[str] = (),
    invalid: tuple[str, str] | None = None, high: float = 40.0, some: float = 5.0, constant: float = 98.0,
) -> DataFrame:
    """(rule, column, value): missing shares, near-constant columns, identifiers, invalid rows.

    All figures come from one aggregate over the table.
    """
    levels = [c for c in level_columns if c in df.columns]
    exprs = [(F.avg(col(c).isNull().cast("double")) * 100).alias(f"m:{c}") for c in df.columns]
    exprs += [(F.avg(is_true(col(c) == level).cast("double")) * 100).alias(f"l:{c}") for c in levels]
    if invalid and invalid[0] in df.columns:
        exprs.append(F.count_if(col(invalid[0]) == invalid[1]).cast("double").alias(f"i:{invalid[0]}"))
    wide = df.agg(*exprs)
    long = wide.unpivot([], [col(c) for c in wide.columns], "key", "value")
    kind, name, v = F.substring("key", 1, 1), F.expr("substring(key, 3)"), F.col("value")
    rule = (
        F.when((kind == "m") & (v > high), "high_missing").when((kind == "m") & (v > some), "missing")
        .when((kind == "l") & (v > constant), "near_constant").when((kind == "i") & (v > 0), "invalid_rows")
    )
    found = long.select(rule.alias("rule"), name.alias("column"), v).filter("rule is not null")
    ids = df.sparkSession.createDataFrame(
        [("identifier", c, None) for c in identifiers], "rule string, column string, value double"
    )
    return found.unionByName(ids)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """value, n, pct over all rows; null is a value."""
    counts = df.groupBy(col(column).alias("value")).agg(F.count("*").alias("n"))
    # The total comes from the counts, not from a second scan.
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("value", "n", (share(F.col("n"), total) * 100).alias("pct"))


def top_values(df: DataFrame, columns: Sequence[str], n: int = 10, with_null: bool = True) -> DataFrame:
    """(column, value, n, pct, n_unique) of the ``n`` most frequent values per column; ties by value."""
    present = [c for c in columns if c in df.columns]
    cells = _cell_counts(df.select(*[col(c) for c in present]))
    totals = cells.groupBy("column").agg(F.sum("cnt").alias("n_rows"), F.count("value").alias("n_unique"))
    if not with_null:
        cells = cells.filter("value is not null")
    w = Window.partitionBy("column").orderBy(F.desc("cnt"), F.asc_nulls_last("value"))
    top = cells.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
    return top.join(F.broadcast(totals), "column").select(
        "column", "value", F.col("cnt").alias("n"), (share(F.col("cnt"), F.col("n_rows")) * 100).alias("pct"), "n_unique"
    )


def class_balance(df: DataFrame, positive: Column) -> DataFrame:
    """n_pos, n_neg, pct_pos and the imbalance ratio n_neg / n_pos (null without positives)."""
    pos = F.count_if(is_true(positive))
    neg = F.count("*") - pos
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"), (share(pos, F.count("*")) * 100).alias("pct_pos"),
                  share(neg, pos).alias("imbalance"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, repeated rows, keys with more than one row and their share."""
    sizes = df.groupBy(col(key).alias("key")).agg(F.count("*").alias("size"))
    keys = F.count("key")
    multi = F.count_if((F.col("size") > 1) & F.col("key").isNotNull())
    return sizes.agg(
        F.sum("size").alias("n_rows"), keys.alias("n_keys"),
        (F.sum("size") - F.count("*")).alias("n_duplicates"),
        multi.alias("n_multi"), (share(multi, keys) * 100).alias("pct_multi"),
    )


def group_size_histogram(df: DataFrame, key: str, first: int | None = None) -> DataFrame:
    """(size, n_keys): how many keys have each number of rows; optionally the ``first`` smallest sizes."""
    sizes = df.filter(col(key).isNotNull()).groupBy(col(key).alias("key")).agg(F.count("*").alias("size"))
    hist = sizes.groupBy("size").agg(F.count("*").alias("n_keys"))
    return hist.orderBy("size").limit(first) if first else hist


def domain_counts(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """(value, n) for every value of an ordered domain, zero where absent; other values are left out."""
    counts = df.groupBy(col(column).alias("value")).agg(F.count("*").alias("n"))
    dim = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(domain)], "position int, value string")
    return dim.join(counts, "value", "left").select("position", "value", F.coalesce("n", F.lit(0)).alias("n"))


def rate_by_group(df: DataFrame, group: str, condition: Column) -> DataFrame:
    """n rows and percentage of rows meeting a condition, per group; null conditions count as no."""
    return df.groupBy(group).agg(F.count("*").alias("n"), (F.avg(is_true(condition).cast("double")) * 100).alias("pct"))


def rate_by_domain(df: DataFrame, group: str, condition: Column, domain: Sequence[str]) -> DataFrame:
    """``rate_by_group`` in domain order; a domain value without rows has a null rate."""
    dim = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(domain)], f"position int, {group} string")
    rates = rate_by_group(df, group, condition)
    return dim.join(rates, group, "left").select("position", group, F.coalesce("n", F.lit(0)).alias("n"), "pct")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max and cv% per column."""
    wide = df.agg(*[
        F.struct(F.count(col(c)).alias("n"), F.avg(col(c)).alias("mean"), F.stddev_samp(col(c)).alias("std"),
                 F.min(col(c)).cast("double").alias("min"), F.max(col(c)).cast("double").alias("max")).alias(c)
        for c in columns
    ]).unpivot([], [col(c) for c in columns], "column", "s").select("column", "s.*")
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    ])
    return wide.join(q, "column", "left").withColumn("cv_pct", F.try_divide(F.col("std"), F.col("mean")) * 100)


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness per column; null under three values, 0 for a constant column."""
    def corrected(c):
        n = F.count(c).cast("double")
        return F.when(n > 2, F.when(F.min(c) == F.max(c), F.lit(0.0)).otherwise(F.skewness(c)) * F.sqrt(n * (n - 1)) / (n - 2))
    wide = df.agg(*[corrected(col(c)).alias(c) for c in columns])
    return wide.unpivot([], [col(c) for c in columns], "column", "skew")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair, from one aggregate over the upper triangle."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[correlation(col(a), col(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), col(str(i)).alias("corr")) for i, (a, b) in enumerate(pairs)]
    rows += [F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), col(str(i)).alias("corr")) for i, (a, b) in enumerate(pairs)]
    rows += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("corr")) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, corr) of every column with the target."""
    others = [c for c in columns if c != target]
    wide = df.agg(*[correlation(col(c), col(target)).alias(c) for c in others])
    return wide.unpivot([], [col(c) for c in others], "column", "corr")


def level_pivot(df: DataFrame, columns: Sequence[str], levels: Sequence[str], inactive: str = "No") -> DataFrame:
    """Per column the count of every level and the percentage of rows at an active level.

    The levels are given, so the whole report is one aggregate of conditional counts: nothing is
    unpivoted or shuffled but one row per input partition.
    """
    active = [v for v in levels if v != inactive]
    wide = df.agg(*[
        F.struct(
            *[F.count_if(col(c) == v).alias(f"n_{v.lower()}") for v in levels],
            (share(F.count_if(col(c).isin(active)), F.count("*")) * 100).alias("pct_active"),
        ).alias(c) for c in columns
    ])
    return wide.unpivot([], [col(c) for c in columns], "column", "s").select("column", "s.*")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) of equal-width bins between minimum and maximum; empty bins are listed."""
    x = col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    lo, hi = float(ends["lo"]), float(ends["hi"])
    if lo == hi:  # a constant column gets a unit range around its value
        lo, hi = lo - 0.5, hi + 0.5
    return _fixed_bins(df, x, lo, (hi - lo) / bins, bins)


def fixed_histogram(df: DataFrame, column: str, low: float, width: float, bins: int) -> DataFrame:
    """Histogram over given edges with the density n / (N * width); values outside are not counted."""
    h = _fixed_bins(df, col(column).cast("double"), low, width, bins)
    total = h.agg(F.sum("n")).scalar()
    return h.withColumn("density", share(F.col("n"), total * width))


def _fixed_bins(df: DataFrame, x: Column, lo: float, width: float, bins: int) -> DataFrame:
    hi = lo + width * bins
    b = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter((x >= lo) & (x <= hi)).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    dim = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return dim.join(counts, "bin", "left").select(
        "bin", (F.col("bin") * width + lo).alias("low"), ((F.col("bin") + 1) * width + lo).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles and whiskers (extreme values within 1.5 interquartile ranges) and the outlier count.

    A column without values has null statistics and no outliers.
    """
    q = {}
    for r in exact_quantiles(df, columns, [0.25, 0.5, 0.75]).collect():  # 3 rows per column
        q.setdefault(r["column"], {})[r["prob"]] = r["quantile"]
    cells = []
    for c in columns:
        if c not in q:
            nothing = F.max(F.lit(None).cast("double"))
            cells.append(F.struct(*[nothing.alias(n) for n in ("q1", "median", "q3", "whisker_low", "whisker_high")], (F.count("*") * 0).alias("n_outliers")).alias(c))
            continue
        q1, q2, q3 = (q[c][p] for p in (0.25, 0.5, 0.75))
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        x = col(c).cast("double")
        inside = (x >= lo) & (x <= hi)
        cells.append(F.struct(
            *[F.max(F.lit(v)).alias(n) for n, v in (("q1", q1), ("median", q2), ("q3", q3))],  # aggregates: nullable for every column
            F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        ).alias(c))
    return df.agg(*cells).unpivot([], [col(c) for c in columns], "column", "s").select("column", "s.*")


def sparse_report(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Top values of a mostly empty column with missing and present counts on every row."""
    counts = df.groupBy(col(column).alias("value")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n_present"),
    )).scalar()
    top = counts.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(n)
    return top.withColumn("_t", totals).select(
        "value", "n", "_t.*", (share(F.col("_t.n_missing"), F.col("_t.n_missing") + F.col("_t.n_present")) * 100).alias("pct_missing")
    )
