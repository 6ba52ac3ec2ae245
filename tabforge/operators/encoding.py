"""Category mapping, flags, one-hot, ratios, standardising and binarising.

Encoders whose output columns depend on the data come in two steps: ``fit_*`` runs one aggregate and
returns a small plan (checked for size), ``apply_*`` is a pure projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, flag, is_true, total
from tabforge.operators.ordering import exact_quantiles

# Plain decimal or exponent notation. Tested before the cast: a cast alone accepts '5d' and 'NaN'.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def code_category(
    code: Column, ranges: Sequence[tuple[str, float, float]], first: tuple[str, float, float] | None = None,
    prefixes: Mapping[str, str] | None = None, default: str = "Unknown",
) -> Column:
    """Category of a textual code.

    Trim white space of any kind; a known prefix decides; else the number decides: ``first`` is a half-open range tested before
    the closed ``ranges``. Null, text that is no number, and numbers in no range give ``default``. The
    range table is a handful of rows, so it is an expression and needs no join.
    """
    text = F.regexp_replace(code, r"(?U)^\s+|\s+$", "")
    number = F.when(text.rlike(NUMBER), F.try_cast(text, "double")) if hasattr(F, "try_cast") else \
        F.when(text.rlike(NUMBER), text.try_cast("double"))
    result = F.lit(default)
    for name, low, high in reversed(list(ranges)):
        result = F.when((number >= low) & (number <= high), name).otherwise(result)
    if first:
        result = F.when((number >= first[1]) & (number < first[2]), first[0]).otherwise(result)
    for prefix, name in reversed(list((prefixes or {}).items())):
        result = F.when(text.startswith(prefix), name).otherwise(result)
    return result


def map_labels(c: Column, labels: Mapping, default: str = "Unknown") -> Column:
    """Dictionary lookup with a default for null and unmapped values."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(default))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, label: str, out: str, default: str = "Unknown") -> DataFrame:
    """Left lookup join with a default. ``dim`` must be unique on ``dim_key``.

    No broadcast hint: Spark broadcasts a dimension under its size threshold and shuffles a larger one.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"), F.col(label).alias("_label"))
    return (
        df.join(side, F.col(key) == F.col("_dim_key"), "left")
        .withColumn(out, F.coalesce("_label", F.lit(default))).drop("_dim_key", "_label")
    )


def ordinal(c: Column, domain: Sequence[str], unknown: int = -1) -> Column:
    """Position of the value in an ordered domain; null and unlisted values give ``unknown``."""
    position = F.array_position(F.array(*[F.lit(d) for d in domain]), c) - 1
    return F.coalesce(position, F.lit(unknown)).cast("int")


def equals_flag(c: Column, value: str) -> Column:
    return flag(c == value)


def level_flag(c: Column, inactive: str = "No") -> Column:
    """0 for the inactive level and null, 1 for anything else."""
    return (F.coalesce(c, F.lit(inactive)) != inactive).cast("int")


def active_count(columns: Sequence[str]) -> Column:
    return total([col(c) for c in columns])


def fill_unknown(df: DataFrame, columns: Sequence[str], value: str = "Unknown") -> DataFrame:
    return df.na.fill(value, subset=list(columns))


def fit_levels(df: DataFrame, columns: Sequence[str], max_levels: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct levels of category columns; each becomes an output column of its own.

    ``max_levels``, where given, refuses more levels in total before any reaches the driver.
    """
    long = df.unpivot([], [col(c).cast("string").alias(c) for c in columns], "column", "level")
    found = long.filter("level is not null").distinct()
    rows = (found if max_levels is None else found.limit(max_levels + 1)).collect()
    if max_levels is not None and len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} levels in {list(columns)}: not category columns")
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        levels[r["column"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def apply_one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 columns ``column_level`` for every level, after the remaining columns; null gives all zeros."""
    kept = [col(c) for c in df.columns if c not in levels]
    hot = [flag(col(c).cast("string") == v).alias(f"{c}_{v}") for c, vs in levels.items() for v in vs]
    return df.select(*kept, *hot)


def ratio(numerator: Column, days: Column) -> Column:
    """numerator / max(days, 1)."""
    return numerator / F.greatest(days, F.lit(1))


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column: one aggregate row."""
    row = df.agg(*[f(col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in columns}


def apply_standard(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a column without variance becomes 0 and is not divided."""
    return df.withColumns({
        c: (col(c).cast("double") - F.lit(m)) / F.lit(s if s > 0 else 1.0) for c, (m, s) in scale.items()
    })


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of several columns; one row per column comes back."""
    return {r["column"]: r["quantile"] for r in exact_quantiles(df, columns, [0.5]).collect()}


def apply_above(df: DataFrame, cuts: Mapping[str, float], suffix: str = "_high") -> DataFrame:
    """Add a 0/1 column per cut: 1 where the value lies above it."""
    return df.withColumns({f"{c}{suffix}": flag(col(c) > F.lit(v)) for c, v in cuts.items()})


def two_valued(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns holding exactly two distinct non-null values.

    A column is two-valued when minimum and maximum differ and nothing else occurs: two passes of
    constant memory, instead of counting distinct values of every column.
    """
    ends = df.agg(*[f(col(c)).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    varied = [c for c in columns if ends[f"lo_{c}"] is not None and ends[f"lo_{c}"] != ends[f"hi_{c}"]]
    if not varied:
        return []
    inner = df.agg(*[
        F.count_if(~is_true(col(c).isin(ends[f"lo_{c}"], ends[f"hi_{c}"])) & col(c).isNotNull()).alias(c) for c in varied
    ]).first()
    return [c for c in varied if inner[c] == 0]
