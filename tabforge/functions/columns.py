"""Small column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or dashes."""
    return F.col(f"`{name}`")


def is_true(cond: Column) -> Column:
    """A null comparison counts as False."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    return is_true(cond).cast("int")


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; null when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded(c: Column, digits: int = 6) -> Column:
    """Half-up rounding without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; null for a constant column.

    The built-in ``corr`` raises a division by zero on a constant column in ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0))


def order_hash(id_col: str) -> Column:
    """Pseudo-random order over integer ids in [0, 1000003); the id itself must break ties.

    Plain integer arithmetic, so any SQL engine reproduces it; ids of any size are reduced before they
    are multiplied.
    """
    return F.pmod(F.pmod(F.col(id_col).cast("bigint"), F.lit(ORDER_HASH_RANGE)) * F.lit(7919) + F.lit(104729), F.lit(ORDER_HASH_RANGE))


ORDER_HASH_RANGE = 1000003


def square_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)
