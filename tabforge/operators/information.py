"""Mutual information of numeric features and a class or a number, estimated from nearest neighbours.

Nothing is binned and no noise is added. A row's radius is the distance of its k-th nearest neighbour
(among the rows of its class on one feature; on feature and target together, by the greater of the two
differences), and the estimate compares the rows strictly inside that radius along each axis with k.
Where k neighbours coincide with the row, the radius is 0: the rows that coincide count then, so
features of few values come near their plug-in value. All features are estimated by the same jobs; rows
are folded to their different values first, so a value that a third of the rows share costs one point.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col
from tabforge.operators.neighbors import nearest_lists
from tabforge.operators.ordering import running_totals
from tabforge.session import materialize

#: Neighbours of the estimate.
NEIGHBORS = 3


def digamma(n: Column) -> Column:
    """Digamma of a positive number: the recurrence up to 8 above it, then the asymptotic series."""
    x = n.cast("double")
    z = x + 8
    w = 1 / (z * z)
    series = F.ln(z) - 1 / (2 * z) - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w * (1 / 240 - w / 132))))
    return series - sum((1 / (x + i) for i in range(1, 8)), 1 / x)


@F.pandas_udf(T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]))
def strict_ends(x: pd.Series, r: pd.Series) -> pd.DataFrame:
    """For a value x and a radius r: the greatest v below and the least v above with |v - x| >= r, as computed in
    doubles; with a radius of 0 the neighbours of x among the doubles. What lies between them is inside."""
    x, r = x.to_numpy(np.float64), r.to_numpy(np.float64)
    ends = []
    for sign in (-1.0, 1.0):
        # Halving over the doubles between x, which is inside, and a value that is not.
        inside, outside = _place(x), _place(np.nextafter(x + sign * 2 * r, sign * np.inf))
        for _ in range(64):
            middle = (inside & outside) + ((inside ^ outside) >> 1)
            near = sign * (_value(middle) - x) < r
            inside, outside = np.where(near, middle, inside), np.where(near, outside, middle)
        ends.append(np.where(r > 0, _value(outside), np.nextafter(x, sign * np.inf)))
    return pd.DataFrame({"low": ends[0], "high": ends[1]})


def _place(v: np.ndarray) -> np.ndarray:
    """Doubles as integers of the same order."""
    bits = (v + 0.0).view(np.int64)
    return np.where(bits < 0, np.int64(-(1 << 63)) - bits, bits)


def _value(place: np.ndarray) -> np.ndarray:
    return np.where(place < 0, np.int64(-(1 << 63)) - place, place).view(np.float64)


def count_inside(points: DataFrame, values: DataFrame, out: str) -> DataFrame:
    """``points`` (grp, low, high, ...) with the number of ``values`` (grp, v, cnt) strictly between low and high.

    Ends and values are sorted together, in ranges; a running total at either end gives the count.
    """
    ends = points.select("grp", F.explode(F.array("low", "high")).alias("v")).distinct().withColumn("cnt", F.lit(0).cast("long"))
    marks = values.select("grp", "v", "cnt").unionByName(ends).groupBy("grp", "v").agg(F.sum("cnt").alias("cnt"))
    totals = materialize(running_totals(marks, "v", {"upto": "cnt"}, ["grp"]), "totals")
    below = totals.select("grp", F.col("v").alias("high"), (F.col("upto") - F.col("cnt")).alias("_below"))
    up_to = totals.select("grp", F.col("v").alias("low"), F.col("upto").alias("_upto"))
    return points.join(below, ["grp", "high"]).join(up_to, ["grp", "low"]).withColumn(out, F.col("_below") - F.col("_upto")).drop("_below", "_upto")


def _radius(points: DataFrame, k: int, dims: int) -> DataFrame:
    """Different points (grp, v0.., cnt) with an id, the ``radius`` of the k-th of their neighbours in the group and ``near``,
    the neighbours that count: k, or all that coincide with the point where the radius is 0."""
    names = [f"v{i}" for i in range(dims)]
    vec = F.array(*names).alias("vec")
    points = materialize(points.withColumn("id", F.monotonically_increasing_id()), "different")
    searched = points.filter(F.col("cnt") <= k).select("grp", "id", vec)
    # A right row for each of at most k + 1 copies: more can't be among the nearest of another point.
    copies = points.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("cnt", F.lit(k + 1)).cast("int"))))
    right = copies.select("grp", (F.col("id") * (k + 1) + F.col("copy") - 1).alias("id"), vec)
    near, _ = nearest_lists(searched, right, k + 1, greatest=True)
    # The point itself is among them at distance 0; with fewer rows than k in a group, the last one counts.
    last = near.groupBy("id").agg(F.max("dist").alias("radius"), (F.count("*") - 1).alias("found"))
    joined = points.join(last, "id", "left")
    radius = F.coalesce("radius", F.lit(0.0))
    return joined.withColumn("radius", radius).withColumn("near", F.when(radius == 0, F.col("cnt")).otherwise(F.col("found")))


def _long(df: DataFrame, features: Sequence[str], *more: Column) -> DataFrame:
    """(feature, x, more) of every feature; a null value is 0, as elsewhere in the ranking."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(col(c).cast("double"), F.lit(0.0)).alias("x")) for c in features])
    return df.select(*more, F.inline(pairs))


def mutual_information_class(df: DataFrame, features: Sequence[str], y: str, k: int = NEIGHBORS) -> DataFrame:
    """(feature, mutual_info) in nats of each feature with a class, at least 0.

    psi(n) + mean(psi(near)) - mean(psi(rows of the class)) - mean(psi(rows inside the radius)). Rows
    without a class and classes of one row are left out; a class of k rows or fewer uses all of them.
    """
    label = col(y).cast("string")
    rows = _long(df.filter(col(y).isNotNull()), features, label.alias("label")).withColumn("x", F.col("x") + F.lit(0.0))
    folded = materialize(rows.groupBy("feature", "label", F.col("x").alias("v0")).agg(F.count("*").alias("cnt")), "values")
    sizes = folded.groupBy("feature", "label").agg(F.sum("cnt").alias("n_label")).filter("n_label > 1")
    used = folded.join(sizes, ["feature", "label"])
    found = _radius(used.select(F.concat_ws("\x01", "feature", "label").alias("grp"), "feature", "n_label", "v0", "cnt"), k, 1)
    ends = strict_ends(F.col("v0"), F.col("radius"))
    points = materialize(found.select(F.col("feature").alias("grp"), "cnt", "n_label", "near", ends.alias("e")).select("grp", "cnt", "n_label", "near", "e.low", "e.high"), "radius")
    values = used.groupBy(F.col("feature").alias("grp"), F.col("v0").alias("v")).agg(F.sum("cnt").alias("cnt"))
    counted = count_inside(points, values, "inside")
    weight = F.col("cnt")
    score = F.sum(weight * (digamma(F.col("near")) - digamma(F.col("n_label")) - digamma(F.col("inside")))) / F.sum(weight) + digamma(F.sum(weight))
    scores = counted.groupBy(F.col("grp").alias("feature")).agg(F.greatest(score, F.lit(0.0)).alias("mutual_info"))
    return _every_feature(df, features, scores)


def mutual_information_number(df: DataFrame, features: Sequence[str], y: str, k: int = NEIGHBORS) -> DataFrame:
    """(feature, mutual_info) in nats of each feature with a number, at least 0.

    psi(n) + mean(psi(near)) - mean(psi(inside along the feature)) - mean(psi(inside along the target)).
    Both axes are divided by their deviation first. Rows without a target are left out.
    """
    rows = _long(df.filter(col(y).isNotNull()), features, col(y).cast("double").alias("y"))
    scaled = materialize(rows.withColumnRenamed("y", "v1"), "long")
    by = scaled.groupBy("feature").agg(F.stddev_pop("x").alias("sx"), F.stddev_pop("v1").alias("sy"))  # one row a feature
    def unit(c: str, s: str) -> Column:
        return F.when(F.col(s) > 0, F.col(c) / F.col(s)).otherwise(F.lit(0.0)) + F.lit(0.0)
    pairs = scaled.join(F.broadcast(by), "feature").select("feature", unit("x", "sx").alias("v0"), unit("v1", "sy").alias("v1"))
    folded = materialize(pairs.groupBy(F.col("feature").alias("grp"), "v0", "v1").agg(F.count("*").alias("cnt")), "values")
    points = _radius(folded, k, 2).select("grp", "id", "cnt", "near", "v0", "v1", "radius")
    for axis in ("v0", "v1"):
        ends = strict_ends(F.col(axis), F.col("radius"))
        points = materialize(points.withColumn("e", ends).select(*points.columns, "e.low", "e.high"), "radius")
        values = folded.groupBy("grp", F.col(axis).alias("v")).agg(F.sum("cnt").alias("cnt"))
        points = count_inside(points, values, f"inside_{axis}").drop("low", "high")
    weight = F.col("cnt")
    score = F.sum(weight * (digamma(F.col("near")) - digamma(F.col("inside_v0")) - digamma(F.col("inside_v1")))) / F.sum(weight) + digamma(F.sum(weight))
    scores = points.groupBy(F.col("grp").alias("feature")).agg(F.greatest(score, F.lit(0.0)).alias("mutual_info"))
    return _every_feature(df, features, scores)


def mutual_information(df: DataFrame, features: Sequence[str], y: str, classify: bool, k: int = NEIGHBORS) -> DataFrame:
    """(feature, mutual_info) with a class or with a number."""
    return (mutual_information_class if classify else mutual_information_number)(df, features, y, k)


def _every_feature(df: DataFrame, features: Sequence[str], scores: DataFrame) -> DataFrame:
    """Features without any usable row score 0."""
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return names.join(scores, "feature", "left").select("feature", F.coalesce("mutual_info", F.lit(0.0)).alias("mutual_info"))
