"""Cleaning, encoding and profiling on planted frames."""

import pytest
from pyspark.sql import functions as F

from tabforge import constants as K
from tabforge.operators import cleaning, encoding, folds, ordering, profiling
from tabforge.sources import tables


def test_markers_become_null(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "?"), (4, "None"), (5, " ? "), (6, "x")], "id int, c string")
    out = {r.id: r.c for r in cleaning.null_markers(df, ["?", "None", ""]).collect()}
    assert out == {1: None, 2: None, 3: None, 4: None, 5: " ? ", 6: "x"}


def test_exclusion_keeps_null_and_first_row_is_first_survivor(spark):
    df = spark.createDataFrame([(1, 1, 11), (1, 2, None), (1, 3, 5), (2, 9, 5), (2, 8, 5)], "k int, o int, v int")
    out = cleaning.first_per_key(cleaning.exclude_values(df, "v", [11]), "k", ["o"]).collect()
    assert sorted((r.k, r.o) for r in out) == [(1, 2), (2, 8)]


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = cleaning.first_per_key(df, "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_near_constant_at_the_threshold(spark):
    df = spark.createDataFrame([("No" if i < 98 else "Up", "No" if i < 97 else "Up", None if i < 3 else "No") for i in range(100)], "a string, b string, c string")
    assert cleaning.near_constant(df, ["a", "b", "c", "absent"], "No") == ["a"]


@pytest.mark.parametrize("code, want", [
    ("250", "Diabetes"), ("250.83", "Diabetes"), ("251", "Endocrine_Metabolic"), ("139", "Infectious"), ("139.5", "Unknown"), ("459.5", "Unknown"),
    ("0", "Unknown"), ("1000", "Unknown"), ("V45", "Supplementary"), ("E880", "External_Causes"), ("5d", "Unknown"), ("NaN", "Unknown"),
    (" 8 ", "Infectious"), (None, "Unknown"), ("?", "Unknown"), ("", "Unknown"), ("800", "Injury_Poisoning"),
])
def test_code_category(spark, code, want):
    df = spark.createDataFrame([(code,)], "c string")
    got = df.select(encoding.code_category(F.col("c"), K.CODE_RANGES, K.CODE_FIRST, K.CODE_PREFIXES)).first()[0]
    assert got == want


def test_flags_treat_null_as_no(spark):
    df = spark.createDataFrame([("No",), (None,), ("Up",)], "c string")
    assert [r[0] for r in df.select(encoding.level_flag(F.col("c"))).collect()] == [0, 0, 1]
    assert [r[0] for r in df.select(encoding.equals_flag(F.col("c"), "Up")).collect()] == [0, 0, 1]


def test_one_hot_null_is_all_zero_and_size_is_checked(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id int, c string")
    levels = encoding.fit_levels(df, ["c"])
    assert levels == {"c": ["a", "b"]}
    assert [tuple(r) for r in encoding.apply_one_hot(df, levels).orderBy("id").collect()] == [(1, 0, 1), (2, 0, 0), (3, 1, 0)]
    with pytest.raises(ValueError):
        encoding.fit_levels(df, ["c"], max_levels=1)


def test_ordinal_and_labels(spark):
    df = spark.createDataFrame([("b",), (None,), ("z",)], "c string")
    assert [r[0] for r in df.select(encoding.ordinal(F.col("c"), ["a", "b"])).collect()] == [1, -1, -1]
    assert [r[0] for r in df.select(encoding.map_labels(F.col("c"), {"b": "B"})).collect()] == ["B", "Unknown", "Unknown"]


def test_standardize_constant_and_two_valued(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (2.0, 5.0, 2), (3.0, 5.0, 3)], "x double, c double, t int")
    out = encoding.apply_standard(df, encoding.fit_standard(df, ["x", "c"])).collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0] and abs(sum(r.x for r in out)) < 1e-12
    two = spark.createDataFrame([(1, 0, 1, None), (1, 1, 2, 4), (1, 0, 3, 5)], "a int, b int, c int, d int")
    assert encoding.two_valued(two, ["a", "b", "c", "d"]) == ["b", "d"]


def test_quantiles_are_exact_with_ties_and_skew(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    x = np.where(rng.random(3000) < 0.4, 7.0, rng.normal(size=3000).round(2) * 10)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.prob: r.quantile for r in ordering.exact_quantiles(df, ["x"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p))


def test_running_total_and_rank_match_a_plain_window(spark):
    from pyspark.sql import Window
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"), (F.col("id") % 17).alias("v"))
    got = ordering.running_totals(df, "id", {"s": "v"}, ["g"])
    want = df.withColumn("w", F.sum("v").over(Window.partitionBy("g").orderBy("id")))
    assert got.join(want.select("id", "w"), "id").filter("s <> w").count() == 0 and got.count() == 2000
    ranked = ordering.bucketed_rank(df, "id", ["g"], "r")
    per = ranked.groupBy("g").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count_distinct("r").alias("k"), F.count("*").alias("n")).collect()
    assert all(r.lo == 1 and r.hi == r.n == r.k for r in per)


def test_next_in_key_crosses_slots(spark):
    from pyspark.sql import Window
    df = spark.range(500).select("id", (F.col("id") % 4).alias("k"), (F.col("id") * 37 % 501).alias("t"))
    got = ordering.next_in_key(df, "k", F.floor(F.col("t") / 50), ["t"], "t", "nxt")
    want = df.withColumn("w", F.lead("t").over(Window.partitionBy("k").orderBy("t")))
    assert got.join(want.select("id", "w"), "id").filter("not (nxt <=> w)").count() == 0


def test_folds_partition_and_keep_class_shares(spark):
    df = spark.range(103).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    sizes = {(r.y, r.fold): r["count"] for r in folds.k_folds(df, "id", 5, "y").groupBy("y", "fold").count().collect()}
    assert sum(sizes.values()) == 103
    for y in (0, 1):
        s = [sizes[(y, f)] for f in range(5)]
        assert max(s) - min(s) <= 1
    split = folds.holdout(df, "id", 0.2, "y").groupBy("y").agg(F.sum("is_test").alias("t")).collect()
    assert {r.y: r.t for r in split} == {0: 16, 1: 6}  # a fifth of 77 and of 26, rounded up


def test_profiles_on_empty_input(spark):
    empty = spark.createDataFrame([], "a string, b double")
    assert profiling.value_shares(empty, "a").count() == 0
    assert profiling.histogram(empty, "b", 5).count() == 0
    assert profiling.class_balance(empty, F.col("a") == "x").first().n_pos == 0
    assert profiling.column_profile(empty).count() == 0


def test_csv_and_preconditions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, c string")
    tables.write_csv(df, str(tmp_path / "t"))
    back = tables.read_csv(spark, str(tmp_path / "t"), df.schema)
    assert sorted((r.id, r.c) for r in back.collect()) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError, match="absent"):
        tables.require_columns(df, ["id", "absent"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.read_csv(spark, str(tmp_path / "none"), df.schema).count()
