"""Queries over profiles, distributions and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.frames_sql import DAY_LEVELS, MARKED, SCORED, VISITS
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import cleaning, profiling
from tabforge.plans import frames
from tabforge.sources.tables import load_table


def _r(df, *names):
    return df.withColumns({n: rounded(F.col(n)) for n in names})


def _column_sql(table: str, c: str, t: str) -> str:
    if t == "string":
        low = mean = high = std = "NULL::DOUBLE"
        tops = (f"(SELECT string_agg(v || '=' || k, ', ' ORDER BY k DESC, v) FROM (SELECT {c} AS v, count(*) AS k FROM {table} "
                f"WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY k DESC, v LIMIT 4))")
    else:
        low, mean, high, std = f"min({c})::DOUBLE", f"round(avg({c}), 6)", f"max({c})::DOUBLE", f"round(stddev_samp({c}), 6)"
        tops = "NULL::VARCHAR"
    return (
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) FILTER ({c} IS NULL) AS n_missing, "
        f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS pct_missing, count(DISTINCT {c}) AS n_unique, "
        f"{low} AS min, {mean} AS mean, {high} AS max, {std} AS std, {tops} AS top_values FROM {table}"
    )


PROFILE_SQL = f"WITH {MARKED}, wide AS (SELECT c.*, p_retailprice AS price FROM cleaned c JOIN part USING (p_partkey)) " + " UNION ALL ".join(
    _column_sql("wide", c, t) for c, t in
    {"p_partkey": "bigint", "brand": "string", "ptype": "string", "size_text": "string", "price": "double"}.items()
)


def _part_with_gaps(spark, sf):
    clean = cleaning.null_markers(frames.marked_parts(spark, sf), ["?", "None", ""])
    price = load_table(spark, sf, "part", "p_partkey", F.col("p_retailprice").alias("price"))
    return clean.join(price, "p_partkey")


@query("column_profile", PROFILE_SQL)
def column_profile(spark, sf):
    """A1."""
    return _r(profiling.column_profile(_part_with_gaps(spark, sf)), "pct_missing", "mean", "std")


@query("quality_report", f"""WITH {MARKED}, m AS (
  SELECT 'brand' AS "column", 100.0 * avg((brand IS NULL)::INT) AS v FROM cleaned UNION ALL
  SELECT 'ptype', 100.0 * avg((ptype IS NULL)::INT) FROM cleaned UNION ALL
  SELECT 'size_text', 100.0 * avg((size_text IS NULL)::INT) FROM cleaned)
SELECT CASE WHEN v > 40 THEN 'high_missing' ELSE 'missing' END AS rule, "column", round(v, 6) AS value FROM m WHERE v > 5
UNION ALL SELECT 'near_constant', 'ptype', round(100.0 * avg(coalesce(ptype = 'ECONOMY', false)::INT), 6) FROM cleaned
  HAVING avg(coalesce(ptype = 'ECONOMY', false)::INT) > 0.1
UNION ALL SELECT 'near_constant', 'brand', round(100.0 * avg(coalesce(brand = 'ECONOMY', false)::INT), 6) FROM cleaned
  HAVING avg(coalesce(brand = 'ECONOMY', false)::INT) > 0.1
UNION ALL SELECT 'identifier', 'p_partkey', NULL
UNION ALL SELECT 'invalid_rows', 'brand', count(*)::DOUBLE FROM cleaned WHERE brand = 'Brand#1' HAVING count(*) > 0""")
def quality_report(spark, sf):
    """A18. One type holds more than 10 % of the parts, which stands in for a near-constant level."""
    clean = cleaning.null_markers(frames.marked_parts(spark, sf), ["?", "None", ""])
    return _r(profiling.quality_report(clean, ["ptype", "brand", "absent"], "ECONOMY", ["p_partkey"], ("brand", "Brand#1"), constant=10.0), "value")


@query("value_shares", f"WITH {VISITS} SELECT readmitted AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM visits), 6) AS pct FROM visits GROUP BY 1")
def value_shares(spark, sf):
    """A2."""
    return _r(profiling.value_shares(frames.visits(spark, sf), "readmitted"), "pct")


@query("imbalance", f"""WITH {VISITS} SELECT count(*) FILTER (readmitted = '<30') AS n_pos, count(*) FILTER (readmitted <> '<30') AS n_neg,
  round(100.0 * count(*) FILTER (readmitted = '<30') / count(*), 6) AS pct_pos,
  round(count(*) FILTER (readmitted <> '<30') / count(*) FILTER (readmitted = '<30'), 6) AS imbalance FROM visits""")
def imbalance(spark, sf):
    """A3 E4."""
    return _r(profiling.class_balance(frames.visits(spark, sf), F.col("readmitted") == "<30"), "pct_pos", "imbalance")


def _top_sql(columns: list[str], table: str, n: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", value, n, round(100.0 * n / tot, 6) AS pct, n_unique FROM (
        SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS tot, count({c}) OVER () AS n_unique,
          row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR) NULLS LAST) AS rn FROM {table} GROUP BY {c}) WHERE rn <= {n}"""
        for c in columns)


@query("top_values", f"WITH {MARKED} {_top_sql(['brand', 'ptype', 'size_text'], 'cleaned', 10)}")
def top_values(spark, sf):
    """A8 T3."""
    clean = cleaning.null_markers(frames.marked_parts(spark, sf), ["?", "None", ""])
    return _r(profiling.top_values(clean, ["brand", "ptype", "size_text", "absent"], 10), "pct")


@query("dup_keys", """WITH s AS (SELECT user_id, count(*) AS k FROM events GROUP BY 1)
SELECT sum(k)::BIGINT AS n_rows, count(*) AS n_keys, (sum(k) - count(*))::BIGINT AS n_duplicates, count(*) FILTER (k > 1) AS n_multi,
  round(100.0 * count(*) FILTER (k > 1) / count(*), 6) AS pct_multi FROM s""")
def dup_keys(spark, sf):
    """T2 A4."""
    return _r(profiling.duplicate_keys(load_table(spark, sf, "events", "user_id"), "user_id"), "pct_multi")


@query("group_size_hist", """SELECT k AS size, count(*) AS n_keys FROM (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) GROUP BY 1 ORDER BY 1 LIMIT 10""")
def group_size_hist(spark, sf):
    """A4 T9."""
    return profiling.group_size_histogram(load_table(spark, sf, "orders", "o_custkey"), "o_custkey", first=10)


@query("id_counts", """SELECT c_nationkey, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 6) AS pct FROM customer GROUP BY 1""")
def id_counts(spark, sf):
    """A5."""
    shares = profiling.value_shares(load_table(spark, sf, "customer", "c_nationkey"), "c_nationkey")
    return _r(shares.withColumnRenamed("value", "c_nationkey").orderBy("c_nationkey"), "pct")


@query("sparse_report", f"""WITH {MARKED}, t AS (SELECT count(*) FILTER (size_text IS NULL) AS n_missing, count(size_text) AS n_present FROM cleaned)
SELECT size_text AS value, count(*) AS n, any_value(n_missing) AS n_missing, any_value(n_present) AS n_present,
  round(100.0 * any_value(n_missing) / (any_value(n_missing) + any_value(n_present)), 6) AS pct_missing
FROM cleaned, t GROUP BY 1 ORDER BY n DESC, value NULLS LAST LIMIT 20""")
def sparse_report(spark, sf):
    """A12."""
    clean = cleaning.null_markers(frames.marked_parts(spark, sf), ["?"], ["size_text"])
    return _r(profiling.sparse_report(clean, "size_text"), "pct_missing")


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min,
  max({c})::DOUBLE AS max, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50,
  round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, round(100 * stddev_samp({c}) / avg({c}), 6) AS cv_pct FROM lineitem""" for c in DESCRIBED))
def describe(spark, sf):
    """A6."""
    return _r(profiling.describe(load_table(spark, sf, "lineitem", *DESCRIBED), DESCRIBED), "mean", "std", "q25", "q50", "q75", "cv_pct")


@query("skew", " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(skewness({c}), 6) + 0.0 AS skew FROM lineitem""" for c in DESCRIBED))
def skew(spark, sf):
    """Bias-corrected."""
    return _r(profiling.skewness(load_table(spark, sf, "lineitem", *DESCRIBED), DESCRIBED), "skew")


CORRELATED = ["n_lines", "qty", "amount", "n_parts", "n_returned"]


@query("corr_matrix", f"WITH {VISITS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) + 0.0 AS corr FROM visits" for a in CORRELATED for b in CORRELATED))
def corr_matrix(spark, sf):
    """A14."""
    return _r(profiling.correlation_matrix(frames.visits(spark, sf), CORRELATED), "corr")


@query("corr_target", f"WITH {VISITS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}::DOUBLE, n_lines::DOUBLE), 6) + 0.0 AS corr FROM visits" for c in CORRELATED if c != "n_lines"))
def corr_target(spark, sf):
    """A15."""
    return _r(profiling.correlation_with(frames.visits(spark, sf), CORRELATED, "n_lines").orderBy("corr", "column"), "corr")


@query("histogram", """WITH e AS (SELECT min(l_extendedprice) lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 w FROM lineitem),
c AS (SELECT least(floor((l_extendedprice - lo) / w), 29)::INT AS bin, count(*) AS n FROM lineitem, e GROUP BY 1)
SELECT b::INT AS bin, round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high, coalesce(n, 0) AS n
FROM range(30) r(b) CROSS JOIN e LEFT JOIN c ON b = bin""")
def histogram(spark, sf):
    """A16."""
    return _r(profiling.histogram(load_table(spark, sf, "lineitem", "l_extendedprice"), "l_extendedprice", 30), "low", "high")


@query("density_histogram", f"""WITH {SCORED}, c AS (SELECT least(floor((pred - 0.5) / 1), 14)::INT AS bin, count(*) AS n FROM scored WHERE pred >= 0.5 AND pred <= 15.5 GROUP BY 1)
SELECT b::INT AS bin, 0.5 + b::DOUBLE AS low, 1.5 + b::DOUBLE AS high, coalesce(n, 0) AS n, round(coalesce(n, 0)::DOUBLE / (SELECT sum(n) FROM c), 6) AS density
FROM range(15) r(b) LEFT JOIN c ON b = bin""")
def density_histogram(spark, sf):
    """Fixed unit bins with density."""
    return _r(profiling.fixed_histogram(frames.scored_visits(spark, sf), "pred", 0.5, 1.0, 15), "density")


@query("box_stats", f"WITH {VISITS}, q AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS x FROM visits" for c in ("n_lines", "qty", "amount")) + """),
k AS (SELECT "column", quantile_cont(x, 0.25) q1, quantile_cont(x, 0.5) median, quantile_cont(x, 0.75) q3 FROM q GROUP BY 1)
SELECT k."column", round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (x NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers FROM k JOIN q ON k."column" = q."column" GROUP BY 1""")
def box_stats(spark, sf):
    """A17."""
    return _r(profiling.box_stats(frames.visits(spark, sf), ["n_lines", "qty", "amount"]), "q1", "median", "q3", "whisker_low", "whisker_high")


@query("level_pivot", f"""WITH {DAY_LEVELS}, u AS (UNPIVOT day_levels ON view, click, signup, purchase, error INTO NAME "column" VALUE lev)
SELECT "column", count(*) FILTER (lev = 'No') AS n_no, count(*) FILTER (lev = 'Steady') AS n_steady, count(*) FILTER (lev = 'Up') AS n_up,
  count(*) FILTER (lev = 'Down') AS n_down, round(100.0 * count(*) FILTER (lev <> 'No') / count(*), 6) AS pct_active FROM u GROUP BY 1""")
def level_pivot(spark, sf):
    """A9."""
    return _r(profiling.level_pivot(frames.day_levels(spark, sf), frames.EVENT_TYPES, ["No", "Steady", "Up", "Down"]), "pct_active")


@query("rate_by_domain", f"""WITH {VISITS} SELECT d.position::INT AS position, d.priority, count(visit_id) AS n,
  round(100.0 * avg(CASE WHEN visit_id IS NOT NULL THEN (readmitted = '<30')::INT END), 6) AS pct
FROM (VALUES (0,'0-NONE'),(1,'1-URGENT'),(2,'2-HIGH'),(3,'3-MEDIUM'),(4,'5-LOW')) d(position, priority) LEFT JOIN visits v ON v.priority = d.priority GROUP BY 1, 2""")
def rate_by_domain(spark, sf):
    """A13 J2."""
    domain = ["0-NONE", "1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    return _r(profiling.rate_by_domain(frames.visits(spark, sf), "priority", F.col("readmitted") == "<30", domain), "pct")
