"""Queries over reading, cleaning and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge import constants as K
from tabforge.catalog.frames_sql import CODED, CUSTOMERS, DAY_LEVELS, MARKED, VISITS
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.operators import cleaning, encoding, profiling
from tabforge.plans import frames
from tabforge.session import scratch_path
from tabforge.sources import tables

EXCLUDED_STATUS = ["P"]
INVALID_PRIORITY = "4-NOT SPECIFIED"
MARKERS = ["?", "None", ""]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]  # '5-LOW' is unlisted on purpose


def first_visit_rate_of(visits):
    surviving = cleaning.exclude_values(visits, "status", EXCLUDED_STATUS)
    surviving = cleaning.exclude_values(surviving, "priority", [INVALID_PRIORITY])
    first = cleaning.first_per_key(surviving, "person_id", ["visit_id"])
    return profiling.rate_by_group(first, "segment", F.col("readmitted") == "<30").withColumn("pct", rounded(F.col("pct")))


@query("first_visit_rate", f"""WITH {VISITS}, s AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY visit_id) AS rn
  FROM visits WHERE status <> 'P' AND priority <> '4-NOT SPECIFIED')
SELECT segment, count(*) AS n, round(100.0 * avg(CASE WHEN readmitted = '<30' THEN 1.0::DOUBLE ELSE 0 END), 6) AS pct
FROM s WHERE rn = 1 GROUP BY segment""")
def first_visit_rate(spark, sf):
    """T1 F3 F5 E4 A13."""
    return first_visit_rate_of(frames.visits(spark, sf))


@query("null_markers", f"WITH {MARKED} SELECT * FROM cleaned")
def null_markers(spark, sf):
    """F1 S2."""
    return cleaning.null_markers(frames.marked_parts(spark, sf), MARKERS)


@query("null_audit", f"""WITH {MARKED},
c AS (SELECT 'brand' AS "column", count(*) FILTER (brand IN ('?','None','')) AS n_markers_before, 0::BIGINT AS n_markers_after FROM marked
  UNION ALL SELECT 'ptype', count(*) FILTER (ptype IN ('?','None','')), 0 FROM marked
  UNION ALL SELECT 'size_text', count(*) FILTER (size_text IN ('?','None','')), 0 FROM marked),
n AS (SELECT 'brand' AS "column", count(*) FILTER (brand IS NULL) AS n_null FROM cleaned
  UNION ALL SELECT 'ptype', count(*) FILTER (ptype IS NULL) FROM cleaned
  UNION ALL SELECT 'size_text', count(*) FILTER (size_text IS NULL) FROM cleaned)
SELECT "column", n_markers_before, n_markers_after, n_null, 0::BIGINT AS n_null_filled FROM c JOIN n USING ("column")""")
def null_audit(spark, sf):
    """F2 E8 E11."""
    raw = frames.marked_parts(spark, sf)
    clean = cleaning.null_markers(raw, MARKERS)
    filled = encoding.fill_unknown(clean, ["brand", "ptype", "size_text"])
    return (
        cleaning.count_markers(raw, MARKERS).withColumnRenamed("n_markers", "n_markers_before")
        .join(cleaning.count_markers(clean, MARKERS).withColumnRenamed("n_markers", "n_markers_after"), "column")
        .join(cleaning.null_audit(clean), "column")
        .join(cleaning.null_audit(filled).withColumnRenamed("n_null", "n_null_filled"), "column")
    )


@query("near_constant", f"""WITH {DAY_LEVELS}, u AS (UNPIVOT day_levels ON view, click, signup, purchase, error INTO NAME "column" VALUE lev)
SELECT "column", round(avg(CASE WHEN lev = 'No' THEN 1.0::DOUBLE ELSE 0 END), 6) AS share,
  CAST(avg(CASE WHEN lev = 'No' THEN 1.0::DOUBLE ELSE 0 END) >= 0.6 AS INTEGER) AS dropped FROM u GROUP BY 1""")
def near_constant(spark, sf):
    """F6 F7. The threshold is 0.6 because no event type is rarer than that in a day."""
    levels = frames.day_levels(spark, sf)
    hits = cleaning.near_constant(levels, frames.EVENT_TYPES, "No", 0.6)
    kept = cleaning.drop_present(levels, [*hits, "not_there"])
    shares = cleaning.level_shares(levels, frames.EVENT_TYPES, "No")
    return shares.select("column", rounded(F.col("share")).alias("share"), (~F.col("column").isin(kept.columns)).cast("int").alias("dropped"))


def _category(c):
    return encoding.code_category(c, K.CODE_RANGES, K.CODE_FIRST, K.CODE_PREFIXES)


@query("code_categories", f"WITH {CODED} SELECT p_partkey, code, category FROM categorised")
def code_categories(spark, sf):
    """E1 J5 F10."""
    return frames.coded_parts(spark, sf).withColumn("category", _category(F.col("code")))


@query("code_distribution", f"""WITH {CODED}
SELECT category, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM coded), 6) AS pct,
  count(*) FILTER (code IS NULL) AS n_missing FROM categorised GROUP BY 1""")
def code_distribution(spark, sf):
    """A10."""
    mapped = frames.coded_parts(spark, sf).withColumn("category", _category(F.col("code")))
    shares = profiling.value_shares(mapped, "category").withColumnRenamed("value", "category")
    missing = mapped.groupBy("category").agg(F.count_if(F.col("code").isNull()).alias("n_missing"))
    return shares.join(missing, "category").withColumn("pct", rounded(F.col("pct")))


@query("lookup_labels", """SELECT c_custkey, coalesce(r_name, 'Unknown') AS region, CASE c_nationkey WHEN 1 THEN 'One' WHEN 2 THEN 'Two'
  WHEN 24 THEN 'Last' ELSE 'Unknown' END AS nation_label
FROM customer LEFT JOIN region ON c_nationkey = r_regionkey""")
def lookup_labels(spark, sf):
    """E2 J1. The region table serves as a code list that covers only some of the codes."""
    people = tables.load_table(spark, sf, "customer", "c_custkey", "c_nationkey")
    dim = tables.load_table(spark, sf, "region")
    joined = encoding.lookup(people, dim, "c_nationkey", "r_regionkey", "r_name", "region")
    return joined.select("c_custkey", "region", encoding.map_labels(F.col("c_nationkey"), {1: "One", 2: "Two", 24: "Last"}).alias("nation_label"))


@query("ordinal_encode", """SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
  WHEN '4-NOT SPECIFIED' THEN 3 ELSE -1 END AS INTEGER) AS priority_num FROM orders""")
def ordinal_encode(spark, sf):
    """E3. Null and unlisted values both give -1."""
    return tables.load_table(spark, sf, "orders", "o_orderkey", "o_orderpriority").select(
        "o_orderkey", encoding.ordinal(F.col("o_orderpriority"), PRIORITIES).alias("priority_num"))


@query("domain_counts", """SELECT position::INTEGER AS position, d.value, count(o_orderkey) AS n FROM (VALUES (0,'0-NONE'),(1,'1-URGENT'),(2,'2-HIGH'),(3,'3-MEDIUM'),
  (4,'4-NOT SPECIFIED')) d(position, value) LEFT JOIN orders ON o_orderpriority = d.value GROUP BY 1, 2""")
def domain_counts(spark, sf):
    """A11 J2."""
    return profiling.domain_counts(tables.load_table(spark, sf, "orders", "o_orderpriority"), "o_orderpriority", ["0-NONE", *PRIORITIES])


@query("level_flags", f"""WITH {DAY_LEVELS}, f AS (SELECT user_id, day, CAST(view <> 'No' AS INTEGER) AS view, CAST(click <> 'No' AS INTEGER) AS click,
  CAST(signup <> 'No' AS INTEGER) AS signup, CAST(purchase <> 'No' AS INTEGER) AS purchase, CAST(error <> 'No' AS INTEGER) AS error,
  CAST(view = 'Up' AS INTEGER) AS view_up FROM day_levels)
SELECT *, view + click + signup + purchase + error AS n_active FROM f""")
def level_flags(spark, sf):
    """E5 E6 E7."""
    levels = frames.day_levels(spark, sf)
    flags = levels.select("user_id", "day", *[encoding.level_flag(F.col(c)).alias(c) for c in frames.EVENT_TYPES],
                          encoding.equals_flag(F.col("view"), "Up").alias("view_up"))
    return flags.withColumn("n_active", encoding.active_count(frames.EVENT_TYPES))


@query("one_hot", f"""WITH {VISITS} SELECT visit_id, CAST(status = 'F' AS INTEGER) AS status_F, CAST(status = 'O' AS INTEGER) AS status_O,
  CAST(status = 'P' AS INTEGER) AS status_P, CAST(segment = 'AUTOMOBILE' AS INTEGER) AS segment_AUTOMOBILE,
  CAST(segment = 'BUILDING' AS INTEGER) AS segment_BUILDING, CAST(segment = 'FURNITURE' AS INTEGER) AS segment_FURNITURE,
  CAST(segment = 'HOUSEHOLD' AS INTEGER) AS segment_HOUSEHOLD, CAST(segment = 'MACHINERY' AS INTEGER) AS segment_MACHINERY FROM visits""")
def one_hot(spark, sf):
    """E9. The levels are fitted on the narrow source tables, not on the joined frame."""
    df = frames.visits(spark, sf).select("visit_id", "status", "segment")
    levels = encoding.fit_levels(tables.load_table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status")), ["status"])
    levels |= encoding.fit_levels(tables.load_table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment")), ["segment"])
    return encoding.apply_one_hot(df, levels)


@query("ratio_features", f"""WITH {VISITS} SELECT visit_id, n_lines + n_parts + n_returned AS total_counts,
  round(qty / greatest(n_lines, 1), 6) AS qty_per_line, round(amount / greatest(n_lines, 1), 6) AS amount_per_line,
  round(n_returned::DOUBLE / greatest(n_lines, 1), 6) AS returned_per_line FROM visits""")
def ratio_features(spark, sf):
    """E10 M23's derived ratios."""
    c = F.col
    return frames.visits(spark, sf).select(
        "visit_id", (c("n_lines") + c("n_parts") + c("n_returned")).alias("total_counts"),
        rounded(encoding.ratio(c("qty"), c("n_lines"))).alias("qty_per_line"),
        rounded(encoding.ratio(c("amount"), c("n_lines"))).alias("amount_per_line"),
        rounded(encoding.ratio(c("n_returned"), c("n_lines"))).alias("returned_per_line"))


@query("standardize", f"""WITH {CUSTOMERS}, m AS (SELECT avg(n_visits) a1, stddev_pop(n_visits) s1, avg(balance) a2, stddev_pop(balance) s2,
  avg(qty) a3, stddev_pop(qty) s3 FROM customers)
SELECT person_id, round((n_visits - a1) / s1, 6) + 0.0 AS n_visits, round((balance - a2) / s2, 6) + 0.0 AS balance,
  round((qty - a3) / s3, 6) + 0.0 AS qty, 0.0::DOUBLE AS constant FROM customers, m""")
def standardize(spark, sf):
    """E18. A constant column stays at zero."""
    df = frames.customer_features(spark, sf).select("person_id", "n_visits", "balance", "qty", F.lit(7.0).alias("constant"))
    cols = ["n_visits", "balance", "qty", "constant"]
    scaled = encoding.apply_standard(df, encoding.fit_standard(df, cols))
    return scaled.select("person_id", *[rounded(F.col(c)).alias(c) for c in cols])


@query("median_binarize", f"""WITH {VISITS}, m AS (SELECT median(n_lines) a, median(qty) b, median(amount) c FROM visits)
SELECT visit_id, CAST(n_lines > a AS INTEGER) AS n_lines_high, CAST(qty > b AS INTEGER) AS qty_high,
  CAST(amount > c AS INTEGER) AS amount_high FROM visits, m""")
def median_binarize(spark, sf):
    """E12. The cut points are exact medians."""
    df = frames.visits(spark, sf)
    cols = ["n_lines", "qty", "amount"]
    high = encoding.apply_above(df, encoding.fit_medians(df, cols))
    return high.select("visit_id", *[f"{c}_high" for c in cols])


@query("two_valued", f"""WITH {VISITS}, f AS (SELECT CAST(readmitted = '<30' AS INTEGER) AS early, status, segment,
    CASE WHEN status = 'P' THEN 5 ELSE 9 END AS five_nine, 1 AS constant FROM visits),
  c AS (SELECT count(DISTINCT early) early, count(DISTINCT status) status, count(DISTINCT segment) segment,
    count(DISTINCT five_nine) five_nine, count(DISTINCT constant) constant FROM f),
  u AS (UNPIVOT c ON early, status, segment, five_nine, constant INTO NAME "column" VALUE k)
SELECT "column", CAST(k = 2 AS INTEGER) AS kept FROM u""")
def two_valued(spark, sf):
    """E13."""
    df = frames.visits(spark, sf).select(
        encoding.equals_flag(F.col("readmitted"), "<30").alias("early"), "status", "segment",
        F.when(F.col("status") == "P", 5).otherwise(9).alias("five_nine"), F.lit(1).alias("constant"))
    kept = encoding.two_valued(df, df.columns)
    return spark.createDataFrame([(c, int(c in kept)) for c in df.columns], "column string, kept int")


@query("excluded_share", f"""WITH {VISITS} SELECT count(*) FILTER (status IN ('P')) AS n_excluded, count(*) AS n_rows,
  round(100.0 * count(*) FILTER (status IN ('P')) / count(*), 6) AS pct_excluded FROM visits""")
def excluded_share(spark, sf):
    """F4 J4."""
    return cleaning.excluded_share(frames.visits(spark, sf), "status", EXCLUDED_STATUS).withColumn("pct_excluded", rounded(F.col("pct_excluded")))


@query("relabel", f"""WITH {VISITS} SELECT CASE WHEN readmitted = '<30' THEN '<30' ELSE 'Not <30' END AS target, count(*) AS n FROM visits GROUP BY 1""")
def relabel(spark, sf):
    """E14."""
    target = F.when(F.col("readmitted") == "<30", "<30").otherwise("Not <30")
    return frames.visits(spark, sf).groupBy(target.alias("target")).agg(F.count("*").alias("n"))


@query("rounded_scores", f"""WITH {VISITS} SELECT segment, round_even(avg(n_lines), 3) AS mean3, round_even(avg(n_parts), 2) AS mean2,
  round_even(stddev_pop(n_lines), 4) AS std4 FROM visits GROUP BY 1""")
def rounded_scores(spark, sf):
    """Half-even rounding of means."""
    return frames.visits(spark, sf).groupBy("segment").agg(
        F.bround(F.avg("n_lines"), 3).alias("mean3"), F.bround(F.avg("n_parts"), 2).alias("mean2"),
        F.bround(F.stddev_pop("n_lines"), 4).alias("std4"))


@query("binary_check", f"""WITH {VISITS} SELECT visit_id, CAST(readmitted = '<30' AS INTEGER) AS early, CAST(n_returned > 0 AS INTEGER) AS n_returned,
  CAST(n_lines > 0 AS INTEGER) AS n_lines FROM visits""")
def binary_check(spark, sf):
    """0/1 columns pass, the others become > 0."""
    df = frames.visits(spark, sf).select("visit_id", encoding.equals_flag(F.col("readmitted"), "<30").alias("early"), "n_returned", "n_lines")
    return tables.as_flags(df, keep=["visit_id"])


PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("brand", T.StringType()), T.StructField("p_size", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
])


@query("sink_roundtrip", """SELECT p_partkey, p_brand AS brand, p_size, p_retailprice AS price FROM part""")
def sink_roundtrip(spark, sf):
    """Written as CSV, read back with a declared schema, rewritten as parquet, narrowed."""
    part = tables.load_table(spark, sf, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    csv, parquet = scratch_path(spark, "part-csv"), scratch_path(spark, "part-parquet")
    tables.write_csv(part.select("p_partkey", F.col("p_brand").alias("brand"), "p_size", F.col("p_retailprice").alias("price")), csv)
    tables.write_parquet(tables.read_csv(spark, csv, PART_SCHEMA), parquet)
    back = tables.require_columns(spark.read.parquet(parquet), PART_SCHEMA.names)
    return cleaning.keep_present(back, ["p_partkey", "brand", "absent", "p_size", "price"])


@query("scan_select", f"""WITH {VISITS} SELECT count(*) AS n, round(avg(n_lines), 6) AS mean, round(stddev_pop(n_lines), 6) AS std,
  min(n_lines)::DOUBLE AS min, max(n_lines)::DOUBLE AS max, median(n_lines)::DOUBLE AS median, 6::INTEGER AS n_features FROM visits""")
def scan_select(spark, sf):
    """Features are the columns without the target, its leaky family and ids."""
    df = frames.visits(spark, sf)
    leaky = {"qty", "amount", "n_parts"} & set(df.columns)
    features = [c for c in df.columns if c not in {"n_lines", "visit_id"} | leaky]
    features = cleaning.without_prefix(features, "qty")
    s = tables.target_summary(df, "n_lines")
    return s.select("n", rounded(F.col("mean")).alias("mean"), rounded(F.col("std")).alias("std"), "min", "max", "median",
                    F.lit(len(features)).alias("n_features"))


@query("target_counts", f"WITH {VISITS} SELECT n_lines::BIGINT AS value, count(*) AS n FROM visits WHERE n_lines IS NOT NULL GROUP BY 1")
def target_counts(spark, sf):
    """Value counts of the target."""
    return tables.target_counts(frames.visits(spark, sf), "n_lines")


@query("column_reference", """SELECT CAST(column_index AS INTEGER) AS position, column_name AS "column",
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END AS dtype, n_values
FROM (SELECT row_number() OVER () - 1 AS column_index, column_name, column_type AS data_type FROM (DESCRIBE SELECT * FROM part))
JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM part) ON COLUMNS(*) INTO NAME column_name VALUE n_values) USING (column_name)""")
def column_reference(spark, sf):
    """S10."""
    return tables.column_reference(tables.load_table(spark, sf, "part"))
