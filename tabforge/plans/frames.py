"""Derived frames the registered queries work on, built from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators.ordering import next_in_key
from tabforge.session import materialize
from tabforge.sources.tables import load_table


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order that has lines, with the days until the person's next order banded.

    The line items are aggregated before the join, so the join moves one row per order.
    """
    orders = load_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    nexts = next_in_key(
        orders, "o_custkey", F.to_date("o_orderdate"), ["o_orderdate", "o_orderkey"], "o_orderdate", "next_date"
    )
    lines = load_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    per_order = lines.groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("amount"),
        F.count_distinct("l_partkey").alias("n_parts"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
    )
    people = load_table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    gap = F.datediff("next_date", "o_orderdate")
    return (
        nexts.join(per_order, nexts.o_orderkey == per_order.l_orderkey)
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("visit_id"),
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("c_mktsegment").alias("segment"),
            "n_lines", "qty", "amount", "n_parts", "n_returned",
            F.when(gap.isNull(), "NO").when(gap < 30, "<30").otherwise(">30").alias("readmitted"),
        )
    )


def marked_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Part table with missing-value markers written into it, as a raw export would hold them."""
    k = F.col("p_partkey")
    return load_table(spark, sf, "part", "p_partkey", "p_brand", "p_type", "p_size").select(
        k,
        F.when(k % 7 == 0, "?").otherwise(F.col("p_brand")).alias("brand"),
        F.when(k % 11 == 0, "None").when(k % 13 == 0, "").otherwise(F.col("p_type")).alias("ptype"),
        F.when(k % 2 == 0, "?").otherwise(F.col("p_size").cast("string")).alias("size_text"),
    )


def coded_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Part keys turned into classification codes, covering prefixes, fractions, gaps and bad text."""
    k = F.col("p_partkey")
    num = (k % 1005).cast("string")
    code = (
        F.when(k % 20 == 0, F.concat(F.lit("V"), (k % 90).cast("string")))
        .when(k % 20 == 1, F.concat(F.lit("E"), (k % 900).cast("string")))
        .when(k % 20 == 2, F.lit("?"))
        .when(k % 20 == 3, F.concat(num, F.lit("d")))
        .when(k % 20 == 4, F.concat(F.lit(" "), num, F.lit(" ")))
        .when(k % 20 == 5, F.lit(None).cast("string"))
        .when(k % 20 == 6, F.lit("NaN"))
        .when(k % 2 == 1, F.concat(num, F.lit(".5")))
        .otherwise(num)
    )
    return load_table(spark, sf, "part", "p_partkey").select("p_partkey", code.alias("code"))


def day_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Per user and day one level column per event type: No / Down / Steady / Up by number of events."""
    types = ["view", "click", "signup", "purchase", "error"]
    counted = (
        load_table(spark, sf, "events", "user_id", "ts", "event_type")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(*[F.count_if(F.col("event_type") == t).alias(t) for t in types])
    )
    return counted.select(
        "user_id", F.datediff("day", F.lit("2024-01-01").cast("date")).alias("day"),
        *[
            F.when(F.col(t) == 0, "No").when(F.col(t) == 1, "Down").when(F.col(t) == 2, "Steady").otherwise("Up").alias(t)
            for t in types
        ],
    )


EVENT_TYPES = ["view", "click", "signup", "purchase", "error"]


def baskets(spark: SparkSession, sf: str) -> DataFrame:
    """(tid, item): distinct part types of each order."""
    lines = load_table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    parts = load_table(spark, sf, "part", "p_partkey", "p_type")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("tid"), F.col("p_type").alias("item")).distinct()
    )


def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer with orders: order and line activity plus balance, all double, and a rate flag."""
    per_customer = (
        visits(spark, sf).groupBy("person_id").agg(
            F.count("*").cast("double").alias("n_visits"),
            F.sum("n_lines").cast("double").alias("n_lines"),
            F.sum("qty").alias("qty"),
            F.sum("n_returned").cast("double").alias("n_returned"),
            F.max((F.col("readmitted") == "<30").cast("int")).alias("early"),
        )
    )
    people = load_table(spark, sf, "customer", "c_custkey", "c_acctbal")
    return per_customer.join(people, F.col("person_id") == F.col("c_custkey")).select(
        "person_id", "n_visits", "n_lines", "qty", "n_returned", F.col("c_acctbal").alias("balance"), "early"
    )


CUSTOMER_COLUMNS = ["n_visits", "n_lines", "qty", "n_returned", "balance"]


def scored_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Visits with a label and a fixed-formula score in place of a model's output.

    ``score`` rises slightly for the positive class and has heavy ties; ``fold`` and ``model`` variants
    are arithmetic, so any engine reproduces them.
    """
    v = F.col("visit_id")
    y = (F.col("readmitted") == "<30").cast("int")
    return visits(spark, sf).select(
        "visit_id", "person_id", "segment", "n_lines", "qty",
        (F.pmod(v, F.lit(5))).cast("int").alias("fold"),
        y.alias("y"),
        ((F.pmod(v * 7919 + 104729, F.lit(811)) + y * 60) / F.lit(871.0)).alias("score"),
        ((F.pmod(v * 6007 + 31, F.lit(97)) + y * 5) / F.lit(102.0)).alias("score_b"),
        (F.col("qty") / F.lit(25.0)).alias("pred"),
        F.pmod(v, F.lit(4)).cast("int").alias("label"),
    )


def document_features(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric features of each labelled document, from its whole text."""
    docs = load_table(spark, sf, "documents", "doc_id", "text", "lang", "n_chars")
    labels = load_table(spark, sf, "labels", "doc_id", "quality", "toxic")
    t = F.col("text")
    return docs.join(labels, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("double").alias("n_words"),
        (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("double").alias("n_lines"),
        F.length(F.regexp_replace(t, "[^0-9]", "")).cast("double").alias("n_digits"),
        (F.length(F.regexp_replace(t, "[^A-Z]", "")) / F.greatest(F.length(t), F.lit(1))).alias("upper_share"),
        *[(F.col("lang") == lang).cast("double").alias(f"lang_{lang}") for lang in DOCUMENT_LANGUAGES],
        F.lit(1.0).alias("constant"),
        "quality", "toxic",
    )


DOCUMENT_LANGUAGES = ["de", "en", "es", "fr"]
DOCUMENT_COLUMNS = ["n_chars", "n_words", "n_lines", "n_digits", "upper_share", "lang_de", "lang_en", "lang_es", "lang_fr", "constant"]


def visit_flags(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """0/1 transaction table over visits: label, one-hot columns and above-median measures."""
    from tabforge.operators import encoding

    df = materialize(visits(spark, sf), "visits")  # read by the median fit and by the projection
    cuts = encoding.fit_medians(df, ["n_lines", "qty", "amount", "n_returned"])
    hot = encoding.apply_one_hot(df, {
        "status": ["F", "O", "P"],
        "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        "priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    })
    wide = encoding.apply_above(hot, cuts).withColumn("early", encoding.equals_flag(F.col("readmitted"), "<30"))
    flags = [c for c in wide.columns if c.startswith(("status_", "segment_", "priority_")) or c.endswith("_high")] + ["early"]
    return wide.select("visit_id", *[F.col(f"`{c}`") for c in flags]), flags


def visit_features(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Encoded visits for predicting n_lines: one-hot groups, the label, and counts; leaky columns left out."""
    from tabforge.operators import encoding

    df = visits(spark, sf).withColumn("early", encoding.equals_flag(F.col("readmitted"), "<30"))
    hot = encoding.apply_one_hot(df.select("visit_id", "n_lines", "n_returned", "early", "status", "segment", "priority"), {
        "status": ["F", "O", "P"],
        "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        "priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    })
    hot = hot.withColumnsRenamed({"priority_4-NOT SPECIFIED": "priority_4-NONE"})
    return hot, [c for c in hot.columns if c not in ("visit_id", "n_lines")]
