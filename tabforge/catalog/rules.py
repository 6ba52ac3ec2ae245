"""Queries over itemsets and association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.frames_sql import BASKETS, VISITS
from tabforge.catalog.registry import query
from tabforge.functions.columns import rounded
from tabforge.functions.measures import MEASURES
from tabforge.operators import rules as R
from tabforge.plans import frames

SWEEP = [0.02, 0.03, 0.05, 0.07, 0.10, 0.15, 0.20]

_LONG_FLAGS = VISITS + """,
med AS (SELECT median(n_lines) a, median(qty) b, median(amount) c, median(n_returned) d FROM visits),
flags AS (SELECT visit_id AS tid, unnest([
    'status_' || status, 'segment_' || segment, 'priority_' || priority, CASE WHEN n_lines > a THEN 'n_lines_high' END,
    CASE WHEN qty > b THEN 'qty_high' END, CASE WHEN amount > c THEN 'amount_high' END,
    CASE WHEN n_returned > d THEN 'n_returned_high' END, CASE WHEN readmitted = '<30' THEN 'early' END]) AS item FROM visits, med),
tx AS (SELECT tid, item FROM flags WHERE item IS NOT NULL)
"""


def _mine_sql(total: str, support: float, size: int) -> str:
    """WITH clauses that mine table tx(tid, item): frequent items become bits, equal baskets one row with a weight,
    and every combination of items is tested against every basket mask."""
    combos, names = ["SELECT [a.item] AS items, a.bit AS mask FROM bits a"], "abcd"
    for k in range(2, size + 1):
        joins = " ".join(f"JOIN bits {names[i]} ON {names[i]}.item > {names[i - 1]}.item" for i in range(1, k))
        combos.append(f"SELECT [{', '.join(f'{x}.item' for x in names[:k])}] AS items, {' | '.join(f'{x}.bit' for x in names[:k])} AS mask FROM bits a {joins}")
    return f"""total AS ({total}),
bits AS MATERIALIZED (SELECT item, 1::BIGINT << (row_number() OVER (ORDER BY item) - 1)::INT AS bit FROM (
  SELECT item FROM tx GROUP BY item HAVING count(*) / (SELECT t FROM total) >= {support})),
folded AS MATERIALIZED (SELECT mask, count(*) AS w FROM (SELECT tid, bit_or(bit) AS mask FROM tx JOIN bits USING (item) GROUP BY tid) GROUP BY mask),
combos AS ({' UNION ALL '.join(combos)}),
sets AS (SELECT items, sum(w)::BIGINT AS n FROM combos JOIN folded ON (folded.mask & combos.mask) = combos.mask GROUP BY items),
itemsets AS MATERIALIZED (SELECT items, len(items)::INT AS size, n, n / total.t AS support FROM sets, total WHERE n / total.t >= {support})"""


_SPLITS = """splits AS (SELECT support, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS ante,
    list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS cons
  FROM (SELECT items, support, unnest(range(1, (1 << size) - 1)) AS mask FROM itemsets WHERE size >= 2)),
measured AS (SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents, ante, cons,
    a.support AS antecedent_support, c.support AS consequent_support, s.support, s.support / a.support AS confidence,
    s.support / a.support / c.support AS lift FROM splits s JOIN itemsets a ON a.items = ante JOIN itemsets c ON c.items = cons)"""

_FLAG_TOTAL = "SELECT count(*)::DOUBLE AS t FROM visits"
FLAG_SETS = f"{_LONG_FLAGS}, {_mine_sql(_FLAG_TOTAL, 0.05, 4)}"
FLAG_RULES = f"{FLAG_SETS}, {_SPLITS}, rules AS (SELECT * FROM measured WHERE confidence >= 0.5 AND lift >= 1)"
BASKET_SETS = f"{BASKETS}, tx AS (SELECT * FROM baskets), {_mine_sql('SELECT count(DISTINCT tid)::DOUBLE AS t FROM baskets', 0.05, 4)}"


def _round(df, *names):
    return df.withColumns({n: rounded(F.col(n)) for n in names})


def _flag_itemsets(spark, sf, support=0.05, size=4):
    wide, flags = frames.visit_flags(spark, sf)
    return R.frequent_itemsets(R.baskets_from_flags(wide, flags), support, size)


def _flag_rules(spark, sf, confidence=0.5, lift=1.0):
    return R.association_rules(_flag_itemsets(spark, sf), confidence, lift)


@query("itemsets", f"WITH {BASKET_SETS} SELECT array_to_string(items, ', ') AS items, size, n, round(support, 6) AS support FROM itemsets")
def itemsets(spark, sf):
    """R1 over orders as baskets of part types."""
    found = R.frequent_itemsets(R.baskets_from_rows(frames.baskets(spark, sf)), 0.05, 4)
    return _round(found.withColumn("items", R.set_text(F.col("items"))), "support")


@query("flag_itemsets", f"WITH {FLAG_SETS} SELECT array_to_string(items, ', ') AS items, size, n, round(support, 6) AS support FROM itemsets")
def flag_itemsets(spark, sf):
    """R1 E12 E13 over a wide 0/1 table."""
    return _round(_flag_itemsets(spark, sf).withColumn("items", R.set_text(F.col("items"))), "support")


@query("itemset_summary", f"WITH {FLAG_SETS} SELECT size, count(*) AS n_itemsets FROM itemsets GROUP BY 1")
def itemset_summary(spark, sf):
    """A23 E16."""
    return R.itemset_lengths(_flag_itemsets(spark, sf))


@query("top_itemsets", f"""WITH {FLAG_SETS} SELECT array_to_string(items, ', ') AS items, size, n, round(support, 6) AS support
FROM itemsets ORDER BY itemsets.support DESC, 1 LIMIT 15""")
def top_itemsets(spark, sf):
    """T7 E15."""
    return _round(R.top_itemsets(_flag_itemsets(spark, sf), 15), "support")


@query("rules", f"WITH {FLAG_RULES} SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules")
def rules(spark, sf):
    """Any antecedent / consequent split."""
    found = R.rules_as_text(_flag_rules(spark, sf)).select("antecedents", "consequents", "support", "confidence", "lift")
    return _round(found, "support", "confidence", "lift")


@query("rule_measures", f"""WITH {BASKET_SETS}, {_SPLITS}, r AS (SELECT *, antecedent_support AS a, consequent_support AS c, support AS s FROM measured)
SELECT antecedents, consequents, round(a, 6) AS antecedent_support, round(c, 6) AS consequent_support, round(s, 6) AS support,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift, 1.0::DOUBLE AS representativity, round(s - a * c, 6) + 0.0 AS leverage,
  round((1 - c) / (1 - confidence), 6) AS conviction, round((s - a * c) / greatest(s * (1 - a), a * (c - s)), 6) + 0.0 AS zhangs_metric,
  round(s / (a + c - s), 6) AS jaccard, round((confidence - c) / (1 - c), 6) + 0.0 AS certainty, round((confidence + s / c) / 2, 6) AS kulczynski FROM r""")
def rule_measures(spark, sf):
    """All twelve measures of all rules over part types."""
    found = R.association_rules(R.frequent_itemsets(R.baskets_from_rows(frames.baskets(spark, sf)), 0.05, 4))
    return _round(R.rules_as_text(found), *MEASURES)


@query("target_rules", f"""WITH {FLAG_SETS}, {_SPLITS} SELECT antecedents, consequents, round(confidence, 6) AS confidence, round(lift, 6) AS lift
FROM measured WHERE confidence >= 0.1 AND lift >= 1 AND list_contains(cons, 'early') ORDER BY measured.lift DESC, 1, 2 LIMIT 20""")
def target_rules(spark, sf):
    """Rules that conclude the label; it covers 11 % of rows, hence confidence 0.1."""
    found = R.top_rules(R.rules_about(_flag_rules(spark, sf, 0.1), "early"), 20)
    return _round(R.rules_as_text(found).select("antecedents", "consequents", "confidence", "lift"), "confidence", "lift")


@query("target_antecedents", f"""WITH {FLAG_RULES} SELECT count(*) AS n_rules, round(max(confidence), 6) AS best FROM rules WHERE list_contains(ante, 'early')""")
def target_antecedents(spark, sf):
    """Rules that start from the label."""
    found = R.rules_about(_flag_rules(spark, sf), "early", "antecedents")
    return found.agg(F.count("*").alias("n_rules"), rounded(F.max("confidence")).alias("best"))


@query("top_rules", f"""WITH {FLAG_RULES} SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift
FROM rules ORDER BY rules.lift DESC, 1, 2 LIMIT 50""")
def top_rules(spark, sf):
    """R6 T5."""
    found = R.rules_as_text(R.top_rules(_flag_rules(spark, sf), 50)).select("antecedents", "consequents", "support", "confidence", "lift")
    return _round(found, "support", "confidence", "lift")


@query("measure_ranges", f"WITH {FLAG_RULES} " + " UNION ALL ".join(
    f"SELECT '{m}' AS measure, round(min({m}), 6) AS min, round(avg({m}), 6) AS mean, round(max({m}), 6) AS max FROM rules" for m in ("support", "confidence", "lift")))
def measure_ranges(spark, sf):
    """A24."""
    return _round(R.measure_ranges(_flag_rules(spark, sf)), "min", "mean", "max")


@query("support_sweep", f"""WITH {_LONG_FLAGS}, {_mine_sql(_FLAG_TOTAL, 0.02, 3)}, {_SPLITS},
t AS (SELECT unnest([{', '.join(f'{s}::DOUBLE' for s in SWEEP)}]) AS min_support)
SELECT min_support, (SELECT count(*) FROM itemsets WHERE support >= min_support) AS n_itemsets,
  (SELECT count(*) FROM measured WHERE confidence >= 0.5 AND support >= min_support) AS n_rules FROM t""")
def support_sweep(spark, sf):
    """Mined once at the smallest support."""
    return R.support_sweep(_flag_itemsets(spark, sf, min(SWEEP), 3), SWEEP, 0.5)


@query("lift_pivot", f"""WITH {FLAG_RULES}, top AS (SELECT * FROM rules ORDER BY lift DESC, antecedents, consequents LIMIT 30)
SELECT antecedents, round(max(lift) FILTER (consequents = 'n_lines_high'), 6) AS "n_lines_high", round(max(lift) FILTER (consequents = 'qty_high'), 6) AS "qty_high",
  round(max(lift) FILTER (consequents = 'amount_high'), 6) AS "amount_high", round(max(lift) FILTER (consequents = 'amount_high, n_lines_high'), 6) AS "amount_high, n_lines_high"
FROM top GROUP BY 1""")
def lift_pivot(spark, sf):
    """A22."""
    wide = R.lift_pivot(_flag_rules(spark, sf), ["n_lines_high", "qty_high", "amount_high", "amount_high, n_lines_high"], 30)
    return wide.select("antecedents", *[rounded(F.col(f"`{c}`")).alias(c) for c in wide.columns[1:]])
