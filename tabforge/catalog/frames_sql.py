"""The derived frames of ``plans.frames`` in SQL, written independently of the Spark code.

Each constant is a WITH clause body; oracles open with ``WITH`` and one or more of these.
"""

VISITS = """
n AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
        date_diff('day', o_orderdate, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS gap
      FROM orders),
l AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, sum(l_extendedprice) AS amount,
        count(DISTINCT l_partkey) AS n_parts, count(*) FILTER (l_returnflag = 'R') AS n_returned
      FROM lineitem GROUP BY 1),
visits AS (SELECT o_orderkey AS visit_id, o_custkey AS person_id, o_orderstatus AS status, o_orderpriority AS priority,
        c_mktsegment AS segment, n_lines, qty, amount, n_parts, n_returned,
        CASE WHEN gap IS NULL THEN 'NO' WHEN gap < 30 THEN '<30' ELSE '>30' END AS readmitted
      FROM n JOIN l ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey)
"""

MARKED = """
marked AS (SELECT p_partkey,
        CASE WHEN p_partkey % 7 = 0 THEN '?' ELSE p_brand END AS brand,
        CASE WHEN p_partkey % 11 = 0 THEN 'None' WHEN p_partkey % 13 = 0 THEN '' ELSE p_type END AS ptype,
        CASE WHEN p_partkey % 2 = 0 THEN '?' ELSE CAST(p_size AS VARCHAR) END AS size_text
      FROM part),
cleaned AS (SELECT p_partkey, nullif(brand, '?') AS brand, nullif(nullif(ptype, 'None'), '') AS ptype,
        nullif(size_text, '?') AS size_text FROM marked)
"""

CODED = """
coded AS (SELECT p_partkey, CASE p_partkey % 20
        WHEN 0 THEN 'V' || (p_partkey % 90) WHEN 1 THEN 'E' || (p_partkey % 900) WHEN 2 THEN '?'
        WHEN 3 THEN (p_partkey % 1005) || 'd' WHEN 4 THEN ' ' || (p_partkey % 1005) || ' '
        WHEN 5 THEN NULL WHEN 6 THEN 'NaN'
        ELSE CASE WHEN p_partkey % 2 = 1 THEN (p_partkey % 1005) || '.5' ELSE CAST(p_partkey % 1005 AS VARCHAR) END
        END AS code FROM part),
numbered AS (SELECT p_partkey, code, trim(code) AS t,
        CASE WHEN regexp_full_match(trim(code), '[0-9]+([.][0-9]*)?') THEN CAST(trim(code) AS DOUBLE) END AS x FROM coded),
categorised AS (SELECT p_partkey, code, CASE
        WHEN t LIKE 'V%' THEN 'Supplementary' WHEN t LIKE 'E%' THEN 'External_Causes' WHEN x IS NULL THEN 'Unknown'
        WHEN x >= 250 AND x < 251 THEN 'Diabetes' WHEN x BETWEEN 1 AND 139 THEN 'Infectious'
        WHEN x BETWEEN 140 AND 239 THEN 'Neoplasms' WHEN x BETWEEN 240 AND 279 THEN 'Endocrine_Metabolic'
        WHEN x BETWEEN 280 AND 289 THEN 'Blood' WHEN x BETWEEN 290 AND 319 THEN 'Mental'
        WHEN x BETWEEN 320 AND 389 THEN 'Nervous_System' WHEN x BETWEEN 390 AND 459 THEN 'Circulatory'
        WHEN x BETWEEN 460 AND 519 THEN 'Respiratory' WHEN x BETWEEN 520 AND 579 THEN 'Digestive'
        WHEN x BETWEEN 580 AND 629 THEN 'Genitourinary' WHEN x BETWEEN 630 AND 679 THEN 'Pregnancy'
        WHEN x BETWEEN 680 AND 709 THEN 'Skin' WHEN x BETWEEN 710 AND 739 THEN 'Musculoskeletal'
        WHEN x BETWEEN 740 AND 759 THEN 'Congenital' WHEN x BETWEEN 760 AND 779 THEN 'Perinatal'
        WHEN x BETWEEN 780 AND 799 THEN 'Symptoms' WHEN x BETWEEN 800 AND 999 THEN 'Injury_Poisoning'
        ELSE 'Unknown' END AS category FROM numbered)
"""

DAY_LEVELS = """
day_counts AS (SELECT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
        count(*) FILTER (event_type = 'view') AS view_n, count(*) FILTER (event_type = 'click') AS click_n,
        count(*) FILTER (event_type = 'signup') AS signup_n, count(*) FILTER (event_type = 'purchase') AS purchase_n,
        count(*) FILTER (event_type = 'error') AS error_n
      FROM events GROUP BY 1, 2),
day_levels AS (SELECT user_id, CAST(day AS INTEGER) AS day, lv(view_n) AS view, lv(click_n) AS click, lv(signup_n) AS signup,
        lv(purchase_n) AS purchase, lv(error_n) AS error FROM day_counts)
"""
for _c in ("view", "click", "signup", "purchase", "error"):
    DAY_LEVELS = DAY_LEVELS.replace(
        f"lv({_c}_n)", f"CASE {_c}_n WHEN 0 THEN 'No' WHEN 1 THEN 'Down' WHEN 2 THEN 'Steady' ELSE 'Up' END"
    )

SCORED = VISITS + """,
scored AS (SELECT visit_id, person_id, segment, n_lines, qty, CAST(visit_id % 5 AS INTEGER) AS fold,
        CAST(readmitted = '<30' AS INTEGER) AS y,
        ((visit_id * 7919 + 104729) % 811 + CAST(readmitted = '<30' AS INTEGER) * 60) / 871.0::DOUBLE AS score,
        ((visit_id * 6007 + 31) % 97 + CAST(readmitted = '<30' AS INTEGER) * 5) / 102.0::DOUBLE AS score_b,
        qty / 25.0::DOUBLE AS pred, CAST(visit_id % 4 AS INTEGER) AS label FROM visits)
"""

CUSTOMERS = VISITS + """,
customers AS (SELECT person_id, n_visits, n_lines, qty, n_returned, c_acctbal AS balance, early FROM (
        SELECT person_id, CAST(count(*) AS DOUBLE) AS n_visits, CAST(sum(n_lines) AS DOUBLE) AS n_lines, sum(qty) AS qty,
          CAST(sum(n_returned) AS DOUBLE) AS n_returned, CAST(max(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END) AS INTEGER) AS early
        FROM visits GROUP BY 1) JOIN customer ON person_id = c_custkey)
"""

DOCUMENTS = """
feats AS (SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
        CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) AS n_words,
        CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
        CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits,
        CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS upper_share,
        CAST(lang = 'de' AS DOUBLE) AS lang_de, CAST(lang = 'en' AS DOUBLE) AS lang_en,
        CAST(lang = 'es' AS DOUBLE) AS lang_es, CAST(lang = 'fr' AS DOUBLE) AS lang_fr, 1.0::DOUBLE AS constant,
        quality, toxic FROM documents d JOIN labels b ON d.doc_id = b.doc_id)
"""

BASKETS = """
baskets AS (SELECT DISTINCT l_orderkey AS tid, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
