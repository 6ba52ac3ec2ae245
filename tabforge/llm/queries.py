"""The registered query of each operator: whole tables in, the contract's columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import byte_bpe, conversation_repair, decontaminate, hard_negatives, line_dedup, main_text, near_dedup, neighbours, quality, suffix_dedup, suffix_tree_lm, token_records, window_dedup
from tabforge.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = byte_bpe.decode(byte_bpe.encode(table(spark, sf, "documents"), path, pattern), path, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


OP5_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS i
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[k : k + least(len(ws), 10) - 1], ' ') AS window_text
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS k FROM items WHERE len(ws) > 0)),
doc_windows AS (SIZES),
hits AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, window_text)),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM hits),
counts AS (SELECT doc_id, count(*) AS n_words FROM doc_words GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, array_to_string(list(item_id ORDER BY item_id), ',') AS names FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id) USING (doc_id) LEFT JOIN found USING (doc_id)
""".replace("SIZES", " UNION ALL ".join(
    f"""SELECT doc_id, i, {k} AS size, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING) AS window_text
  FROM doc_words WHERE EXISTS (SELECT 1 FROM item_windows WHERE size = {k}) QUALIFY i + {k} <= n""" for k in range(1, 11)))


@query("op5_decontaminate", OP5_SQL)
def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document that benchmark windows of ten words cover, and the items they come from."""
    found = decontaminate.find_matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    items = F.array_sort(F.transform("matches", lambda m: m["item_id"]))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("matches").cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op3_token_records")
def op3_token_records(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document, written to record files in order of the id and read back."""
    path = scratch_path(spark, "token-records")
    token_records.write_records(table(spark, sf, "documents"), f"{path}/records", public_tokenizers.path("word_bpe_49k.json"), special=True)
    token_records.write_index(spark, f"{path}/records", f"{path}/index")
    records = token_records.read_records(spark, f"{path}/records").select("shard", "row", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    found = token_records.with_starts(records, spark.read.parquet(f"{path}/index"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def remainder(column: str, modulus: int):
    """crc32 of an id's text, modulo; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document by a rule ensemble learned from four fifths of the labels."""
    docs = table(spark, sf, "documents")
    model = quality.learn(docs, table(spark, sf, "labels"), held_out=remainder("_id", 5) == 0)
    scored = quality.score_documents(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op7_main_text")
def op7_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page, its site's template and marked furniture removed."""
    return main_text.extract(table(spark, sf, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that start in an earlier one."""
    kept = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH words AS (
  SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
windows AS (
  SELECT *, CASE WHEN i + 50 <= n THEN md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS h FROM words),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows WHERE h IS NOT NULL GROUP BY h),
starts AS (SELECT windows.*, coalesce(first_id < doc_id, false) AS repeats FROM windows LEFT JOIN firsts USING (h)),
flags AS (SELECT *, bool_or(repeats) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM starts)
SELECT d.doc_id, count(word) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN flags USING (doc_id) GROUP BY d.doc_id
"""


@query("op6_window_dedup", OP6_SQL)
def op6_window_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the 50-word windows that start in an earlier one."""
    kept = window_dedup.remove_repeats(table(spark, sf, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    return neighbours.search(table(spark, sf, "embeddings"), F.pmod(F.col("id"), F.lit(20)) == 0)


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
places AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM words),
shingles AS (
  SELECT DISTINCT doc_id, md5(s) AS h FROM (
    SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM places) WHERE i + 5 <= n OR (n < 5 AND i = 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT DISTINCT a, a FROM arcs UNION SELECT r.doc_id, arcs.b FROM reach r JOIN arcs ON r.other = arcs.a),
roots AS (SELECT doc_id, min(other) AS root FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, w.doc_id) AS component_id, coalesce(root, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)
"""


@query("op9_near_dedup", OP9_SQL)
def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Component of every document under 75 % similarity of five-word shingles."""
    found = near_dedup.near_duplicates(table(spark, sf, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query("op10_suffix_tree_lm")
def op10_suffix_tree_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Unigram and suffix-tree log10 probability of every document, learned from nine tenths of them."""
    scored = suffix_tree_lm.score_documents(table(spark, sf, "documents"), remainder("doc_id", 10) == 0)
    return scored.withColumnRenamed("id", "doc_id").withColumn("held_out", F.coalesce("held_out", F.lit(False)))


OP11_SQL = r"""
WITH lines AS (
  SELECT r, doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
common AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -1)) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c ON lines.key = c.key GROUP BY r
"""


@query("op11_line_dedup", OP11_SQL)
def op11_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the lines that ten documents or more share."""
    kept = line_dedup.remove_common_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = """
WITH numbers AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM numbers a JOIN numbers b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Three hard negatives for each of the five best positives of every fiftieth vector."""
    rows = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("id") % 50 == 0)


OP12_SQL = r"""
WITH RECURSIVE crc_steps AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_steps WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE step = 8),
cases AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT)) % 20 AS fate
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM cases WHERE fate <> 0),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged),
faulty AS (
  SELECT *, substr(role, 1, 1) AS c, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM seen),
stats AS (
  SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
moves(p, role, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
gaps_closed(p, q, cost, marks) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 3, 3, 'I'), (3, 2, 3, 'I')),
edits AS (
  SELECT conv_id, n, p, p AS q, 4 AS cost, 'D' AS edit, NULL::VARCHAR AS line FROM faulty, (SELECT unnest(range(4)) AS p)
  UNION ALL SELECT conv_id, n, p, q, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', faulty.role || ':' || text FROM faulty JOIN moves ON c = moves.role WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, n, p, q, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', CASE q WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || text
  FROM faulty, moves WHERE moves.role <> 's' AND fault NOT IN ('blank', 'duplicate')),
-- One step a row: insertions, then an edit; the least (cost, audit) of each state goes on.
steps AS (
  SELECT g.p, e.conv_id, e.n, e.q, g.cost + e.cost AS cost, g.marks || e.edit AS marks,
         CASE len(g.marks) WHEN 0 THEN [] WHEN 1 THEN [CASE g.q WHEN 2 THEN 'user:' ELSE 'assistant:' END] ELSE ['user:', 'assistant:'] END || CASE WHEN e.line IS NULL THEN [] ELSE [e.line] END AS lines
  FROM gaps_closed g JOIN edits e ON g.q = e.p),
walk AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM stats
  UNION ALL
  SELECT conv_id, n, q, cost, audit, lines FROM (
    SELECT w.conv_id, s.n, s.q, w.cost + s.cost AS cost, w.audit || s.marks AS audit, w.lines || s.lines AS lines
    FROM walk w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.n = w.n + 1 AND s.p = w.q)
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
ends AS (
  SELECT w.conv_id, w.cost + g.cost AS cost, w.audit || g.marks AS audit,
         w.lines || CASE len(g.marks) WHEN 0 THEN [] WHEN 1 THEN ['assistant:'] ELSE ['user:', 'assistant:'] END AS lines
  FROM walk w JOIN stats s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.n = s.n_rows JOIN gaps_closed g ON g.p = w.q AND g.q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + g.cost, w.audit || g.marks) = 1)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN stats ON ids.conv_id IS NOT DISTINCT FROM stats.conv_id LEFT JOIN ends ON ids.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


@query("op12_conversation_repair", OP12_SQL)
def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    rows = table(spark, sf, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(rows))
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
