"""Corpus pipeline: documents are filtered, deduplicated, decontaminated and encoded, stage by stage.

Each stage takes all rows that the one before kept. Every stage but the last returns the columns of
``documents``; the pipeline's result has one row per surviving document with its token ids.

In every stage a null text counts as an empty one, which is scored like any other, is a near copy of
nothing, loses nothing, holds no benchmark window and has no ids. Rows with one id are one document where
documents are compared; a null id comes after all others. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import byte_bpe, decontaminate, near_dedup, quality, suffix_dedup
from tabforge.session import materialize

#: No SQL: the classifier is fitted and the tokenizer isn't expressible. Tested against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble doesn't reject; a fifth of the labels stays unseen, as in op2."""
    held_out = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(5)) == 0
    return quality.keep_good(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=held_out))


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return near_dedup.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that start in an earlier document; n_chars follows the text."""
    return suffix_dedup.strip_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of the benchmark occurs."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, intact): token ids, and whether they decode to the text."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode(docs, path, pattern, keep=["doc_id", "text"])
    intact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return byte_bpe.decode(ids, path, pattern).select("doc_id", "n_tokens", "ids", intact.alias("intact"))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", first_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
