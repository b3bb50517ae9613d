"""The operators over whole tables, and the same questions in SQL where it can ask them."""

from __future__ import annotations

import importlib.util
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import (
    bpe, chat, divergence, exact_dedup, langid, lexical, mixing, packing, quality, simhash, token_rollup,
    toxicity, url_rules,
)
from tideline.llm.shared import read
from tideline.session import new_folder


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizers keep a file."""
    return str(Path(importlib.util.find_spec("public_tokenizers").origin).parent / name)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(read(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_report(read(spark, sf_dir, "documents"), tokenizer_path())


def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(spark, read(spark, sf_dir, "conversations"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    folder = new_folder(spark, "rollup")
    return token_rollup.rollup_report(spark, docs, labels, tokenizer_path(), folder)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(read(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(spark, read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_report(read(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_rules, op2_exact_dedup, op3_bpe_round_trip, op4_chat_trees, op5_toxicity,
        op6_token_rollup, op7_simhash, op8_language, op9_packing, op10_quality_rules,
        op11_source_divergence, op12_lexical_search, op13_mixing, pipeline,
    )
}

SQL = {
    "op11_source_divergence": divergence.SQL,
    "op12_lexical_search": lexical.SQL,
    "op13_mixing": mixing.SQL,
    "op2_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM ranked""",
    "op4_chat_trees": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
shown AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
         length('<|im_start|>') + length(role) + 1 + length(text) + length('<|im_end|>') + 1
           + len(regexp_extract_all(text, '<\\*\|')) AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
       sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id""",
}
