"""Documents to packed training sequences, in five stages.

Every stage takes any further columns along, whatever their names, reads whole texts and judges each row
by itself or by all rows; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm import exact_dedup, packing, quality, simhash, toxicity
from tideline.llm.queries import tokenizer_path
from tideline.llm.shared import fresh, read
from tideline.session import new_folder


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches the threshold, one at the threshold too.

    A null text has the score of an empty one; repeated rows are judged alike.
    """
    model = toxicity.train_on_folds(docs, read(spark, sf_dir, "labels"))
    score = fresh(docs, "_score")
    return toxicity.scored(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or that the learned list drops.

    Null, empty and other texts of less than 50 words fail; repeated rows are judged alike.
    """
    return quality.drop_bad(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one with the smallest id.

    Null and blank texts are equal; of rows that agree in id and length any one stays.
    """
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id; null ids come last.

    Texts without words have fingerprint 0; of rows that agree in id and fingerprint any one stays.
    """
    return simhash.drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of a power of two ids, none padded and none of two documents.

    A null or empty text is one piece with the closing id alone; repeated rows are packed each.
    """
    return packing.packing_report(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("quality_rules", low_quality),
    ("exact_dedup", copies),
    ("simhash_near_dedup", near_copies),
    ("packing", packed),
]

#: SQL can express neither the learned models nor tokenization.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; the result of each is stored in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
