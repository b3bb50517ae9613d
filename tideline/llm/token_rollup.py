"""Token counts as additive totals that signed changes keep up to date.

A change adds to or takes from the totals of a (source, lang, version): an insert counts plus,
a delete minus, a revised count takes the old and adds the new. A batch of changes is summed and
stored once; totals are the sums of all committed batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm.bpe import encode_documents
from tideline.llm.shared import checkpointed

KEYS = ["source", "lang", "version"]
MEASURES = ["documents", "tokens"]
SYMBOLS = "[#*$%&|<>]+"
_COMMITS = "batch string, attempt string"


def counted(docs: DataFrame, path: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, tokens) of whole texts; a null text has none."""
    ids = encode_documents(docs.select(F.struct("doc_id", "source", "lang").alias("doc_id"), "text"), path)
    return ids.select(
        "doc_id.*", F.lit(version).alias("version"), (F.length("ids") / 4).cast("bigint").alias("tokens")
    )


def counted_both(docs: DataFrame, path: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, changed, cleaned, tokens): a row for each text as it is and,
    if it has symbols (``changed``), one more for the text without them (``cleaned``)."""
    changed = F.coalesce(F.col("text").rlike(SYMBOLS), F.lit(False))
    own = F.struct(F.lit(False).alias("cleaned"), F.col("text").alias("text"))
    new = F.struct(F.lit(True).alias("cleaned"), F.regexp_replace("text", SYMBOLS, "").alias("text"))
    texts = docs.select(
        "doc_id", "source", "lang", changed.alias("changed"),
        F.inline(F.when(changed, F.array(own, new)).otherwise(F.array(own))),
    )
    keys = F.struct("doc_id", "source", "lang", "changed", "cleaned")
    ids = encode_documents(texts.select(keys.alias("doc_id"), "text"), path)
    return ids.select(
        "doc_id.*", F.lit(version).alias("version"), (F.length("ids") / 4).cast("bigint").alias("tokens")
    )


def _change(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(
        *KEYS, F.lit(sign).cast("bigint").alias("documents"), (F.lit(sign) * F.col("tokens")).cast("bigint").alias("tokens")
    )


def inserts(rows: DataFrame) -> DataFrame:
    return _change(rows, 1)


def deletes(rows: DataFrame) -> DataFrame:
    return _change(rows, -1)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    return deletes(before).unionByName(inserts(after))


class TokenRollup:
    """Totals in a folder that all executors reach.

    Each commit writes its sums to a folder of its own and then a row that names the batch and the
    folder. A folder without such a row (the writer was lost) is never read, and of several rows
    for one batch (two writers) the first by name counts, so a batch counts exactly once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        # No rows, so that the folder can be read before the first commit.
        spark.createDataFrame([], _COMMITS).write.mode("append").parquet(f"{self.folder}/commits")

    def _commits(self) -> DataFrame:
        rows = self.spark.read.schema(_COMMITS).parquet(f"{self.folder}/commits")
        return rows.groupBy("batch").agg(F.min("attempt").alias("attempt"))

    def committed(self, batch: str) -> bool:
        return not self._commits().where(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch of changes; False, and nothing happens, if it is there already."""
        if self.committed(batch):
            return False
        attempt = uuid.uuid4().hex
        # Summed before the shuffle, so a source with a third of all rows is a row per task.
        sums = changes.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        sums.write.parquet(f"{self.folder}/sums/attempt={attempt}")
        done = self.spark.createDataFrame([(batch, attempt)], _COMMITS).coalesce(1)
        done.write.mode("append").parquet(f"{self.folder}/commits")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, documents, tokens); groups without documents or tokens are gone."""
        kinds = "source string, lang string, version string, documents bigint, tokens bigint"
        commits = self._commits()
        if commits.isEmpty():
            return self.spark.createDataFrame([], kinds)
        sums = self.spark.read.schema(f"{kinds}, attempt string").parquet(f"{self.folder}/sums")
        return (
            sums.join(commits, "attempt", "left_semi").groupBy(*KEYS)
            .agg(*[F.sum(m).alias(m) for m in MEASURES])
            .where("documents <> 0 OR tokens <> 0")
        )


def rollup_report(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, path: str, folder: str, version: str = "byte_bpe_50k"
) -> DataFrame:
    """Loads all documents, takes down the toxic ones, revises those with symbols to their text
    without, and sends the takedown once more, which changes nothing.

    What a row counts with and without symbols is stored side by side in one pass, and deletes and
    inserts come from the same stored rows, so ids may be null or repeated.
    """
    counts = checkpointed(counted_both(docs, path, version))
    rollup = TokenRollup(spark, folder)
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    loaded = counts.where(~F.col("cleaned"))
    gone = loaded.join(toxic, "doc_id", "left_semi")
    revised = counts.where("changed").join(toxic, "doc_id", "left_anti")
    rollup.commit("load", inserts(loaded))
    rollup.commit("takedown", deletes(gone))
    rollup.commit("revision", revisions(revised.where(~F.col("cleaned")), revised.where("cleaned")))
    rollup.commit("takedown", deletes(gone))
    return rollup.totals()
