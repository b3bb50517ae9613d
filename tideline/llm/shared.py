"""Small helpers the operators share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.session import new_folder, shared_folder

#: A group counts as hot from this share of all rows on, or from so many rows, whichever is less. So a
#: task gets at most HOT_ROWS rows of a group, and at most max(1 / HOT_SHARE, rows / HOT_ROWS) groups are hot.
HOT_SHARE, HOT_ROWS = 0.001, 1_000_000

#: Texts in an Arrow batch.
BATCH_ROWS = 200

#: Java regular expression for one run of the white space that separates words.
BLANKS = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; workers are told where this package is, for sessions that did not ship it."""
    spark.sparkContext.environment.setdefault(
        "PYTHONPATH", str(Path(__file__).resolve().parents[2])
    )
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python a few at a time, so that a batch of long ones fits in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, stored in the folder that ``spark.checkpoint.dir`` names."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    For loops: a checkpoint keeps what is known of its columns, which grows with each round until
    planning takes longer than the work.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_number(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def attach(
    rows: DataFrame, groups: DataFrame, key: str, size: str, spread: list[str]
) -> DataFrame:
    """Left-join ``groups`` (one stored row per key with its ``size`` in ``rows``) to ``rows``.

    Hot groups are broadcast: each holds at least ``HOT_SHARE`` of all rows or ``HOT_ROWS``, so
    there are few (one row for a million at most). The rest is a shuffled join without hot
    keys; rows of hot groups are dealt by ``spread`` and meet nothing there.
    """
    values = [c for c in groups.columns if c != key]
    total = groups.agg(F.sum(size)).first()[0] or 0
    packed, found, salt = (fresh(rows, n) for n in ("_hot", "_cold", "_salt"))
    whole = groups.select(key, F.struct(*values).alias(packed), F.col(size).alias(salt))
    is_hot = F.col(salt) >= max(2.0, min(total * HOT_SHARE, HOT_ROWS))
    hot = F.broadcast(whole.where(is_hot).drop(salt))
    cold = whole.where(~is_hot).select(
        key, F.lit(0).alias(salt), F.col(packed).alias(found)
    )
    dealt = F.pmod(F.xxhash64(*spread), F.lit(4096)).cast("int") + 1
    out = (
        rows.join(hot, key, "left")
        .withColumn(salt, F.when(F.col(packed).isNull(), 0).otherwise(dealt))
        .join(cold, [key, salt], "left")
    )
    merged = F.coalesce(F.col(packed), F.col(found))
    return out.select(*rows.columns, *[merged[v].alias(v) for v in values])


def repeated_ids(docs: DataFrame, doc_id: str) -> DataFrame | None:
    """Ids that several rows share, null included, in a column ``_id``; None if there is none."""
    again = docs.groupBy(F.col(doc_id).alias("_id")).count().where("count > 1").select("_id")
    again = checkpointed(again)
    return None if again.isEmpty() else again


def one_of_repeated(kept: DataFrame, docs: DataFrame, doc_id: str, by: list[str]) -> DataFrame:
    """``kept`` with any one of the rows that agree in ``doc_id`` and ``by``.

    Only rows whose id occurs more than once in ``docs`` are compared.
    """
    again = repeated_ids(docs, doc_id)
    if again is None:
        return kept
    same = F.col(doc_id).eqNullSafe(F.col("_id"))
    one = kept.join(again, same, "left_semi").dropDuplicates([doc_id, *by])
    return kept.join(again, same, "left_anti").unionByName(one)
