"""Replacing whole days of a partitioned table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.naming import column, quoted
from tideline.operators.union import align_to

_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def overwrite_days(
    df: DataFrame,
    table: str,
    day: str = "FlightDate",
    output_partitions: int | None = None,
    path: str | None = None,
    spread: bool = True,
) -> None:
    """Replace the days in ``df``; all other days of the table stay.

    The first call creates the table. Columns the table lacks are added to
    it; columns the frame lacks are written as nulls. With ``spread`` rows are
    gathered by day before writing, and days too big for one file are split
    again, so neither many tiny files nor one huge task come out of it.
    """
    spark = df.sparkSession
    df = df.select(*[column(c) for c in df.columns if c != day], column(day))
    exists = spark.catalog.tableExists(table)
    if exists:
        df = align_to(df, evolved_schema(spark, table, df, day))
    if spread or output_partitions:
        sizes = [output_partitions] if output_partitions else []
        df = df.hint("rebalance", *sizes, day)
    if exists:
        with _dynamic_overwrite(spark):
            df.write.insertInto(table, overwrite=True)
    else:
        writer = df.write.format("parquet").partitionBy(day)
        (writer.option("path", path) if path else writer).saveAsTable(table)


def evolved_schema(spark: SparkSession, table: str, df: DataFrame, day: str):
    """Schema of the table once it has all columns of the frame."""
    present = spark.read.table(table)
    if present.columns[-1] != day:
        raise ValueError(f"{table} is not partitioned by {day} alone")
    new = [f for f in df.schema.fields if f.name not in present.columns]
    if new:
        added = ", ".join(
            f"{quoted(f.name)} {f.dataType.simpleString()} COMMENT '{_escaped(f)}'" for f in new
        )
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        present = spark.read.table(table)
    return present.schema


def _escaped(field) -> str:
    return field.metadata.get("comment", "").replace("\\", "\\\\").replace("'", "\\'")
