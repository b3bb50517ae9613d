"""The place -> time zone lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_zones_csv(
    spark: SparkSession, path: str, code: str = "iata_code", zone: str = "iana_tz"
) -> DataFrame:
    """Code and zone columns of a CSV file with a header, found by their names.

    Every column is read as text, so a code such as ``NA`` stays a code.
    """
    table = spark.read.option("header", True).csv(path)
    return table.select(code, zone)
