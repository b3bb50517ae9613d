"""Slices of a day-partitioned catalog table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.naming import column


def day_slice(
    spark: SparkSession, table: str, days: Iterable[date], day: str = "FlightDate"
) -> DataFrame | None:
    """Rows of the given days; only their partitions are read.

    None if the table does not exist; any other failure is raised.
    """
    if not spark.catalog.tableExists(table):
        return None
    return spark.read.table(table).where(column(day).isin(sorted(days)))


def neighbouring_days(days: Iterable[date], back: int, ahead: int) -> list[date]:
    """Days up to ``back`` before or ``ahead`` after one of ``days``, without these."""
    days = set(days)
    near = {d + timedelta(days=k) for d in days for k in range(-back, ahead + 1)}
    return sorted(near - days)
