"""Checks of a loaded day, and the first row of each key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tideline.operators.naming import as_list, column


def quality_report(
    df: DataFrame,
    day: str = "FlightDate",
    time: str = "FlightTime",
    next_time: str = "FlightTime_next",
) -> DataFrame:
    """One row per day: rows, null times, null successors, first and last time."""
    return df.groupBy(column(day)).agg(
        F.count("*").alias("rows"),
        F.count_if(column(time).isNull()).alias("null_times"),
        F.count_if(column(next_time).isNull()).alias("null_next"),
        F.min(column(time)).alias("first_time"),
        F.max(column(time)).alias("last_time"),
    )


def first_per_key(
    df: DataFrame, keys: str | Iterable[str], order_by: str | Iterable[str]
) -> DataFrame:
    """The first row of each key in ascending order, nulls first.

    Written as a minimum, so each map task sends one row per key, however
    many rows a key has. Columns after ``order_by`` settle ties.
    """
    keys, order = as_list(keys), as_list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[column(c) for c in order + rest])
    firsts = df.groupBy(*[column(k) for k in keys]).agg(F.min(row).alias("_row"))
    return firsts.select(
        *[column(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )
