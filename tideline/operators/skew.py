"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tideline.operators.naming import column

# Rows of one key that a single task may handle
ROWS_PER_TASK = 5_000_000


def busy_keys(
    df: DataFrame, keys: list[str], rows_per_task: int | None
) -> tuple[DataFrame | None, int]:
    """Keys with more rows than that, as ``_k0, _k1, ..., _rows``, and the number of all rows.

    None if there are no such keys; rows are not counted (0) without ``rows_per_task``.

    There are at most rows / rows_per_task of them (200,000 keys for 10**12
    rows and the default), so they may be held on the driver and broadcast.
    """
    if rows_per_task is None:
        return None, 0
    named = [column(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    total = Observation()
    counts = df.groupBy(*named).agg(F.count("*").alias("_rows"))
    counts = counts.observe(total, F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"))
    busy = counts.where(F.col("_rows") > rows_per_task)
    found = busy.collect()
    marks = df.sparkSession.createDataFrame(found, busy.schema) if found else None
    return marks, total.get["rows"]


def key_matches(keys: list[str]) -> Column:
    """Condition that the keys equal ``_k0, _k1, ...``, null being equal to null."""
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & column(k).eqNullSafe(F.col(f"_k{i}"))
    return condition
