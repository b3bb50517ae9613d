"""Union of frames whose columns differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tideline.operators.naming import column


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order; typed nulls where ``df`` has none."""
    present = set(df.columns)
    return df.select(
        *[
            (column(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name))
            for f in schema.fields
        ]
    )


def align_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, duplicates included, with the columns of ``right``.

    ``left`` gets typed nulls for what it lacks and loses what ``right`` lacks.
    """
    return align_to(left, right.schema).unionByName(right)
