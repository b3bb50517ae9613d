"""Declared columns: name, type, comment."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tideline.operators.naming import column


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column. ``type`` is any Spark DDL type."""

    name: str
    type: str
    comment: str = ""
    format: str | None = None

    @classmethod
    def from_dict(cls, entry: Mapping[str, str]) -> ColumnSpec:
        return cls(entry["name"], entry["type"], entry.get("comment", ""), entry.get("format"))


def project_typed(df: DataFrame, specs: Iterable[ColumnSpec], on_error: str = "null") -> DataFrame:
    """Keep the declared columns only, in order, cast and commented.

    A value that does not fit its type becomes null, or stops the job with
    ``on_error="fail"``. A declared column that is missing is an error.
    """
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.select(
        *[
            _cast(column(s.name), isinstance(kinds.get(s.name), StringType), s, on_error).alias(
                s.name, metadata={"comment": s.comment}
            )
            for s in specs
        ]
    )


def _cast(value: Column, is_text: bool, spec: ColumnSpec, on_error: str) -> Column:
    # A format only says how to read text as a date or a timestamp.
    if spec.format and is_text and spec.type in ("date", "timestamp"):
        if on_error == "null":
            return F.try_to_timestamp(value, F.lit(spec.format)).cast(spec.type)
        return F.to_timestamp(value, spec.format).cast(spec.type)
    return value.try_cast(spec.type) if on_error == "null" else value.cast(spec.type)


def column_catalog(df: DataFrame, count_filled: bool = False) -> DataFrame:
    """One row per column: position, name, type, comment.

    ``count_filled`` adds ``filled``, the number of non-null values, found in
    one pass over the data.
    """
    entries = [
        (i, f.name, f.dataType.simpleString(), f.metadata.get("comment", ""))
        for i, f in enumerate(df.schema.fields)
    ]
    if not count_filled:
        return df.sparkSession.createDataFrame(
            entries, "position int, name string, type string, comment string"
        )
    counts = df.agg(*[F.count(column(name)).alias(f"n{i}") for i, name, _, _ in entries])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("name"),
            F.lit(kind).alias("type"),
            F.lit(comment).alias("comment"),
            F.col(f"n{i}").alias("filled"),
        )
        for i, name, kind, comment in entries
    ]
    return counts.select(F.inline(F.array(*rows)))
