"""Nested JSON files to flat, typed rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tideline.operators.flatten import flatten
from tideline.operators.projection import ColumnSpec, project_typed
from tideline.sources.drift import SchemaStore


#: Columns that ``on_error="store"`` adds: the text of a record that could not be read whole, and its file.
MALFORMED, SOURCE_FILE = "_malformed", "_source_file"


def read_events_json(
    spark: SparkSession,
    path: str | list[str],
    specs: Iterable[ColumnSpec],
    schema: StructType | str | None = None,
    multiline: bool = False,
    on_error: str = "null",
    outer: bool = False,
    maps: str = "keep",
    on_duplicate: str = "error",
    source: str | None = None,
    drift: SchemaStore | None = None,
) -> DataFrame:
    """Read JSON, flatten it and keep the declared columns.

    One object per line, or whole-file JSON with ``multiline``. Give the
    nested ``schema`` for large inputs: without it Spark reads everything
    once more to infer one.

    With ``on_error="fail"`` a record that cannot be read, or a value that does not
    fit its type, stops the job. With ``"null"`` what cannot be read is null, and an
    inner flatten leaves out a record without array elements; ``malformed_lines``
    tells which lines these are. With ``"store"`` each record that cannot be read whole comes out of
    the same read as one row, with its text in ``_malformed`` and its file in ``_source_file``; of a
    file that is one JSON value (``multiline``) that is the whole file. ``source`` names a column for
    the path of each row's file.

    With ``drift`` the schema is that of the store, widened where a record does not fit it (``schema`` is then what
    the store starts with), and a declared column that no record has had yet is null.
    """
    if drift is not None:
        return _read_drifting(drift, path, list(specs), multiline, on_error, outer, maps, on_duplicate, source)
    mode = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
    reader = spark.read.option("multiLine", multiline).option("mode", mode)
    specs, whole = list(specs), None
    if on_error == "store":
        whole, source, on_error = MALFORMED, SOURCE_FILE, "null"
        reader = reader.option("columnNameOfCorruptRecord", whole)
        kind = _as_struct(schema) if schema is not None else reader.json(path).schema
        schema = StructType([f for f in kind.fields if f.name != whole] + [StructField(whole, StringType())])
        specs.append(ColumnSpec(whole, "string"))
    if schema is not None:
        reader = reader.schema(schema)
    records = reader.json(path)
    if source is not None:
        records = records.withColumn(source, F.col("_metadata.file_path"))
        specs.append(ColumnSpec(source, "string"))
    flat = flatten(records, outer=outer, maps=maps, on_duplicate=on_duplicate, whole=whole)
    return project_typed(flat, specs, on_error)


def _read_drifting(
    drift: SchemaStore, path: str | list[str], specs: list[ColumnSpec], multiline: bool, on_error: str,
    outer: bool, maps: str, on_duplicate: str, source: str | None,
) -> DataFrame:
    whole = None
    if on_error == "store":
        whole, source = MALFORMED, SOURCE_FILE
    records = drift.read(path, multiline, on_error, whole, source)
    specs += [ColumnSpec(name, "string") for name in (whole, source) if name is not None]
    flat = flatten(records, outer=outer, maps=maps, on_duplicate=on_duplicate, whole=whole)
    known = {c.lower() for c in flat.columns}
    lacking = {s.name: F.lit(None).cast("string") for s in specs if s.name.lower() not in known}
    return project_typed(flat.withColumns(lacking), specs, "null" if on_error == "store" else on_error)


def _as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def malformed_lines(
    spark: SparkSession, path: str | list[str], schema: StructType | str
) -> DataFrame:
    """Lines that are not one JSON object of ``schema``, or hold a value that does not fit it.

    One row per line, with its text in ``line`` and whether it is an object at all in
    ``readable``; of a readable one only single values are lost. Blank lines are no records.
    """
    marked = StructType([*_as_struct(schema).fields, StructField(MALFORMED, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    parsed = spark.read.text(path).select(
        F.col("value").alias("line"), F.from_json("value", marked, options).alias("record")
    )
    return parsed.where((F.trim("line") != "") & F.col("record").getField(MALFORMED).isNotNull()).select(
        "line", F.json_object_keys("line").isNotNull().alias("readable")
    )


def infer_event_schema(
    spark: SparkSession, path: str | list[str], multiline: bool = False, sampling: float = 1.0
) -> StructType:
    """Nested schema of existing files, to be kept and given to later reads."""
    reader = spark.read.option("multiLine", multiline).option("samplingRatio", sampling)
    return reader.json(path).schema
