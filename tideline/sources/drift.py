"""JSON files whose fields and types change over time, read against a stored schema that only widens.

Types form a lattice: no value, then whole numbers below doubles, structs by field, arrays by element, and
text above all. The schema in force is the least one that every record read so far fits.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from tideline.operators.naming import quoted
from tideline.records import Conflict, Records
from tideline.session import new_folder

_WHOLE, _STAND_IN, _NONE = "whole", "_nothing", StructType()


def widen(a: DataType, b: DataType) -> DataType:
    """The least type that values of both fit. Fields of ``a`` come first, new ones after them."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        kinds = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            kinds[f.name] = widen(kinds.get(f.name, NullType()), f.dataType)
        return StructType([StructField(name, kind) for name, kind in kinds.items()])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widen(a.elementType, b.elementType))
    if {type(a), type(b)} == {LongType, DoubleType}:
        return DoubleType()
    return StringType()


@dataclass(frozen=True)
class Change:
    """A field that is new (no old type) or got a wider type; ``conflict``: only text holds both."""

    path: str
    old: str | None
    new: str
    conflict: bool


def changes(old: DataType, new: DataType, path: str = "") -> list[Change]:
    """What widening made of the fields; an element of an array is ``[]``."""
    if old == new:
        return []
    if isinstance(old, StructType) and isinstance(new, StructType):
        before = {f.name: f.dataType for f in old.fields}
        return [
            c for f in new.fields
            for c in (
                changes(before[f.name], f.dataType, f"{path}.{f.name}".lstrip("."))
                if f.name in before
                else [Change(f"{path}.{f.name}".lstrip("."), None, f.dataType.simpleString(), False)]
            )
        ]
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return changes(old.elementType, new.elementType, f"{path}[]")
    conflict = isinstance(new, StringType) and not isinstance(old, NullType)
    return [Change(path, old.simpleString(), new.simpleString(), conflict)]


def observed_type(text: str | None) -> DataType:
    """The type that ``schema_of_variant_agg`` tells, in terms of the lattice."""
    if text is None or text == "VOID":
        return _NONE
    plain = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return _in_lattice(DataType.fromDDL(plain))


def _in_lattice(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _in_lattice(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_in_lattice(kind.elementType))
    if isinstance(kind, DecimalType):
        return DoubleType()
    return kind if isinstance(kind, (NullType, BooleanType, LongType, DoubleType)) else StringType()


def readable(kind: DataType) -> DataType | None:
    """The type to read with: text where no value was seen yet, no structs without fields."""
    if isinstance(kind, NullType):
        return StringType()
    if isinstance(kind, StructType):
        inner = [(f.name, readable(f.dataType)) for f in kind.fields]
        fields = [StructField(name, k) for name, k in inner if k is not None]
        return StructType(fields) if fields else None
    if isinstance(kind, ArrayType):
        element = readable(kind.elementType)
        return None if element is None else ArrayType(element)
    return kind


def _ddl(kind: DataType) -> str:
    if isinstance(kind, StructType):
        return f"STRUCT<{', '.join(f'{quoted(f.name)}: {_ddl(f.dataType)}' for f in kind.fields)}>"
    return f"ARRAY<{_ddl(kind.elementType)}>" if isinstance(kind, ArrayType) else kind.simpleString()


def _refuse_clashes(kind: DataType) -> None:
    if isinstance(kind, ArrayType):
        _refuse_clashes(kind.elementType)
    if isinstance(kind, StructType):
        names = sorted(f.name for f in kind.fields)
        lower = [n.lower() for n in names]
        if len(set(lower)) < len(lower):
            raise ValueError(f"fields that differ in case alone: {', '.join(n for n in names if lower.count(n.lower()) > 1)}")
        for f in kind.fields:
            _refuse_clashes(f.dataType)


class SchemaStore:
    """The schema of all records read so far, as numbered records in ``folder``.

    ``start`` is a nested schema to begin with; its types must be those JSON has (boolean, bigint, double,
    string, struct, array). Other types come with the declared columns, after the flatten.
    """

    def __init__(self, spark: SparkSession, folder: str, start: StructType | str | None = None):
        self.spark, self.records = spark, Records(spark, folder)
        self.start = StructType.fromDDL(start) if isinstance(start, str) else start or _NONE
        if _ddl(_in_lattice(self.start)) != _ddl(self.start):
            raise ValueError("a schema to start with must have the types of JSON: boolean, bigint, double, string")
        self._scratch: list[str] = []
        # Merges fields by their exact names; a session of its own, so that no other query is affected.
        self._reader = spark.newSession()
        self._reader.conf.set("spark.sql.caseSensitive", "true")

    def _last(self) -> tuple[int, StructType]:
        numbers = self.records.numbers()
        if not numbers:
            return 0, self.start
        return numbers[-1], StructType.fromJson(json.loads(self.records.read(numbers[-1]))["schema"])

    def schema(self) -> StructType:
        return self._last()[1]

    def history(self) -> DataFrame:
        """One row per changed field, in the order of changes: version, path, old, new, conflict."""
        rows = [
            (number, c["path"], c["old"], c["new"], c["conflict"])
            for number in self.records.numbers()
            for c in json.loads(self.records.read(number))["changes"]
        ]
        return self.spark.createDataFrame(rows, "version int, path string, old string, new string, conflict boolean")

    def read(
        self,
        path: str | list[str],
        multiline: bool = False,
        on_error: str = "null",
        malformed: str | None = None,
        source: str | None = None,
    ) -> DataFrame:
        """Records of files, nested, with the widened schema; they are written to the shared folder once.

        Every file is parsed once and its schema is a by-product of that write. Only if a record does not fit
        the schema in force is that widened and the same files read again, so values are never lost to
        drift: numbers that met text come as text, structs that met something else as JSON. Whole numbers of more
        than 18 digits and those in a field that also has fractions are doubles.

        A record that is no JSON object, or names a field twice, is malformed: left out, or a row with its text in
        the column ``malformed``, or with ``on_error="fail"`` the end of the job. Blank lines are no records. A file
        that holds one array of records gives its elements. ``source`` names a column for the path of the file.
        Fields that differ in upper and lower case alone are an error, as Spark cannot tell their columns apart.
        """
        lines = self._reader.read.text(path, wholetext=multiline).select(
            "value", F.col("_metadata.file_path").alias("file")
        ).where(F.trim("value") != "")
        parsed = lines.withColumn("v", F.parse_json("value") if on_error == "fail" else F.try_parse_json("value"))
        elements = F.try_variant_get("v", "$", "array<variant>")
        single = parsed.select(
            "file", F.when(elements.isNull(), F.col("value")).alias("value"),
            F.explode(F.coalesce(elements, F.array("v"))).alias("v"),
        )
        while True:
            number, known = self._last()
            # Nothing known yet: a stand-in without values, and only the schema is found.
            kind = readable(known) or StructType([StructField(_STAND_IN, StringType())])
            observation = Observation()
            typed = single.withColumn(_WHOLE, F.try_variant_get("v", "$", _ddl(kind)))
            objects = F.when(F.col(_WHOLE).isNotNull(), F.col("v"))
            watched = typed.observe(observation, F.schema_of_variant_agg(objects).alias("seen"))
            out = self._written(watched, malformed, source, on_error)
            if self._grow(number, known, observation.get["seen"]) == number:
                return out if readable(known) else out.drop(_STAND_IN)
            self._delete(self._scratch.pop())

    def _grow(self, number: int, known: StructType, seen: str | None) -> int:
        """The number of the record in force, once it covers what was ``seen``."""
        wider = widen(known, observed_type(seen))
        if wider == known:
            return number
        _refuse_clashes(wider)
        found = [vars(c) for c in changes(known, wider)]
        try:
            self.records.put(number + 1, json.dumps({"schema": wider.jsonValue(), "changes": found}))
        except Conflict:
            pass  # Another reader has widened it; the files are read again with its schema.
        return number + 1

    def _written(self, rows: DataFrame, malformed: str | None, source: str | None, on_error: str) -> DataFrame:
        names, whole = rows.schema[_WHOLE].dataType.names, F.col(_WHOLE)
        if on_error == "fail":
            whole = F.when(whole.isNull(), F.raise_error(F.concat(F.lit("no JSON object in "), "file"))).otherwise(whole)
        columns = [whole.getField(n).alias(n) for n in names]
        if malformed is not None:
            # An element of an array is told by itself.
            text = F.coalesce("value", F.to_json("v"), F.lit("null"))
            columns.append(F.when(F.col(_WHOLE).isNull(), text).alias(malformed))
        elif on_error != "fail":
            rows = rows.where(F.col(_WHOLE).isNotNull())
        if source is not None:
            columns.append(F.col("file").alias(source))
        folder = new_folder(self.spark, "records")
        self._scratch.append(folder)
        out = rows.select(*columns)
        out.write.parquet(folder)
        return self.spark.read.schema(out.schema).parquet(folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Delete the written records of all reads so far; their rows cannot be read any more."""
        while self._scratch:
            self._delete(self._scratch.pop())
