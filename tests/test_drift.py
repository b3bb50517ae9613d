"""The schema store: the lattice of types, drift between files, what is told about it."""

import json
import random
from functools import reduce

import pytest
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, NullType, StringType, StructField, StructType,
)

from tideline import ColumnSpec, DailyLoad, LoadConfig, SchemaStore, read_events_json
from tideline.records import Conflict, Records
from tideline.sources.drift import changes, observed_type, widen


def some_type(rnd, depth=2):
    kinds = [NullType(), BooleanType(), LongType(), DoubleType(), StringType()]
    pick = rnd.randrange(7 if depth else 5)
    if pick < 5:
        return kinds[pick]
    if pick == 5:
        return ArrayType(some_type(rnd, depth - 1))
    return StructType([StructField(n, some_type(rnd, depth - 1)) for n in "abc" if rnd.random() < 0.6])


def shape(kind):
    """A type without the order of fields."""
    if isinstance(kind, StructType):
        return {f.name: shape(f.dataType) for f in kind.fields}
    return [shape(kind.elementType)] if isinstance(kind, ArrayType) else kind.simpleString()


def test_lattice():
    rnd = random.Random(3)
    for _ in range(2000):
        a, b, c = (some_type(rnd) for _ in range(3))
        both = widen(a, b)
        assert widen(a, a) == a
        assert widen(both, a) == both and widen(both, b) == both
        assert shape(both) == shape(widen(b, a))
        assert shape(widen(both, c)) == shape(widen(a, widen(b, c)))
        assert bool(changes(a, both)) == (a != both)


def test_types_that_are_told(spark):
    assert observed_type(None) == observed_type("VOID") == StructType()
    kind = observed_type("OBJECT<a: BIGINT, `OBJECT<x```: ARRAY<OBJECT<d: DECIMAL(21,1)>>, v: VARIANT, e: OBJECT<>>")
    assert shape(kind) == {"a": "bigint", "OBJECT<x`": [{"d": "double"}], "v": "string", "e": {}}


def write(folder, name, *records):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return str(path)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_values_survive_drift(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "schemas"))
    first = write(tmp_path / "in", "1.json", {"id": 1, "v": 3, "s": {"x": 1}, "n": None}, "", {"id": 2, "l": []})
    assert rows(store.read(first), "id", "v", "n") == [(1, 3, None), (2, None, None)]
    assert "l" in store.schema().names and store.read(first).schema["l"].dataType == ArrayType(StringType())
    assert len(store.records.numbers()) == 1
    second = write(tmp_path / "in", "2.json", {"id": 3, "v": 2.5, "s": "t", "l": [1]}, {"id": 4, "v": "q", "s": {"x": 9}})
    both = store.read([first, second])
    assert rows(both, "id", "v", "s") == [
        (1, "3", '{"x":1}'), (2, None, None), (3, "2.5", "t"), (4, "q", '{"x":9}'),
    ]
    told = rows(store.history().where("version = 2"), "path", "old", "new", "conflict")
    assert told == [
        ("l[]", "void", "bigint", False), ("s", "struct<x:bigint>", "string", True), ("v", "bigint", "string", True),
    ]
    # What fits is read once and changes nothing.
    store.read([second, first]).collect()
    assert store.records.numbers() == [1, 2]


def test_any_order_gives_one_schema(spark, tmp_path):
    rnd = random.Random(5)

    def value(depth=2):
        plain = [None, True, rnd.randrange(9), rnd.random(), "t"]
        pick = rnd.randrange(7 if depth else 5)
        return plain[pick] if pick < 5 else (
            [value(depth - 1) for _ in range(2)] if pick == 5 else {n: value(depth - 1) for n in "ab"}
        )

    files = [write(tmp_path / "in", f"{i}.json", *[{"k": i, "v": value(), "w": value()} for _ in range(3)]) for i in range(4)]
    shapes = []
    for run in range(3):
        store = SchemaStore(spark, str(tmp_path / f"schemas{run}"))
        for f in rnd.sample(files, len(files)):
            assert store.read(f).count() == 3
        shapes.append(shape(store.schema()))
    assert shapes[0] == shapes[1] == shapes[2]


def test_malformed_and_whole_files(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "schemas"), "a bigint")
    lines = write(tmp_path / "in", "1.json", {"a": 1}, '{"a": ', "5", '{"a": 1, "a": 2}', "null", '[{"a": 7}, 8]')
    out = store.read(lines, malformed="bad")
    assert rows(out, "a", "bad") == sorted(
        [(1, None), (7, None), (None, '{"a": '), (None, "5"), (None, '{"a": 1, "a": 2}'), (None, "null"), (None, "8")], key=repr
    )
    assert rows(store.read(lines), "a") == [(1,), (7,)]
    with pytest.raises(Exception):
        store.read(lines, on_error="fail")
    assert store.records.numbers() == []
    whole = write(tmp_path / "in", "2.json", json.dumps([{"a": 1}, {"a": 2, "b": "x"}], indent=1))
    assert rows(store.read(whole, multiline=True), "a", "b") == [(1, None), (2, "x")]


def test_nothing_to_read(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "schemas"))
    empty = write(tmp_path / "in", "1.json", "")
    assert store.read(empty).count() == 0
    assert store.read(write(tmp_path / "in", "2.json", "{}", "{}")).columns == []
    assert store.history().count() == 0 and store.schema() == StructType()


def test_case_alone_is_refused(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "schemas"))
    with pytest.raises(ValueError, match="case"):
        store.read(write(tmp_path / "in", "1.json", {"s": {"a": 1}}, {"s": {"A": 1}}))
    with pytest.raises(ValueError, match="types of JSON"):
        SchemaStore(spark, str(tmp_path / "other"), "a date")


def test_two_readers(spark, tmp_path, monkeypatch):
    """Another reader takes the number first: the files are read again and both changes stay."""
    folder = str(tmp_path / "schemas")
    store, other = SchemaStore(spark, folder, "a bigint"), SchemaStore(spark, folder, "a bigint")
    mine = write(tmp_path / "in", "1.json", {"a": 1, "b": 1})
    theirs = write(tmp_path / "in", "2.json", {"a": "t", "c": 1})
    put, calls = Records.put, []

    def late(self, number, text):
        if not calls:
            calls.append(number)
            other.read(theirs)
        return put(self, number, text)

    monkeypatch.setattr(Records, "put", late)
    assert rows(store.read(mine), "a", "b", "c") == [("1", 1, None)]
    assert shape(store.schema()) == {"a": "string", "b": "bigint", "c": "bigint"}
    assert store.records.numbers() == [1, 2]
    with pytest.raises(Conflict):
        store.records.put(2, "{}")


def test_read_flattened(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "schemas"))
    specs = [ColumnSpec("id", "int"), ColumnSpec("late", "double"), ColumnSpec("n", "bigint")]
    path = write(tmp_path / "in", "1.json", {"id": 1, "in": {"l": [{"n": 1}, {"n": 2}]}}, "x")
    out = read_events_json(spark, path, specs, drift=store, on_error="store")
    assert rows(out, "id", "late", "n", "_malformed") == [(1, None, 1, None), (1, None, 2, None), (None, None, None, "x")]


def test_load_with_drift(spark, tmp_path):
    specs = [
        ColumnSpec("Origin", "string"), ColumnSpec("FlightDate", "date", format="yyyy-MM-dd"),
        ColumnSpec("DepTime", "int"), ColumnSpec("Reporting_Airline", "string"), ColumnSpec("Extra", "double"),
    ]
    zones = spark.createDataFrame([("JFK", "America/New_York")], "iata_code string, iana_tz string")
    config = LoadConfig(
        tuple(specs), "drifting_flights", output_path=str(tmp_path / "table"), schema_folder=str(tmp_path / "schemas"),
    )
    load = DailyLoad(config, zones)
    flight = {"Origin": "JFK", "FlightDate": "2024-01-01", "DepTime": 900}
    load.run(write(tmp_path / "in", "1.json", flight | {"Reporting_Airline": 7}))
    load.run(write(tmp_path / "in", "2.json", flight | {
        "FlightDate": "2024-01-02", "DepTime": "0800", "Reporting_Airline": "UA", "Extra": 1}))
    try:
        found = spark.read.table("drifting_flights")
        assert rows(found, "Reporting_Airline", "DepTime", "Extra", "Airline_next") == [
            ("7", 900, None, "UA"), ("UA", 800, 1.0, None),
        ]
        shared = spark.conf.get("spark.checkpoint.dir")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{shared}/tideline/records-*")
        left = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
        assert load.schemas._scratch == [] and left is not None
    finally:
        spark.sql("DROP TABLE drifting_flights")


def test_widening_all_at_once(spark):
    kinds = [observed_type(t) for t in ("OBJECT<a: VOID>", "OBJECT<a: BIGINT>", "OBJECT<a: DOUBLE, b: VOID>")]
    assert shape(reduce(widen, kinds)) == {"a": "double", "b": "void"}
