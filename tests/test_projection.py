import datetime as dt
import json

import pytest

from tideline import ColumnSpec, column_catalog, malformed_lines, project_typed, read_events_json

SPECS = [ColumnSpec("line", "int", "bus line"), ColumnSpec("stop", "string"), ColumnSpec("clock", "int")]
SCHEMA = "line long, stops array<struct<stop:string, clock:int>>"


def test_order_types_comments(spark):
    df = spark.createDataFrame([(1.9, "x", 1, 0.0)], "b double, a string, c long, d double")
    out = project_typed(df, [ColumnSpec("a", "string", "text"), ColumnSpec("b", "int"),
                             ColumnSpec("c", "boolean"), ColumnSpec("d", "boolean")])
    assert out.dtypes == [("a", "string"), ("b", "int"), ("c", "boolean"), ("d", "boolean")]
    assert out.first() == ("x", 1, True, False)
    assert out.schema["a"].metadata == {"comment": "text"}
    assert out.schema["b"].metadata == {"comment": ""}


def test_bad_values(spark):
    df = spark.createDataFrame([("x", "20230101", "99999999999")], "b string, d string, n string")
    specs = [ColumnSpec("b", "boolean"), ColumnSpec("d", "date"), ColumnSpec("n", "int")]
    assert project_typed(df, specs).first() == (None, None, None)
    for spec in specs:
        with pytest.raises(Exception, match="CAST"):
            project_typed(df, [spec], on_error="fail").collect()


def test_format_is_honoured(spark):
    df = spark.createDataFrame([("31/01/2023", "2023-01-31")], "d string, e string")
    specs = [ColumnSpec("d", "date", format="dd/MM/yyyy"), ColumnSpec("e", "date", format="yyyy-MM-dd")]
    day = dt.date(2023, 1, 31)
    assert project_typed(df, specs).first() == (day, day)
    assert project_typed(df, specs, on_error="fail").first() == (day, day)


def test_missing_column_is_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        project_typed(spark.range(1), [ColumnSpec("nope", "int")])


def test_any_ddl_type(spark):
    df = spark.createDataFrame([("1.25", "2023-01-01 10:00:00")], "a string, b string")
    out = project_typed(df, [ColumnSpec("a", "decimal(5,2)"), ColumnSpec("b", "timestamp")])
    assert out.dtypes == [("a", "decimal(5,2)"), ("b", "timestamp")]


def test_catalog(spark):
    df = project_typed(
        spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string"),
        [ColumnSpec("a", "int", "it's a"), ColumnSpec("b", "string")],
    )
    assert [tuple(r) for r in column_catalog(df).collect()] == [
        (0, "a", "int", "it's a"), (1, "b", "string", "")
    ]
    assert [tuple(r) for r in column_catalog(df, count_filled=True).orderBy("position").collect()] == [
        (0, "a", "int", "it's a", 2), (1, "b", "string", "", 1)
    ]


def test_comments_reach_the_catalog(spark):
    df = project_typed(spark.range(1), [ColumnSpec("id", "int", "the id")])
    df.write.mode("overwrite").saveAsTable("commented")
    assert spark.table("commented").schema["id"].metadata["comment"] == "the id"
    spark.sql("DROP TABLE commented")


BUS = {"line": 12, "stops": [{"stop": "Mill", "clock": 805}, {"stop": "Pier", "clock": 2359}]}


@pytest.mark.parametrize("schema", [None, SCHEMA])
@pytest.mark.parametrize("on_error", ["null", "fail"])
def test_read_nested_lines(spark, tmp_path, schema, on_error):
    (tmp_path / "bus.json").write_text(json.dumps(BUS))
    out = read_events_json(spark, str(tmp_path), SPECS, schema=schema, on_error=on_error)
    assert out.dtypes == [("line", "int"), ("stop", "string"), ("clock", "int")]
    assert [tuple(r) for r in out.collect()] == [(12, "Mill", 805), (12, "Pier", 2359)]


def test_read_pretty_printed_array(spark, tmp_path):
    buses = [BUS | {"line": k, "stops": BUS["stops"][:1]} for k in range(3)]
    (tmp_path / "bus.json").write_text(json.dumps(buses, indent=1))
    out = read_events_json(spark, str(tmp_path), SPECS, multiline=True)
    assert sorted(r["line"] for r in out.collect()) == [0, 1, 2]


def test_malformed_lines_are_told(spark, tmp_path):
    whole = json.dumps(BUS)
    odd = whole.replace("805", '"8:05"')
    (tmp_path / "bus.json").write_text("\n".join([whole, whole[:-2], "", odd, "[1]x"]))
    out = read_events_json(spark, str(tmp_path), SPECS, schema=SCHEMA)
    mill, pier = (12, "Mill", 805), (12, "Pier", 2359)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([mill, pier, (12, "Mill", None), pier], key=str)
    told = {tuple(r) for r in malformed_lines(spark, str(tmp_path), SCHEMA).collect()}
    assert told == {(whole[:-2], False), (odd, True), ("[1]x", False)}


@pytest.mark.parametrize("schema", [None, SCHEMA])
@pytest.mark.parametrize("bad", ["cut", "clock"])
def test_fail_stops_on_bad_lines(spark, tmp_path, schema, bad):
    whole = json.dumps(BUS)
    line = whole[:-2] if bad == "cut" else whole.replace("805", '"8:05"')
    (tmp_path / "bus.json").write_text(f"{whole}\n{line}")
    with pytest.raises(Exception, match="MALFORMED|CAST|FAILFAST|malformed"):
        read_events_json(spark, str(tmp_path), SPECS, schema=schema, on_error="fail").collect()
