import datetime as dt

from tideline import first_per_key, quality_report

T = dt.datetime


def test_report(spark):
    d = dt.date(2023, 1, 1)
    df = spark.createDataFrame(
        [(d, T(2023, 1, 1, 5), T(2023, 1, 1, 6)), (d, T(2023, 1, 1, 6), None), (d, None, None)],
        "FlightDate date, FlightTime timestamp, FlightTime_next timestamp",
    )
    assert [tuple(r) for r in quality_report(df).collect()] == [
        (d, 3, 1, 2, T(2023, 1, 1, 5), T(2023, 1, 1, 6))
    ]


def test_first_per_key_is_a_partial_aggregate(spark):
    df = spark.createDataFrame(
        [("x", 2, "b"), ("x", 1, "c"), ("x", 1, "a"), (None, None, "n"), (None, 0, "m"), ("y", 5, None)],
        "k string, n int, v string",
    )
    out = first_per_key(df, "k", "n")
    assert out.columns == ["k", "n", "v"]
    assert {r.k: (r.n, r.v) for r in out.collect()} == {"x": (1, "a"), None: (None, "n"), "y": (5, None)}
    assert "partial_min" in out._jdf.queryExecution().toString()
