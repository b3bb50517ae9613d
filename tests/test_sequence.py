import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tideline import next_event

T = dt.datetime


def test_two_rows(spark):
    df = spark.createDataFrame(
        [("JFK", T(2023, 12, 25, 15, 35), "American"), ("JFK", T(2023, 12, 25, 17, 35), "Iberia")],
        "Origin string, FlightTime timestamp, Reporting_Airline string",
    )
    out = next_event(df)
    assert out.dtypes[3:] == [("FlightTime_next", "timestamp"), ("Airline_next", "string"), ("diff_next", "bigint")]
    rows = out.orderBy("FlightTime").collect()
    assert tuple(rows[0][3:]) == (T(2023, 12, 25, 17, 35), "Iberia", 7200)
    assert tuple(rows[1][3:]) == (None, None, None)


def test_seconds_are_cut_before_subtracting(spark):
    df = spark.createDataFrame(
        [("A", T(2023, 1, 1, 0, 0, 0, 100000), "x"), ("A", T(2023, 1, 1, 0, 0, 1, 900000), "y")],
        "Origin string, FlightTime timestamp, Reporting_Airline string",
    )
    assert next_event(df).agg(F.max("diff_next")).first()[0] == 1


def expected(rows, skip):
    """Plain Python: (id, key, time) -> (next time, next id)."""
    out = {}
    for key in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == key]
        if skip:
            out |= {r[0]: (None, None) for r in mine if r[2] is None}
            mine = [r for r in mine if r[2] is not None]
        mine.sort(key=lambda r: (r[2] is not None, r[2] or T.min, r[0]))
        for r, n in zip(mine, [*mine[1:], (None, None, None)]):
            out[r[0]] = (n[2], n[0])
    return out


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("skip", [False, True])
@pytest.mark.parametrize("limit", [None, 10_000, 40])
def test_against_plain_python(spark, seed, skip, limit):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        key = rnd.choice(["hot", "hot", "hot", None, None, "b", "c", f"k{rnd.randrange(40)}"])
        time = None if rnd.random() < 0.2 else T(2023, 1, 1) + dt.timedelta(minutes=rnd.randrange(60))
        rows.append((i, key, time))
    df = spark.createDataFrame(rows, "id int, k string, t timestamp").repartition(3)
    out = next_event(df, "k", "t", {"id": "id_next"}, "gap", ["id"], skip, rows_per_task=limit)
    got = {r.id: (r.t_next, r.id_next) for r in out.collect()}
    assert got == expected(rows, skip)


def test_heap_of_copies_is_cut(spark):
    """All rows alike but for two: every copy is followed by a copy, the last one by the end."""
    rows = [("k", T(2023, 1, 1), "x")] * 500 + [("k", T(2023, 1, 2), "y"), ("k", T(2022, 1, 1), "w")]
    df = spark.createDataFrame(rows, "k string, t timestamp, c string")
    out = next_event(df, "k", "t", {"c": "c_next"}, "gap", rows_per_task=50)
    counts = {(r.c, r.c_next): r.n for r in out.groupBy("c", "c_next").agg(F.count("*").alias("n")).collect()}
    assert counts == {("w", "x"): 1, ("x", "x"): 499, ("x", "y"): 1, ("y", None): 1}


@pytest.mark.parametrize("skip", [False, True])
def test_heaps_beside_other_times(spark, skip):
    """Heaps of one time, with and without copies, a heap of null times, and times in between."""
    rows = [(i, "k", T(2023, 1, 1) + dt.timedelta(seconds=i)) for i in range(300)]
    rows += [(1000 + i, "k", T(2023, 1, 1, 0, 0, 7)) for i in range(400)]
    rows += [(5000, "k", T(2023, 1, 1, 0, 4, 59))] * 200 + [(3000 + i, "k", None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp").repartition(5)
    out = next_event(df, "k", "t", {"id": "id_next"}, "gap", ["id"], skip, rows_per_task=50)
    got = sorted(((r.id, r.t_next, r.id_next) for r in out.collect()), key=str)
    mine = sorted(rows, key=lambda r: (r[2] is not None, r[2] or T.min, r[0]))
    if skip:
        apart = [(r[0], None, None) for r in mine if r[2] is None]
        mine = [r for r in mine if r[2] is not None]
    else:
        apart = []
    wanted = [(r[0], n[2], n[0]) for r, n in zip(mine, [*mine[1:], (None, None, None)])]
    assert got == sorted(apart + wanted, key=str)


def test_busy_key_is_spread(spark):
    df = spark.range(2000).select((F.col("id") % 1).alias("k"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("c"))
    out = next_event(df, "k", "t", {"c": "c_next"}, "gap", rows_per_task=100)
    assert out.where("c_next = c + 1 and gap = 1").count() == 1999
    plan = out._jdf.queryExecution().executedPlan().toString()
    # 2 * 2000 / 100 ranges, each a task of its own; rows move once, the other two shuffles are for heads
    assert re.search(r"hashpartitioning\(k#\d+L?, _segment#\d+, 40\)", plan)
    assert plan.count("Exchange hashpartitioning") == 3 and "rangepartitioning" not in plan


def test_tasks_follow_the_number_of_rows(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("c"))
    out = next_event(df, "k", "t", {"c": "c_next"}, "gap", rows_per_task=100)
    assert out.where("c_next = c + 50 and gap = 50").count() == 1950
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and re.search(r"hashpartitioning\(k#\d+L?, 20\)", plan)


def test_several_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", T(2023, 1, 1, i), i) for i in range(5)] + [(1, "b", T(2023, 1, 1, 9), 9)],
        "p int, q string, t timestamp, c int",
    )
    for limit in (None, 2):
        out = next_event(df, ["p", "q"], "t", {"c": "c_next"}, "gap", rows_per_task=limit)
        assert {(r.c, r.c_next) for r in out.collect()} == {(0, 1), (1, 2), (2, 3), (3, 4), (4, None), (9, None)}


def test_day_limit(spark):
    df = spark.createDataFrame(
        [("k", dt.date(2023, 1, d), T(2023, 1, d), d) for d in (1, 2, 5)],
        "k string, d date, t timestamp, c int",
    )
    for limit, last in ((1, None), (3, 5)):
        out = next_event(df, "k", "t", {"c": "c_next"}, "gap", day="d", max_day_gap=limit)
        assert {r.c: r.c_next for r in out.collect()} == {1: 2, 2: last, 5: None}


def test_repeating_replaces(spark):
    df = spark.createDataFrame([("k", T(2023, 1, 1), "a"), ("k", T(2023, 1, 2), "b")],
                               "Origin string, FlightTime timestamp, Reporting_Airline string")
    once = next_event(df)
    twice = next_event(once)
    assert twice.columns == once.columns
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


@pytest.mark.parametrize("skip", [False, True])
def test_one_shuffle_and_one_sort(spark, skip):
    df = spark.createDataFrame([("k", T(2023, 1, 1), "a")], "Origin string, FlightTime timestamp, Reporting_Airline string")
    plan = next_event(df, skip_null_times=skip)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1
