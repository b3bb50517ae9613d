import datetime as dt

import pytest
from pyspark.sql import functions as F

from tideline import attach_zone, local_clock, local_time_fit, local_to_utc, read_zones_csv, to_utc, zone_lookup

DAY = "date'2023-12-25'"


def text(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("hhmm, expected", [
    (5, "2023-12-25 00:05:00"), (45, "2023-12-25 00:45:00"), (734, "2023-12-25 07:34:00"),
    (0, "2023-12-25 00:00:00"), (2359, "2023-12-25 23:59:00"), (None, None), (2400, None),
    (1275, None), (-5, None), (-1200, None), (12345, None), (99999, None),
])
def test_clock(spark, hhmm, expected):
    df = spark.createDataFrame([(hhmm,)], "t int").select(
        local_clock(F.expr(DAY), F.col("t")).cast("string")
    )
    assert text(df) == [expected]


def test_clock_2400(spark):
    df = spark.createDataFrame([(2400,)], "t int").select(
        local_clock(F.expr(DAY), F.col("t"), roll_2400=True).cast("string")
    )
    assert text(df) == ["2023-12-26 00:00:00"]


def test_null_day(spark):
    df = spark.createDataFrame([(None, 5)], "d date, t int")
    assert text(df.select(local_clock(F.col("d"), F.col("t")))) == [None]


def zones(spark, *rows):
    return spark.createDataFrame(rows or [("JFK", "America/New_York")], "iata_code string, iana_tz string")


def test_winter_in_new_york(spark):
    df = spark.createDataFrame([("JFK", "2023-12-25", 1535), ("XXX", "2023-12-25", 1535)],
                               "Origin string, FlightDate string, DepTime long")
    out = local_to_utc(df, zones(spark))
    assert out.dtypes[-1] == ("FlightTime", "timestamp")
    assert out.columns == ["Origin", "FlightDate", "DepTime", "FlightTime"]
    got = {r[0]: r[1] for r in out.select("Origin", F.col("FlightTime").cast("string")).collect()}
    assert got == {"JFK": "2023-12-25 20:35:00", "XXX": None}


@pytest.mark.parametrize("local, expected", [
    ("2023-03-12 02:30:00", "2023-03-12 07:30:00"),  # no such local time
    ("2023-11-05 01:30:00", "2023-11-05 05:30:00"),  # twice: the earlier one
    ("2023-07-01 12:00:00", "2023-07-01 16:00:00"),
])
def test_daylight_saving(spark, local, expected):
    df = spark.createDataFrame([(local,)], "t string").select(
        to_utc(F.col("t").cast("timestamp"), F.lit("America/New_York")).cast("string")
    )
    assert text(df) == [expected]


def test_unknown_zone_fails(spark):
    df = spark.createDataFrame([("A", dt.date(2023, 1, 1), 5)], "Origin string, FlightDate date, DepTime int")
    with pytest.raises(Exception):
        local_to_utc(df, zones(spark, ("A", "Nowhere/None"))).collect()


def test_other_session_zone_is_refused(spark):
    df = spark.createDataFrame([("A", dt.date(2023, 1, 1), 5)], "Origin string, FlightDate date, DepTime int")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            local_to_utc(df, zones(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("limit", [100, 1])
def test_lookup_keeps_every_row_once(spark, limit):
    df = spark.createDataFrame(
        [("A", 1), ("A", 1), ("B", 2), (None, 3), ("C", 4), ("iata_code", 5)], "Origin string, n int"
    )
    lookup = zones(spark, ("A", "Z/2"), ("A", "Z/1"), ("B", "Z/3"), (None, "Z/4"), ("D", "Z/5"))
    out = attach_zone(df, lookup, "Origin", broadcast_rows=limit)
    got = sorted((r.n, r.zone) for r in out.collect())
    assert [g for g in got if g[0] < 3] == [(1, "Z/1"), (1, "Z/1"), (2, "Z/3")]
    assert [g for g in got if g[0] >= 3] == [(3, None), (4, None), (5, None)]


def test_join_strategy_follows_the_size(spark):
    df, lookup = spark.createDataFrame([("A", 1)], "Origin string, n int"), zones(spark, ("A", "x"), ("B", "y"))
    small = attach_zone(df, lookup, "Origin")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in small


def test_na_is_a_code(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("city,iata_code,iana_tz\nA,NA,Africa/Windhoek\nB,JFK,America/New_York\n")
    got = read_zones_csv(spark, str(path)).collect()
    assert sorted(tuple(r) for r in got) == [("JFK", "America/New_York"), ("NA", "Africa/Windhoek")]


@pytest.mark.parametrize("clock, delay, expected", [
    (15, 25, "2023-12-26 05:15:00"),    # 23:50, 25 minutes late
    (1535, 5, "2023-12-25 20:35:00"),
    (2355, -10, "2023-12-25 04:55:00"),  # 00:05, ten minutes early: the day before
    (1535, None, "2023-12-25 20:35:00"),
    (100, 1500, "2023-12-26 06:00:00"),  # 00:00, 25 hours late
])
def test_departure_after_midnight(spark, clock, delay, expected):
    df = spark.createDataFrame([("JFK", dt.date(2023, 12, 25), clock, delay)],
                               "Origin string, FlightDate date, DepTime int, DepDelay int")
    out = local_to_utc(df, zones(spark), delay="DepDelay").select(F.col("FlightTime").cast("string"))
    assert text(out) == [expected]


def test_busy_place_is_cut_when_the_lookup_is_large(spark, tmp_path):
    """A third in one place, a third nowhere: one scan, one shuffle of each side."""
    place = F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 3 == 1, F.concat(F.lit("p"), F.col("id") % 7))
    spark.range(3000).select(place.alias("Origin"), (F.col("id") % 2).alias("n")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    lookup = zones(spark, ("A", "Z/1"), ("p1", "Z/2"), ("p2", "Z/3"))
    counts = {}
    for limit in (None, 500):
        out = attach_zone(rows, lookup, "Origin", broadcast_rows=0, rows_per_task=limit)
        counts[limit] = {tuple(r[:3]): r[3] for r in out.groupBy("Origin", "n", "zone").count().collect()}
    small = attach_zone(rows, lookup, "Origin").groupBy("Origin", "n", "zone").count().collect()
    assert counts[None] == counts[500] == {tuple(r[:3]): r[3] for r in small}
    assert sum(v for k, v in counts[500].items() if k[2] == "Z/1") == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 1 and plan.count("SortMergeJoin") == 1
    assert plan.count("hashpartitioning(Origin") == 1


def test_small_means_rows_and_bytes(spark, monkeypatch):
    lookup = zones(spark, ("A", "Z/1"), ("B", "Z/2"))
    assert zone_lookup(lookup).small
    assert not zone_lookup(lookup, broadcast_rows=1).small
    monkeypatch.setattr("tideline.operators.localtime.BROADCAST_BYTES", 5)
    assert not zone_lookup(lookup).small


def test_events_are_not_shuffled_for_a_small_lookup(spark):
    df = spark.createDataFrame([("A", dt.date(2023, 1, 1), 5)], "Origin string, FlightDate date, DepTime int")
    plan = local_to_utc(df, zones(spark))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(Origin" not in plan and plan.count("BroadcastHashJoin") == 1


def test_long_clocks_are_cut_on_demand(spark):
    df = spark.createDataFrame([(12345,), (99999,), (734,)], "t int")
    cut = local_clock(F.lit("2023-12-25").cast("date"), F.col("t"), cut_long=True).cast("string")
    assert [r[0] for r in df.select(cut).collect()] == ["2023-12-25 12:34:00", None, "2023-12-25 07:34:00"]


@pytest.mark.parametrize("local, fit, earlier, later", [
    ("2023-11-05 01:30:00", "doubled", "2023-11-05 05:30:00", "2023-11-05 06:30:00"),
    ("2023-11-05 00:59:59", "unique", "2023-11-05 04:59:59", "2023-11-05 04:59:59"),
    ("2023-11-05 02:00:00", "unique", "2023-11-05 07:00:00", "2023-11-05 07:00:00"),
    ("2023-03-12 02:30:00", "skipped", "2023-03-12 07:30:00", "2023-03-12 07:30:00"),
    ("2023-03-12 01:59:00", "unique", "2023-03-12 06:59:00", "2023-03-12 06:59:00"),
    ("2023-03-12 03:00:00", "unique", "2023-03-12 07:00:00", "2023-03-12 07:00:00"),
    ("2023-03-13 02:30:00", "unique", "2023-03-13 06:30:00", "2023-03-13 06:30:00"),
    ("2023-11-06 01:30:00", "unique", "2023-11-06 06:30:00", "2023-11-06 06:30:00"),
    ("2023-11-04 01:30:00", "unique", "2023-11-04 05:30:00", "2023-11-04 05:30:00"),
])
def test_local_times_that_occur_twice_or_never(spark, local, fit, earlier, later):
    zone, t = F.lit("America/New_York"), F.lit(local).cast("timestamp")
    kinds = [("earlier", "forward"), ("later", "forward"), ("null", "null")]
    row = spark.range(1).select(
        local_time_fit(t, zone), *[to_utc(t, zone, d, s).cast("string") for d, s in kinds]
    ).first()
    assert tuple(row) == (fit, earlier, later, earlier if fit == "unique" else None)


def test_policies_reach_the_enrichment(spark):
    df = spark.createDataFrame(
        [("JFK", dt.date(2023, 11, 5), 130), ("JFK", dt.date(2023, 3, 12), 230), ("X", dt.date(2023, 3, 12), 230)],
        "Origin string, FlightDate date, DepTime int")
    out = local_to_utc(df, zones(spark), doubled="later", skipped="null", mark="fit")
    assert out.columns[-2:] == ["fit", "FlightTime"]
    got = [(r.fit, str(r.FlightTime)) for r in out.collect()]
    assert got == [("doubled", "2023-11-05 06:30:00"), ("skipped", "None"), (None, "None")]
    with pytest.raises(ValueError, match="doubled"):
        local_to_utc(df, zones(spark), doubled="both")


def test_rows_are_not_sorted_before_a_large_lookup(spark):
    """An order that the join does not keep costs nothing where no place is cut."""
    rows = spark.range(50).select(F.concat(F.lit("p"), F.col("id") % 3).alias("Origin"), "id").union(spark.sql("SELECT NULL, 50L"))
    out = attach_zone(rows.orderBy(F.desc("id")), zones(spark, ("p1", "Z/2")), "Origin", broadcast_rows=0)
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.id, r.zone) for r in out.collect()} == {(i, "Z/2" if i % 3 == 1 and i < 50 else None) for i in range(51)}
