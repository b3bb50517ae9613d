"""Local clocks, the zone lookup, and UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import attach_zone, local_clock, local_to_utc, read_zones_csv
from tideline.session import new_folder
from tideline_queries.inputs import (
    DEPARTURES_SQL,
    TIMED_SQL,
    ZONES_SQL,
    departures,
    events,
    shown,
    stamp_sql,
    zones,
)


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes come from a number up to 99, so many clocks are no time of day."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events(spark, sf_dir).select(
        "event_id", F.to_date("ts").alias("day"), (F.hour("ts") * 100 + k).alias("hhmm")
    )
    return shown(rows.withColumn("local", local_clock(F.col("day"), F.col("hhmm"))))


def clock_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks with a digit too many, of which the first four are taken."""
    rows = events(spark, sf_dir).select(
        "event_id", F.to_date("ts").alias("day"),
        ((F.hour("ts") * 100 + F.minute("ts")) * 10).alias("hhmm"),
    )
    return shown(rows.withColumn("local", local_clock(F.col("day"), F.col("hhmm"), cut_long=True)))


def clock_2400(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hour of a day written as 24 of its own date."""
    rows = events(spark, sf_dir).select(
        "event_id",
        F.to_date("ts").alias("day"),
        (F.when(F.hour("ts") == 0, 24).otherwise(F.hour("ts")) * 100).alias("hhmm"),
    )
    return shown(rows.withColumn("local", local_clock(F.col("day"), F.col("hhmm"), roll_2400=True)))


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup is written as CSV and read back."""
    folder = new_folder(spark, "zones")
    zones(spark, sf_dir).write.option("header", True).csv(folder)
    lookup = read_zones_csv(spark, folder, "code", "zone")
    return shown(attach_zone(departures(spark, sf_dir), lookup, "place", code="code", zone="zone"))


def lookup_join_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the lookup were too large to broadcast."""
    joined = attach_zone(
        departures(spark, sf_dir), zones(spark, sf_dir), "place",
        code="code", zone="zone", broadcast_rows=0,
    )
    return shown(joined)


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_to_utc(
        departures(spark, sf_dir), zones(spark, sf_dir),
        "place", "day", "hhmm", "instant", code="code", zone="zone",
    )


def utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(timed(spark, sf_dir))


def utc_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is taken to be ``value`` minutes late against its scheduled day."""
    rows = departures(spark, sf_dir).withColumn("late", F.col("value").cast("int"))
    return shown(
        local_to_utc(
            rows, zones(spark, sf_dir), "place", "day", "hhmm", "instant",
            code="code", zone="zone", delay="late",
        )
    )


def utc_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days spread over a year and clocks over its nights, so that some clocks occur twice or never;
    of those that occur twice the later is taken."""
    rows = departures(spark, sf_dir).select(
        "event_id", "place", F.date_add(F.lit("2023-01-01").cast("date"), (F.col("event_id") % 365).cast("int")).alias("day"),
        (F.col("hhmm") % 400).alias("hhmm"),
    )
    return shown(
        local_to_utc(
            rows, zones(spark, sf_dir), "place", "day", "hhmm", "instant",
            code="code", zone="zone", doubled="later", mark="fit",
        )
    )


_LOOKUP_SQL = f"""
WITH {DEPARTURES_SQL},{ZONES_SQL}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, zone
FROM departures LEFT JOIN zones ON place = code"""

QUERIES = {
    "local_clock": clock,
    "local_clock_cut": clock_cut,
    "local_clock_2400": clock_2400,
    "tz_lookup_join": lookup_join,
    "tz_lookup_join_large": lookup_join_large,
    "local_to_utc": utc,
    "local_to_utc_delayed": utc_delayed,
    "local_to_utc_marked": utc_marked,
}

SQL = {
    "local_clock": f"""
WITH clocks AS (
  SELECT event_id, CAST(ts AS DATE) AS day, hour(ts) AS h,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, CAST(day AS VARCHAR) AS day, CAST(h * 100 + k AS INTEGER) AS hhmm,
       CASE WHEN k < 60 THEN {stamp_sql("CAST(day AS TIMESTAMP) + to_hours(h) + to_minutes(k)")} END AS local
FROM clocks""",
    "local_clock_cut": f"""
WITH clocks AS (
  SELECT event_id, CAST(ts AS DATE) AS day, CAST((hour(ts) * 100 + minute(ts)) * 10 AS INTEGER) AS hhmm FROM events),
cut AS (SELECT *, CASE WHEN hhmm > 9999 THEN hhmm // 10 ELSE hhmm END AS v FROM clocks)
SELECT event_id, CAST(day AS VARCHAR) AS day, hhmm,
       CASE WHEN v // 100 < 24 AND v % 100 < 60
            THEN {stamp_sql("CAST(day AS TIMESTAMP) + to_hours(v // 100) + to_minutes(v % 100)")} END AS local
FROM cut""",
    "local_clock_2400": f"""
WITH clocks AS (
  SELECT event_id, CAST(ts AS DATE) AS day,
         CASE WHEN hour(ts) = 0 THEN 24 ELSE hour(ts) END AS h FROM events)
SELECT event_id, CAST(day AS VARCHAR) AS day, CAST(h * 100 AS INTEGER) AS hhmm,
       {stamp_sql("CAST(day AS TIMESTAMP) + to_hours(h)")} AS local
FROM clocks""",
    "tz_lookup_join": _LOOKUP_SQL,
    "tz_lookup_join_large": _LOOKUP_SQL,
    "local_to_utc": f"""
WITH {TIMED_SQL}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, {stamp_sql("instant")} AS instant
FROM timed""",
    "local_to_utc_delayed": f"""
WITH {DEPARTURES_SQL},{ZONES_SQL},
clocks AS (
  SELECT d.*, zone, CAST(trunc(value) AS INTEGER) AS late,
         (hhmm // 100) * 60 + hhmm % 100 AS minutes
  FROM departures d LEFT JOIN zones ON place = code),
moved AS (
  SELECT *, CAST(day AS TIMESTAMP) + to_minutes(minutes)
            - to_days(CAST(floor((minutes - late) / 1440.0) AS INTEGER)) AS local FROM clocks)
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, late,
       {stamp_sql("timezone('UTC', timezone(zone, local))")} AS instant
FROM moved""",
    "local_to_utc_marked": f"""
WITH {DEPARTURES_SQL},{ZONES_SQL},
spread AS (
  SELECT event_id, place, zone, CAST(DATE '2023-01-01' + CAST(event_id % 365 AS INTEGER) AS DATE) AS day,
         CAST(hhmm % 400 AS INTEGER) AS hhmm
  FROM departures LEFT JOIN zones ON place = code),
clocks AS (
  SELECT *, CASE WHEN zone IS NOT NULL AND hhmm % 100 < 60
                 THEN CAST(day AS TIMESTAMP) + to_hours(hhmm // 100) + to_minutes(hhmm % 100) END AS local FROM spread),
near AS (
  SELECT *, timezone('UTC', timezone(zone, local - INTERVAL 24 HOURS)) + INTERVAL 24 HOURS AS a,
         timezone('UTC', timezone(zone, local + INTERVAL 24 HOURS)) - INTERVAL 24 HOURS AS b FROM clocks),
fitted AS (
  SELECT *, timezone(zone, timezone('UTC', a)) = local AS fits_a, timezone(zone, timezone('UTC', b)) = local AS fits_b
  FROM near)
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm,
       CASE WHEN fits_a AND fits_b AND a <> b THEN 'doubled' WHEN NOT fits_a AND NOT fits_b THEN 'skipped'
            WHEN fits_a OR fits_b THEN 'unique' END AS fit,
       {stamp_sql("CASE WHEN fits_a AND fits_b THEN greatest(a, b) WHEN fits_b THEN b ELSE a END")} AS instant
FROM fitted""",
}
