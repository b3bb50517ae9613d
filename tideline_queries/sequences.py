"""Next events, first events, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import first_per_key, next_event, quality_report
from tideline_queries.inputs import TIMED_SQL, events, gap_sql, shown, stamp_sql
from tideline_queries.times import timed

_CARRY = {"event_type": "type_next"}


def _slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors have no time."""
    return _slim(spark, sf_dir).withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))


def next_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(next_event(_slim(spark, sf_dir), "user_id", "ts", _CARRY, "gap", ["event_id"]), ("gap",))


def tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cut to the day, so that most rows tie, and no columns given to tell them apart."""
    rows = _slim(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts"))
    return shown(next_event(rows, "user_id", "ts", _CARRY, "gap"), ("gap",))


def nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_gaps(spark, sf_dir)
    return shown(next_event(rows, "user_id", "ts", _CARRY, "gap", ["event_id"]), ("gap",))


def nulls_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_gaps(spark, sf_dir)
    out = next_event(rows, "user_id", "ts", _CARRY, "gap", ["event_id"], skip_null_times=True)
    return shown(out, ("gap",))


def busy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of keys hold all rows; each is cut into many ranges."""
    rows = _slim(spark, sf_dir)
    share = max(100, rows.count() // 16)
    out = next_event(
        rows, "event_type", "ts", {"user_id": "user_next"}, "gap", ["event_id"], rows_per_task=share
    )
    return shown(out, ("gap", "user_next"))


def utc_and_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local clock to UTC, then the next event of the place."""
    return next_event(
        timed(spark, sf_dir), "place", "instant", {"kind": "kind_next"}, "gap", ["event_id"],
        skip_null_times=True,
    )


def utc_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(utc_and_next(spark, sf_dir), ("gap",))


def firsts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(first_per_key(_slim(spark, sf_dir), "user_id", ["ts", "event_id"]))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(quality_report(utc_and_next(spark, sf_dir), "day", "instant", "instant_next"))


def _next_sql(rows: str, key: str, carry: str, carried: str) -> str:
    return f"""
WITH rows AS ({rows}),
led AS (SELECT *, lead(ts) OVER w AS n, lead({carry}) OVER w AS {carried} FROM rows
        WINDOW w AS (PARTITION BY {key} ORDER BY ts NULLS FIRST, event_id))
SELECT event_id, user_id, event_type, {stamp_sql("ts")} AS ts, {stamp_sql("n")} AS ts_next, {carried},
       {gap_sql("n", "ts")} AS gap
FROM led"""


_SLIM = "SELECT event_id, user_id, event_type, ts FROM events"
_GAPS = (
    "SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events"
)

UTC_NEXT_SQL = f"""
WITH {TIMED_SQL},
led AS (
  SELECT *, lead(instant) OVER w AS n, lead(kind) OVER w AS kind_next FROM timed WHERE instant IS NOT NULL
  WINDOW w AS (PARTITION BY place ORDER BY instant, event_id)
  UNION ALL SELECT *, NULL, NULL FROM timed WHERE instant IS NULL)"""

QUERIES = {
    "next_event": next_of_user,
    "next_event_tied": tied,
    "next_event_nulls_first": nulls_first,
    "next_event_nulls_skipped": nulls_skipped,
    "next_event_busy_keys": busy_keys,
    "utc_next_event": utc_next,
    "first_per_key": firsts,
    "quality_report": report,
}

SQL = {
    "next_event": _next_sql(_SLIM, "user_id", "event_type", "type_next"),
    "next_event_tied": f"""
WITH rows AS (SELECT event_id, user_id, event_type, date_trunc('day', ts) AS ts FROM events),
led AS (SELECT *, lead(ts) OVER w AS n, lead(event_type) OVER w AS type_next FROM rows
        WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_type NULLS FIRST, event_id))
SELECT event_id, user_id, event_type, {stamp_sql("CAST(ts AS TIMESTAMP)")} AS ts, {stamp_sql("CAST(n AS TIMESTAMP)")} AS ts_next,
       type_next, {gap_sql("CAST(n AS TIMESTAMP)", "CAST(ts AS TIMESTAMP)")} AS gap
FROM led""",
    "next_event_nulls_first": _next_sql(_GAPS, "user_id", "event_type", "type_next"),
    "next_event_nulls_skipped": f"""
WITH rows AS ({_GAPS}),
led AS (
  SELECT *, lead(ts) OVER w AS n, lead(event_type) OVER w AS type_next FROM rows WHERE ts IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
  UNION ALL SELECT *, NULL, NULL FROM rows WHERE ts IS NULL)
SELECT event_id, user_id, event_type, {stamp_sql("ts")} AS ts, {stamp_sql("n")} AS ts_next, type_next,
       {gap_sql("n", "ts")} AS gap
FROM led""",
    "next_event_busy_keys": _next_sql(_SLIM, "event_type", "CAST(user_id AS DOUBLE)", "user_next"),
    "utc_next_event": f"""{UTC_NEXT_SQL}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, {stamp_sql("instant")} AS instant,
       {stamp_sql("n")} AS instant_next, kind_next, {gap_sql("n", "instant")} AS gap
FROM led""",
    "first_per_key": f"""
SELECT event_id, user_id, event_type, {stamp_sql("ts")} AS ts
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
    "quality_report": f"""{UTC_NEXT_SQL}
SELECT CAST(day AS VARCHAR) AS day, count(*) AS rows,
       CAST(count(*) FILTER (instant IS NULL) AS BIGINT) AS null_times,
       CAST(count(*) FILTER (n IS NULL) AS BIGINT) AS null_next,
       {stamp_sql("min(instant)")} AS first_time, {stamp_sql("max(instant)")} AS last_time
FROM led GROUP BY day""",
}
