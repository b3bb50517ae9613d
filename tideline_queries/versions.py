"""Loads into versioned days, and loads with ties, delays and malformed records."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import ColumnSpec, DailyLoad, DayStore, VersionedLoad, overwrite_days
from tideline.session import new_folder, new_table
from tideline_queries.inputs import (
    DEPARTURES_SQL,
    TIMED_SQL,
    ZONES_SQL,
    departures,
    gap_sql,
    shown,
    stamp_sql,
    zones,
)
from tideline_queries.loads import COLUMNS, SQL as LOADS_SQL, _days, _thirds, as_json, config
from tideline_queries.sequences import SQL as SEQUENCES_SQL


def _versioned(spark: SparkSession, sf_dir: str, **more) -> VersionedLoad:
    settings = replace(config("unused"), output_path=new_folder(spark, "days"), **more)
    return VersionedLoad(settings, zones(spark, sf_dir))


def _load_in_thirds(load: DailyLoad, rows: DataFrame) -> None:
    for days in _thirds(_days(rows)):
        load.load(rows.where(F.col("day").isin(days)))


def overwrite_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days; a writer that is lost before its commit; the first and the last day with other values."""
    rows = departures(spark, sf_dir)
    store = DayStore(spark, new_folder(spark, "days"), "day")
    days = store.overwrite(rows)
    other = rows.withColumn("value", F.col("value") + 1000)
    store.write(other, "days")
    store.overwrite(other.where(F.col("day").isin(days[0], days[-1])))
    return shown(store.rows())


def overwrite_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days in an external table, read from its location."""
    rows, table, path = departures(spark, sf_dir), new_table(spark, "days"), new_folder(spark, "external")
    overwrite_days(rows, table, "day", path=path)
    days = _days(rows)
    other = rows.where(F.col("day").isin(days[0], days[-1])).withColumn("value", F.col("value") + 1000)
    overwrite_days(other, table, "day")
    spark.sql(f"DROP TABLE {table}")  # the files of an external table stay
    schema = "event_id bigint, place bigint, hhmm int, kind string, value double, day date"
    return shown(spark.read.schema(schema).parquet(path))


def cross_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned days, loaded out of order, the middle ones twice."""
    load, rows = _versioned(spark, sf_dir), departures(spark, sf_dir)
    _load_in_thirds(load, rows)
    load.load(rows.where(F.col("day").isin(_thirds(_days(rows))[-1])))
    return shown(load.table(), ("gap",))


def open_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next event however many days away, with days loaded out of order."""
    load = _versioned(spark, sf_dir, lookback_days=None)
    _load_in_thirds(load, departures(spark, sf_dir))
    return shown(load.table(), ("gap",))


def maintained_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of days as the commits state them, after loads, repairs and a reload."""
    load, rows = _versioned(spark, sf_dir, lookback_days=None), departures(spark, sf_dir)
    _load_in_thirds(load, rows.withColumn("hhmm", F.lit(0)))
    _load_in_thirds(load, rows)
    return shown(load.store.report())


def _tied(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hhmm", F.floor(F.col("hhmm") / 100).cast("int") * 100)


def tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks cut to the hour and nothing given to tell ties apart; days come out of order, first
    without half of their events, then whole, in other orders of rows."""
    rows, table = _tied(departures(spark, sf_dir)), new_table(spark, "tied")
    load = DailyLoad(replace(config(table), tie_break=()), zones(spark, sf_dir))
    _load_in_thirds(load, rows.where("event_id % 2 = 0").orderBy(F.desc("event_id")))
    _load_in_thirds(load, rows.orderBy("kind", "event_id"))
    _load_in_thirds(load, rows.orderBy(F.desc("kind"), F.desc("event_id")))
    return shown(spark.read.table(table), ("gap",))


def _delay() -> Column:
    """Minutes behind schedule; null, early and more than a day late among them."""
    late = F.when(F.col("event_id") % 7 == 0, None).otherwise((F.col("event_id") % 5) * 400 - 300)
    return late.cast("int").alias("delay")


def delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's rows under the day they really left on, a third of the files at a time, the first ones twice."""
    columns = (*COLUMNS, ColumnSpec("delay", "int", "minutes behind schedule"))
    load = _versioned(spark, sf_dir, columns=columns, delay="delay", source_day="scheduled", lookback_days=2)
    rows = departures(spark, sf_dir).select("*", _delay())
    _load_in_thirds(load, rows)
    again = _thirds(_days(rows))[0]
    load.load(rows.where(F.col("day").isin(again)), again)
    return shown(load.table(), ("gap", "delay"))


def _broken() -> Column:
    """A record cut short within its array."""
    return F.concat(
        F.lit('{"day":"'), F.col("day"), F.lit('","who":{"place":'), F.col("who.place").cast("string"),
        F.lit('},"what":[{"event_id":'), F.element_at("what", 1)["event_id"].cast("string"),
    )


def malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a day each in which every thirteenth record is cut short: what is loaded, and what is
    stored beside it."""
    rows = as_json(departures(spark, sf_dir))
    line = F.when(F.element_at("what", 1)["event_id"] % 13 == 0, _broken()).otherwise(
        F.to_json(F.struct("day", "who", "what"))
    )
    folder = new_folder(spark, "landing")
    text = rows.select(line.alias("value"), "arrival").repartition("arrival")
    text.write.partitionBy("arrival").text(folder)
    load = _versioned(spark, sf_dir, on_error="store")
    for days in _thirds(_days(departures(spark, sf_dir))):
        load.run([f"{folder}/arrival={d}" for d in days])
    lost = load.store.malformed().select(F.col("text").alias("line"), F.col("day").cast("string").alias("day"))
    return shown(load.table(), ("gap", "event_id", "place", "hhmm")).unionByName(lost, allowMissingColumns=True)


_LAST = f"""{stamp_sql("instant")} AS instant, {stamp_sql("instant_next")} AS instant_next, kind_next,
       {gap_sql("instant_next", "instant")} AS gap"""


def _led(timed: str, order: str, lookback_days: int | None) -> str:
    near = "true" if lookback_days is None else f"d - day <= {lookback_days}"
    return f"""
led AS (
  SELECT *, lead(instant) OVER w AS a, lead(kind) OVER w AS k, lead(day) OVER w AS d
  FROM {timed} WHERE instant IS NOT NULL WINDOW w AS (PARTITION BY place ORDER BY instant, day, {order})
  UNION ALL SELECT *, NULL, NULL, NULL FROM {timed} WHERE instant IS NULL),
capped AS (
  SELECT *, CASE WHEN {near} THEN a END AS instant_next, CASE WHEN {near} THEN k END AS kind_next FROM led)"""


_INSTANT = """timezone('UTC', timezone(zone, CAST(day AS TIMESTAMP) + to_hours(hhmm // 100) + to_minutes(hhmm % 100)))"""

QUERIES = {
    "partition_overwrite_atomic": overwrite_atomic,
    "partition_overwrite_external": overwrite_external,
    "next_event_versioned": cross_day,
    "next_event_open_tails": open_tails,
    "maintained_quality_report": maintained_report,
    "daily_load_tied": tied,
    "daily_load_delayed": delayed,
    "daily_load_malformed": malformed,
}

SQL = {
    "partition_overwrite_atomic": LOADS_SQL["partition_overwrite"],
    "partition_overwrite_external": LOADS_SQL["partition_overwrite"],
    "next_event_versioned": LOADS_SQL["next_event_cross_day"],
    "next_event_open_tails": f"""
WITH {TIMED_SQL}, {_led("timed", "event_id", None)}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, {_LAST} FROM capped""",
    "maintained_quality_report": SEQUENCES_SQL["quality_report"],
    "daily_load_tied": f"""
WITH {DEPARTURES_SQL},{ZONES_SQL},
cut AS (SELECT * REPLACE (CAST(hhmm // 100 * 100 AS INTEGER) AS hhmm) FROM departures),
timed AS (SELECT c.*, {_INSTANT} AS instant FROM cut c LEFT JOIN zones ON place = code),
{_led("timed", "kind, event_id", 1)}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, {_LAST} FROM capped""",
    "daily_load_delayed": f"""
WITH {DEPARTURES_SQL},{ZONES_SQL},
late AS (
  SELECT *, CASE WHEN event_id % 7 <> 0 THEN CAST((event_id % 5) * 400 - 300 AS INTEGER) END AS delay,
         hhmm // 100 * 60 + hhmm % 100 AS minutes FROM departures),
moved AS (
  SELECT * EXCLUDE (day, minutes), day AS scheduled,
         day - coalesce(CAST(floor((minutes - delay) / 1440.0) AS INTEGER), 0) AS day FROM late),
timed AS (SELECT m.*, {_INSTANT} AS instant FROM moved m LEFT JOIN zones ON place = code),
{_led("timed", "event_id", 2)}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, CAST(scheduled AS VARCHAR) AS scheduled, hhmm, kind, value,
       CAST(delay AS DOUBLE) AS delay, {_LAST}
FROM capped""",
    "daily_load_malformed": f"""
WITH {TIMED_SQL},
good AS (SELECT * FROM timed WHERE event_id % 13 <> 0), {_led("good", "event_id", 1)}
SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(place AS DOUBLE) AS place, CAST(day AS VARCHAR) AS day,
       CAST(hhmm AS DOUBLE) AS hhmm, kind, value, {_LAST}, NULL AS line
FROM capped
UNION ALL
SELECT NULL, NULL, CASE WHEN day IN (SELECT day FROM good) THEN CAST(day AS VARCHAR) END, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       '{{"day":"' || CAST(day AS VARCHAR) || '","who":{{"place":' || place || '}},"what":[{{"event_id":' || event_id
FROM timed WHERE event_id % 13 = 0""",
}
