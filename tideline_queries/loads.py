"""Loads into a day-partitioned table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import (
    ColumnSpec,
    DailyLoad,
    LoadConfig,
    day_slice,
    land_stream,
    neighbouring_days,
    overwrite_days,
)
from tideline.session import new_folder, new_table
from tideline_queries.inputs import (
    DEPARTURES_SQL,
    TIMED_SQL,
    departures,
    gap_sql,
    shown,
    stamp_sql,
    zones,
)

COLUMNS = (
    ColumnSpec("event_id", "bigint", "event"),
    ColumnSpec("place", "bigint", "where it happened"),
    ColumnSpec("day", "date", "local date", "yyyy-MM-dd"),
    ColumnSpec("hhmm", "int", "local clock"),
    ColumnSpec("kind", "string", "what happened"),
    ColumnSpec("value", "double", "measured value"),
)
JSON_SCHEMA = (
    "day string, who struct<place:bigint>, "
    "what array<struct<event_id:bigint,hhmm:bigint,kind:string,value:double>>"
)


def config(table: str, lookback_days: int = 1) -> LoadConfig:
    return LoadConfig(
        COLUMNS, table, lookback_days=lookback_days, key="place", day="day", clock="hhmm",
        time="instant", carry={"kind": "kind_next"}, gap="gap", zone_code="code", zone_name="zone",
        tie_break=("event_id",), json_schema=JSON_SCHEMA,
    )


def as_json(rows: DataFrame) -> DataFrame:
    """Departures in nested form, with the day they arrive under."""
    return rows.select(
        F.col("day").cast("string").alias("day"),
        F.struct("place").alias("who"),
        F.array(F.struct("event_id", "hhmm", "kind", "value")).alias("what"),
        F.col("day").cast("string").alias("arrival"),
    )


def land(spark: SparkSession, sf_dir: str) -> str:
    """All departures as JSON, a folder per day."""
    folder = new_folder(spark, "landing")
    rows = as_json(departures(spark, sf_dir)).hint("rebalance", "arrival")
    rows.write.partitionBy("arrival").json(folder)
    return folder


def _days(rows: DataFrame) -> list[date]:
    return sorted(r.day for r in rows.select("day").distinct().collect())


def _thirds(days: list[date]) -> list[list[date]]:
    """All days in three runs: the last ones, the first ones, those between."""
    a, b = len(days) // 3, 2 * len(days) // 3
    return [part for part in (days[b:], days[:a], days[a:b]) if part]


def _load_in_thirds(spark: SparkSession, sf_dir: str, lookback_days: int) -> DataFrame:
    rows = departures(spark, sf_dir)
    table = new_table(spark, "loaded")
    load = DailyLoad(config(table, lookback_days), zones(spark, sf_dir))
    for days in _thirds(_days(rows)):
        load.load(rows.where(F.col("day").isin(days)))
    return shown(spark.read.table(table), ("gap",))


def cross_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_in_thirds(spark, sf_dir, 1)


def full_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_in_thirds(spark, sf_dir, 5)


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land(spark, sf_dir)
    table = new_table(spark, "daily")
    load = DailyLoad(config(table), zones(spark, sf_dir))
    for days in _thirds(_days(departures(spark, sf_dir))):
        load.run([f"{folder}/arrival={d}" for d in days])
    return shown(spark.read.table(table), ("gap",))


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land(spark, sf_dir)
    table = new_table(spark, "landed")
    load = DailyLoad(config(table), zones(spark, sf_dir))
    files = spark.read.format("binaryFile").load(f"{folder}/*/*.json").count()
    stream = land_stream(
        spark, folder, load, new_folder(spark, "stream"), unit="folder", max_files=-(-files // 3)
    )
    stream.awaitTermination()
    return shown(spark.read.table(table), ("gap",))


def landing_stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files with rows of all days, one file a batch: each day comes together again."""
    folder, table = new_folder(spark, "landing"), new_table(spark, "landed")
    as_json(departures(spark, sf_dir).repartition(4, "event_id")).drop("arrival").write.json(folder)
    load = DailyLoad(config(table), zones(spark, sf_dir))
    land_stream(spark, folder, load, new_folder(spark, "stream"), max_files=1).awaitTermination()
    return shown(spark.read.table(table), ("gap",))


def _stored(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    rows = departures(spark, sf_dir)
    table = new_table(spark, "days")
    overwrite_days(rows, table, "day")
    return table, rows


def previous_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored day before the latest one."""
    table, rows = _stored(spark, sf_dir)
    latest = rows.agg(F.max("day")).first()[0]
    return shown(day_slice(spark, table, neighbouring_days([latest], 1, 0), "day"))


def _reload(column: Column) -> Column:
    return column + 1000


def overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the first and the last one again with other values."""
    table, rows = _stored(spark, sf_dir)
    days = _days(rows)
    again = rows.where(F.col("day").isin(days[0], days[-1])).withColumn("value", _reload(F.col("value")))
    overwrite_days(again, table, "day", output_partitions=10)
    return shown(spark.read.table(table))


def _loaded_sql(lookback_days: int) -> str:
    return f"""
WITH {TIMED_SQL},
led AS (
  SELECT *, lead(instant) OVER w AS a, lead(kind) OVER w AS k, lead(day) OVER w AS d
  FROM timed WHERE instant IS NOT NULL
  WINDOW w AS (PARTITION BY place ORDER BY instant, day, event_id)
  UNION ALL SELECT *, NULL, NULL, NULL FROM timed WHERE instant IS NULL),
capped AS (
  SELECT *, CASE WHEN d - day <= {lookback_days} THEN a END AS instant_next,
         CASE WHEN d - day <= {lookback_days} THEN k END AS kind_next FROM led)
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value, {stamp_sql("instant")} AS instant,
       {stamp_sql("instant_next")} AS instant_next, kind_next,
       {gap_sql("instant_next", "instant")} AS gap
FROM capped"""


QUERIES = {
    "previous_day_slice": previous_day,
    "partition_overwrite": overwrite,
    "next_event_cross_day": cross_day,
    "next_event_full_lookback": full_lookback,
    "daily_load": daily_load,
    "landing_stream": landing_stream,
    "landing_stream_files": landing_stream_files,
}

SQL = {
    "previous_day_slice": f"""
WITH {DEPARTURES_SQL}
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind, value FROM departures
WHERE day = (SELECT max(day) FROM departures) - 1""",
    "partition_overwrite": f"""
WITH {DEPARTURES_SQL}, ends AS (SELECT min(day) AS a, max(day) AS z FROM departures)
SELECT event_id, place, CAST(day AS VARCHAR) AS day, hhmm, kind,
       CASE WHEN day IN (a, z) THEN value + 1000 ELSE value END AS value
FROM departures, ends""",
    "next_event_cross_day": _loaded_sql(1),
    "next_event_full_lookback": _loaded_sql(5),
    "daily_load": _loaded_sql(1),
    "landing_stream": _loaded_sql(1),
    "landing_stream_files": _loaded_sql(1),
}
