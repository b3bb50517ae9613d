"""Files whose fields and types change, and the whole flight record from file to table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import ColumnSpec, LoadConfig, SchemaStore, VersionedLoad, read_events_json
from tideline.session import new_folder
from tideline_queries.inputs import TIMED_SQL, departures, events, gap_sql, shown, stamp_sql, zones
from tideline_queries.loads import _days, _thirds

_DRIFT_SPECS = (
    ColumnSpec("event_id", "bigint"),
    ColumnSpec("amount", "double"),
    ColumnSpec("code", "string"),
    ColumnSpec("size", "double"),
    ColumnSpec("unit", "string"),
    ColumnSpec("flag", "boolean"),
)


def _clicks() -> list[Column]:
    """Whole amounts, codes as numbers, sizes as whole numbers."""
    sizes = F.array(F.struct((F.col("event_id") % 10).alias("size")))
    return [F.floor("value").alias("amount"), F.col("user_id").alias("code"), sizes.alias("parts")]


def _views() -> list[Column]:
    """Amounts with fractions, codes as text, sizes with a unit, one record without parts."""
    sizes = F.array(F.struct((F.col("event_id") % 10 + 0.5).alias("size"), F.lit("kg").alias("unit")))
    code = F.concat(F.lit("u"), "user_id")
    return [F.col("value").alias("amount"), code.alias("code"), sizes.alias("parts")]


def _others() -> list[Column]:
    """No amounts, codes as objects, a flag further down."""
    sizes = F.array(F.struct((F.col("event_id") % 10).alias("size")))
    more = F.struct(F.struct((F.col("user_id") % 2 == 0).alias("flag")).alias("deep"))
    return [F.struct(F.col("user_id").alias("id")).alias("code"), sizes.alias("parts"), more.alias("more")]


def ingest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of files that each change what the fields hold, and the changes that were told."""
    store, rows = SchemaStore(spark, new_folder(spark, "schemas")), events(spark, sf_dir)
    kind = F.col("event_type")
    forms = [(kind == "click", _clicks()), (kind == "view", _views()), (~kind.isin("click", "view"), _others())]
    out = None
    for taken, columns in forms:
        folder = new_folder(spark, "drift")
        rows.where(taken).select("event_id", *columns).write.json(folder)
        flat = read_events_json(spark, folder, _DRIFT_SPECS, drift=store)
        out = flat if out is None else out.unionByName(flat)
    told = store.history().withColumn("version", F.col("version").cast("double"))
    return shown(out.unionByName(told, allowMissingColumns=True), ("event_id",))


# Fixed: names and types of the flight record
FLIGHT_COLUMNS = (
    ColumnSpec("FlightDate", "date", "local date of departure", "yyyy-MM-dd"),
    ColumnSpec("Reporting_Airline", "string", "carrier"),
    ColumnSpec("OriginAirportID", "int", "number of the airport of departure"),
    ColumnSpec("Origin", "string", "airport of departure"),
    ColumnSpec("OriginCityName", "string", "its city"),
    ColumnSpec("OriginState", "string", "its state"),
    ColumnSpec("DestAirportID", "int", "number of the airport of arrival"),
    ColumnSpec("Dest", "string", "airport of arrival"),
    ColumnSpec("DestCityName", "string", "its city"),
    ColumnSpec("DestState", "string", "its state"),
    ColumnSpec("DepDelay", "int", "minutes behind schedule, less than 0 before it"),
    ColumnSpec("DepTime", "int", "local clock of departure, hhmm"),
    ColumnSpec("ArrDelay", "int", "minutes behind schedule on arrival"),
    ColumnSpec("ArrTime", "int", "local clock of arrival, hhmm"),
    ColumnSpec("Cancelled", "boolean", "1 if it did not depart"),
    ColumnSpec("Diverted", "boolean", "1 if it landed elsewhere"),
    ColumnSpec("AirTime", "int", "minutes in the air"),
    ColumnSpec("Distance", "int", "miles"),
)


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures as flight records, a cancelled one without clock; 0 and 1 for the marks, as such files have."""
    place, hhmm = F.col("place"), F.col("hhmm")
    cancelled = F.col("kind") == "error"
    origin = F.struct(
        place.alias("OriginAirportID"), F.concat(F.lit("A"), place).alias("Origin"),
        F.concat(F.lit("City, "), place).alias("OriginCityName"), (place % 50).cast("string").alias("OriginState"),
    )
    dest = F.struct(
        (place + 1).alias("DestAirportID"), F.concat(F.lit("A"), place + 1).alias("Dest"),
        F.concat(F.lit("City, "), place + 1).alias("DestCityName"), ((place + 1) % 50).cast("string").alias("DestState"),
    )
    flight = F.struct(
        F.col("kind").alias("Reporting_Airline"), origin.alias("from"), dest.alias("to"),
        (F.col("event_id") % 90 - 30).alias("DepDelay"), F.when(~cancelled, hhmm).alias("DepTime"),
        (F.col("event_id") % 70 - 20).alias("ArrDelay"), F.when(~cancelled, hhmm).alias("ArrTime"),
        cancelled.cast("int").alias("Cancelled"), (F.col("event_id") % 7 == 0).cast("int").alias("Diverted"),
        F.col("event_id").alias("AirTime"), (F.col("event_id") % 3000).alias("Distance"),
    )
    return departures(spark, sf_dir).select(
        "day", F.col("day").cast("string").alias("FlightDate"), F.array(flight).alias("flights")
    )


def ingest_flight_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """18 declared columns out of nested files without a given schema, 22 in the loaded table."""
    rows, folder = _flights(spark, sf_dir), new_folder(spark, "flights")
    rows.hint("rebalance", "day").withColumnRenamed("day", "arrival").write.partitionBy("arrival").json(folder)
    places = zones(spark, sf_dir).select(F.concat(F.lit("A"), "code").alias("iata_code"), F.col("zone").alias("iana_tz"))
    config = LoadConfig(
        FLIGHT_COLUMNS, "unused", output_path=new_folder(spark, "days"), tie_break=("AirTime",),
        schema_folder=new_folder(spark, "schemas"),
    )
    load = VersionedLoad(config, places)
    for days in _thirds(_days(rows)):
        load.run([f"{folder}/arrival={d}" for d in days], days)
    return shown(load.table(), ("DepTime", "ArrTime", "diff_next"))


QUERIES = {"ingest_json_drift": ingest_drift, "ingest_flight_record": ingest_flight_record}

SQL = {
    "ingest_json_drift": """
SELECT CAST(event_id AS DOUBLE) AS event_id,
       CASE event_type WHEN 'click' THEN floor(value) WHEN 'view' THEN value END AS amount,
       CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN 'u' || user_id
            ELSE '{"id":' || user_id || '}' END AS code,
       event_id % 10 + CASE event_type WHEN 'view' THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS size,
       CASE event_type WHEN 'view' THEN 'kg' END AS unit,
       CASE WHEN event_type NOT IN ('click', 'view') THEN user_id % 2 = 0 END AS flag,
       NULL AS version, NULL AS path, NULL AS "old", NULL AS "new", NULL AS conflict
FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, * FROM (VALUES
  (1::DOUBLE, 'amount', NULL, 'bigint', false),
  (1, 'code', NULL, 'bigint', false),
  (1, 'event_id', NULL, 'bigint', false),
  (1, 'parts', NULL, 'array<struct<size:bigint>>', false),
  (2, 'amount', 'bigint', 'double', false),
  (2, 'code', 'bigint', 'string', true),
  (2, 'parts[].size', 'bigint', 'double', false),
  (2, 'parts[].unit', NULL, 'string', false),
  (3, 'more', NULL, 'struct<deep:struct<flag:boolean>>', false)) AS told""",
    "ingest_flight_record": f"""
WITH {TIMED_SQL},
led AS (
  SELECT *, lead(instant) OVER w AS a, lead(kind) OVER w AS k, lead(day) OVER w AS d
  FROM timed WHERE instant IS NOT NULL AND kind <> 'error'
  WINDOW w AS (PARTITION BY place ORDER BY instant, day, event_id)
  UNION ALL SELECT * REPLACE (NULL AS instant), NULL, NULL, NULL FROM timed WHERE instant IS NULL OR kind = 'error'),
capped AS (
  SELECT *, CASE WHEN d - day <= 1 THEN a END AS after, CASE WHEN d - day <= 1 THEN k END AS "then" FROM led)
SELECT CAST(day AS VARCHAR) AS "FlightDate", kind AS "Reporting_Airline",
       CAST(place AS INTEGER) AS "OriginAirportID", 'A' || place AS "Origin", 'City, ' || place AS "OriginCityName",
       CAST(place % 50 AS VARCHAR) AS "OriginState",
       CAST(place + 1 AS INTEGER) AS "DestAirportID", 'A' || (place + 1) AS "Dest", 'City, ' || (place + 1) AS "DestCityName",
       CAST((place + 1) % 50 AS VARCHAR) AS "DestState",
       CAST(event_id % 90 - 30 AS INTEGER) AS "DepDelay", CASE WHEN kind <> 'error' THEN CAST(hhmm AS DOUBLE) END AS "DepTime",
       CAST(event_id % 70 - 20 AS INTEGER) AS "ArrDelay", CASE WHEN kind <> 'error' THEN CAST(hhmm AS DOUBLE) END AS "ArrTime",
       kind = 'error' AS "Cancelled", event_id % 7 = 0 AS "Diverted",
       CAST(event_id AS INTEGER) AS "AirTime", CAST(event_id % 3000 AS INTEGER) AS "Distance",
       {stamp_sql("instant")} AS "FlightTime", {stamp_sql("after")} AS "FlightTime_next",
       "then" AS "Airline_next", {gap_sql("after", "instant")} AS diff_next
FROM capped""",
}
