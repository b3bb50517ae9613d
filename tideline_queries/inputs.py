"""The given tables, seen as events at places with local clocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed: time zone by region key; region 4 is left out, so its places have none.
ZONE_OF_REGION = {
    0: "Africa/Lagos",
    1: "America/New_York",
    2: "Asia/Kolkata",
    3: "Europe/Madrid",
}

_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a place, a local day and a local hhmm clock."""
    return events(spark, sf_dir).select(
        "event_id",
        F.col("user_id").alias("place"),
        F.to_date("ts").alias("day"),
        (F.hour("ts") * 100 + F.minute("ts")).alias("hhmm"),
        F.col("event_type").alias("kind"),
        "value",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and time zone of every place, a place being a customer."""
    nation = read(spark, sf_dir, "nation")
    zone = F.lit(None).cast("string")
    for region, name in ZONE_OF_REGION.items():
        zone = F.when(F.col("n_regionkey") == region, name).otherwise(zone)
    return (
        read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("code"), zone.alias("zone"))
        .where(F.col("zone").isNotNull())
    )


def shown(df: DataFrame, sparse: tuple[str, ...] = ()) -> DataFrame:
    """The rows in types every client reads the same way.

    Dates and timestamps become text, and whole numbers that may be null
    (``sparse``) become doubles.
    """

    def plain(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.date_format(name, _STAMP).alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        return F.col(name).cast("double").alias(name) if name in sparse else F.col(name)

    return df.select(*[plain(name, kind) for name, kind in df.dtypes])


# The same in SQL, as the start of a WITH list.
_REGIONS = " ".join(f"WHEN {k} THEN '{v}'" for k, v in ZONE_OF_REGION.items())

DEPARTURES_SQL = """
departures AS (
  SELECT event_id, user_id AS place, CAST(ts AS DATE) AS day,
         CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS hhmm, event_type AS kind, value
  FROM events)"""

ZONES_SQL = f"""
zones AS (
  SELECT c_custkey AS code, CASE n_regionkey {_REGIONS} END AS zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE n_regionkey IN ({", ".join(map(str, ZONE_OF_REGION))}))"""

TIMED_SQL = f"""{DEPARTURES_SQL},{ZONES_SQL},
timed AS (
  SELECT d.*, timezone('UTC', timezone(zone,
           CAST(day AS TIMESTAMP) + to_hours(hhmm // 100) + to_minutes(hhmm % 100))) AS instant
  FROM departures d LEFT JOIN zones ON place = code)"""


def stamp_sql(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"


def gap_sql(later: str, earlier: str) -> str:
    """Whole seconds between, each cut to its second first."""
    seconds = [f"CAST(floor(epoch_us({v}) / 1000000) AS BIGINT)" for v in (later, earlier)]
    return f"CAST({seconds[0]} - {seconds[1]} AS DOUBLE)"
