"""Timings at ``$BENCH_SF_DIR``; prints one JSON line.

Queries are timed with this package's defaults and with the same operators in a
plain setting: inferred schema, no broadcast, no cutting of busy keys. The plain setting of loads into
versioned days is ``DailyLoad``, day by day in turns. The headline value is the sum over the default settings.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import (
    DailyLoad, VersionedLoad, build_session, local_to_utc, next_event, read_events_json, read_zones_csv,
)
from tideline_queries import QUERIES
from tideline_queries.inputs import departures, events, zones
from tideline_queries.loads import config, land
from tideline_queries.nested import _LINE_SCHEMA, _LINE_SPECS, _lines

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def medians(*actions) -> list[float]:
    """Median seconds of each action; after a warm-up they take turns."""
    for action in actions:
        action()
    turns = [[seconds(action) for action in actions] for _ in range(RUNS)]
    return [round(statistics.median(times), 3) for times in zip(*turns)]


def daily(folder: str, days: list, lookup: DataFrame, scratch: str) -> list[float]:
    """Seconds of loading all days one by one, into a table and into versioned days, in turns."""
    name = uuid.uuid4().hex
    settings = config(f"ours_{name}")
    loads = [DailyLoad(settings, lookup), VersionedLoad(replace(settings, output_path=f"{scratch}/{name}"), lookup)]
    turns = [[seconds(lambda: load.run(f"{folder}/arrival={d}")) for load in loads] for d in days]
    return [round(sum(times), 3) for times in zip(*turns)]


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        spark_master=f"local[{CPUS}]",
        spark_ui_enabled="false",
        spark_driver_memory="8g",
        spark_sql_shuffle_partitions=CPUS,
        spark_sql_warehouse_dir=f"{scratch}/warehouse",
        spark_checkpoint_dir=f"{scratch}/shared",
    )
    spark.sparkContext.setLogLevel("ERROR")

    rows = departures(spark, SF_DIR)
    zone_file = f"{scratch}/zones.csv"
    zones(spark, SF_DIR).toPandas().to_csv(zone_file, index=False)
    lookup = read_zones_csv(spark, zone_file, "code", "zone")

    folder = land(spark, SF_DIR)
    lines = f"{scratch}/lines"
    _lines(spark, SF_DIR).write.json(lines)
    days = sorted(r.day for r in rows.select("day").distinct().collect())

    def utc(source: DataFrame = rows) -> DataFrame:
        return local_to_utc(
            source, lookup, "place", "day", "hhmm", "instant", code="code", zone="zone"
        )

    def following(source: DataFrame) -> DataFrame:
        return next_event(source, "place", "instant", {"kind": "kind_next"}, "gap")

    moments = events(spark, SF_DIR).select(
        F.col("user_id").alias("place"), F.col("ts").alias("instant"), F.col("event_type").alias("kind"),
        "event_id", "value",
    )
    ours = {
        "local_to_utc": lambda: drain(utc()),
        "next_event": lambda: drain(following(moments)),
        "utc_next_event": lambda: drain(following(utc())),
        "flatten_array_inner": lambda: drain(QUERIES["flatten_array_inner"](spark, SF_DIR)),
        "ingest_json": lambda: drain(read_events_json(spark, lines, _LINE_SPECS, _LINE_SCHEMA)),
    }
    def plain_utc() -> DataFrame:
        return local_to_utc(
            rows, lookup, "place", "day", "hhmm", "instant", code="code", zone="zone", broadcast_rows=0
        )

    def plain_next(source: DataFrame) -> DataFrame:
        return next_event(source, "place", "instant", {"kind": "kind_next"}, "gap", rows_per_task=None)

    plain = {
        "local_to_utc": lambda: drain(plain_utc()),
        "next_event": lambda: drain(plain_next(moments)),
        "utc_next_event": lambda: drain(plain_next(plain_utc())),
        "flatten_array_inner": lambda: drain(
            _lines(spark, SF_DIR).selectExpr("at.*", "shipped", "inline(charges)")
        ),
        "ingest_json": lambda: drain(read_events_json(spark, lines, _LINE_SPECS)),
    }
    queries, baseline = {}, {}
    for name in ours:
        queries[name], baseline[name] = medians(ours[name], plain[name])
    # A load changes its table, so all days are loaded once, into a new one.
    daily(folder, days[:2], lookup, scratch)
    queries["daily_load"], queries["daily_load_versioned"] = daily(folder, days, lookup, scratch)
    baseline["daily_load_versioned"] = queries["daily_load"]
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "plain_shape": baseline,
                "plain_total": round(sum(baseline.values()), 3),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
