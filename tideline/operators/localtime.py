"""Time zone per place, and local times to UTC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.clock import local_clock, local_time_fit, rolled_day, to_utc
from tideline.operators.naming import column, has_order
from tideline.operators.skew import ROWS_PER_TASK, busy_keys, key_matches
from tideline.session import check_session, shared_folder

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Groups that rows without a place are dealt out over
_UNPLACED_GROUPS = 65_536


@dataclass(frozen=True)
class ZoneLookup:
    """One zone per code (``_code``, ``_zone``), and whether it may be broadcast."""

    rows: DataFrame
    small: bool


def zone_lookup(
    zones: DataFrame,
    code: str = "iata_code",
    zone: str = "iana_tz",
    broadcast_rows: int = BROADCAST_ROWS,
    keep: bool = False,
) -> ZoneLookup:
    """Make a lookup ready for joining; its size is measured once.

    Of several zones listed for a code the alphabetically first one counts.
    ``keep`` stores the result in the shared folder, for use in many joins.
    """
    listed = zones.select(column(code).alias("_code"), column(zone).alias("_zone"))
    listed = listed.where(F.col("_code").isNotNull())
    unique = listed.groupBy("_code").agg(F.min("_zone").alias("_zone"))
    if keep:
        shared_folder(zones.sparkSession)
        unique = unique.checkpoint()
    length = F.octet_length(F.col("_code").cast("string")) + F.octet_length("_zone")
    size = (unique if keep else listed).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes")
    )
    found = size.first()
    return ZoneLookup(unique, found.rows <= broadcast_rows and found.bytes <= BROADCAST_BYTES)


def attach_zone(
    df: DataFrame,
    zones: DataFrame | ZoneLookup,
    key: str,
    out: str = "zone",
    code: str = "iata_code",
    zone: str = "iana_tz",
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Left join of a place column with the place -> time zone lookup.

    Every row stays once; a place that is not listed gets a null zone. The
    lookup is broadcast if it is found to be small. Otherwise rows and lookup
    are shuffled once, by place; places with more than ``rows_per_task`` rows
    are cut into pieces for it. These are counted first, so give stored rows.
    """
    if out in df.columns:
        raise ValueError(f"column {out!r} is there already")
    if isinstance(zones, DataFrame):
        zones = zone_lookup(zones, code, zone, broadcast_rows)
    matches = column(key) == F.col("_code")
    if zones.small:
        joined = df.join(F.broadcast(zones.rows), matches, "left")
    else:
        joined = _join_large(df, zones.rows, key, matches, rows_per_task)
    return joined.select(*[column(c) for c in df.columns], F.col("_zone").alias(out))


def _join_large(
    df: DataFrame, lookup: DataFrame, key: str, matches: Column, rows_per_task: int | None
) -> DataFrame:
    """One shuffled join, in which no task gets all rows of a busy place or all without a place.

    Rows of a busy place are dealt out over pieces, and its few rows of the lookup are repeated for
    each. Rows without a place meet nothing, wherever they go; they count as a place.
    """
    busy, _ = busy_keys(df, [key], rows_per_task)
    if busy is None and rows_per_task is not None:
        # Counted, and neither a place nor the rows without one are too many for a task.
        return df.join(lookup, matches, "left").select(*[column(c) for c in df.columns], "_zone")
    whole = [column(f.name) for f in df.schema.fields if has_order(f.dataType)]
    # The task's number parts copies of one row; content alone would keep them together.
    deal = F.xxhash64(F.spark_partition_id(), *whole)
    rows, zones, pieces = df, lookup.withColumn("_piece", F.lit(0)), F.lit(1)
    if busy is not None:
        marks = F.broadcast(
            busy.select("_k0", F.ceil(2 * F.col("_rows") / rows_per_task).cast("int").alias("_pieces"))
        )
        pieces = F.coalesce("_pieces", F.lit(1))
        rows = df.join(marks, key_matches([key]), "left")
        each = F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_piece")
        zones = lookup.join(marks, F.col("_code") == F.col("_k0"), "left").select(*lookup.columns, each)
    own = F.when(column(key).isNull(), F.pmod(deal, F.lit(_UNPLACED_GROUPS))).otherwise(F.pmod(deal, pieces))
    found = rows.withColumn("_own_piece", own.cast("int")).join(
        zones, matches & (F.col("_own_piece") == F.col("_piece")), "left"
    )
    return found.select(*[column(c) for c in df.columns], "_zone")


def local_to_utc(
    df: DataFrame,
    zones: DataFrame | ZoneLookup,
    key: str = "Origin",
    day: str = "FlightDate",
    clock: str = "DepTime",
    out: str = "FlightTime",
    code: str = "iata_code",
    zone: str = "iana_tz",
    roll_2400: bool = False,
    delay: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int | None = ROWS_PER_TASK,
    doubled: str = "earlier",
    skipped: str = "forward",
    mark: str | None = None,
) -> DataFrame:
    """Add ``out``, the UTC instant of a local date and ``hhmm`` clock, as last column.

    It is null where the clock is no time of day or the place has no zone.
    ``delay`` names a column with minutes behind schedule; with it a
    departure after midnight gets the day it really left on. ``doubled`` and ``skipped`` say
    what becomes of local times that occur twice or not at all (see ``to_utc``); ``mark`` names a column
    before ``out`` that tells which they are.
    """
    check_session(df.sparkSession)
    zoned = attach_zone(df, zones, key, "_place_zone", code, zone, broadcast_rows, rows_per_task)
    date = column(day).try_cast("date")
    if delay is not None:
        date = rolled_day(date, column(clock), column(delay))
    local, place_zone = local_clock(date, column(clock), roll_2400), F.col("_place_zone")
    marked = [] if mark is None else [local_time_fit(local, place_zone).alias(mark)]
    kept = [column(c) for c in df.columns if c not in (out, mark)]
    return zoned.select(*kept, *marked, to_utc(local, place_zone, doubled, skipped).alias(out))
