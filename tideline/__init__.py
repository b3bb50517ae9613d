"""Daily event ingestion on Spark."""

from tideline.functions import gap_seconds, local_clock, local_time_fit, rolled_day, to_utc
from tideline.operators import (
    ColumnSpec,
    ZoneLookup,
    align_union,
    attach_zone,
    column_catalog,
    first_per_key,
    flatten,
    local_to_utc,
    next_event,
    project_typed,
    quality_report,
    zone_lookup,
)
from tideline.plans import DailyLoad, DayStore, LoadConfig, VersionedLoad, overwrite_days
from tideline.session import build_session, check_session, shared_folder
from tideline.sources import (
    SchemaStore,
    day_slice,
    infer_event_schema,
    malformed_lines,
    neighbouring_days,
    read_events_json,
    read_zones_csv,
)
from tideline.streaming import land_stream

__all__ = [
    "ColumnSpec",
    "DailyLoad",
    "DayStore",
    "LoadConfig",
    "SchemaStore",
    "VersionedLoad",
    "ZoneLookup",
    "align_union",
    "attach_zone",
    "build_session",
    "check_session",
    "column_catalog",
    "day_slice",
    "first_per_key",
    "flatten",
    "gap_seconds",
    "infer_event_schema",
    "land_stream",
    "local_clock",
    "local_time_fit",
    "local_to_utc",
    "neighbouring_days",
    "malformed_lines",
    "next_event",
    "overwrite_days",
    "project_typed",
    "quality_report",
    "read_events_json",
    "read_zones_csv",
    "rolled_day",
    "shared_folder",
    "to_utc",
    "zone_lookup",
]
