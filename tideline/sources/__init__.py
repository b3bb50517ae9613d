from tideline.sources.drift import SchemaStore
from tideline.sources.json_events import infer_event_schema, malformed_lines, read_events_json
from tideline.sources.tables import day_slice, neighbouring_days
from tideline.sources.zones import read_zones_csv

__all__ = [
    "SchemaStore",
    "day_slice",
    "infer_event_schema",
    "malformed_lines",
    "neighbouring_days",
    "read_events_json",
    "read_zones_csv",
]
