from tideline.operators.flatten import flatten
from tideline.operators.localtime import ZoneLookup, attach_zone, local_to_utc, zone_lookup
from tideline.operators.projection import ColumnSpec, column_catalog, project_typed
from tideline.operators.quality import first_per_key, quality_report
from tideline.operators.sequence import next_event
from tideline.operators.union import align_union

__all__ = [
    "ColumnSpec",
    "ZoneLookup",
    "align_union",
    "attach_zone",
    "column_catalog",
    "first_per_key",
    "flatten",
    "local_to_utc",
    "next_event",
    "project_typed",
    "quality_report",
    "zone_lookup",
]
