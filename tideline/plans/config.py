"""Settings of a daily load."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from pyspark.sql.types import StructType

from tideline.operators.projection import ColumnSpec
from tideline.operators.localtime import BROADCAST_ROWS
from tideline.operators.skew import ROWS_PER_TASK


@dataclass(frozen=True)
class LoadConfig:
    """What to read, which columns play which part, and where to write.

    ``lookback_days`` is how many days later a successor may be; 1 repairs
    the previous day only, None sets no limit. ``delay`` names a column with minutes behind schedule: a
    row is then stored under the day it really left on, with the day of its file in ``source_day``.
    ``VersionedLoad`` knows the last two, ``DailyLoad`` does not. ``output_partitions`` aims at a number of write
    tasks; None leaves it to the size of the data. ``output_path`` makes the
    table an external one at its first load.
    """

    columns: tuple[ColumnSpec, ...]
    output_table: str
    output_partitions: int | None = None
    output_path: str | None = None
    lookback_days: int | None = 1
    # Fixed names of the flight record
    key: str = "Origin"
    day: str = "FlightDate"
    clock: str = "DepTime"
    time: str = "FlightTime"
    carry: Mapping[str, str] = field(default_factory=lambda: {"Reporting_Airline": "Airline_next"})
    gap: str = "diff_next"
    zone_code: str = "iata_code"
    zone_name: str = "iana_tz"
    # Order of events at the same minute
    tie_break: tuple[str, ...] = ()
    roll_2400: bool = False
    delay: str | None = None
    source_day: str = "SourceDate"
    on_error: str = "null"
    multiline: bool = False
    # How nested records are flattened
    outer: bool = False
    maps: str = "keep"
    on_duplicate: str = "error"
    json_schema: StructType | str | None = None
    # Folder of the schema of all files so far, for files whose fields and types change
    schema_folder: str | None = None
    # Largest lookup to broadcast, and most rows of one key in a single task
    broadcast_rows: int = BROADCAST_ROWS
    rows_per_task: int | None = ROWS_PER_TASK

    def __post_init__(self) -> None:
        if self.lookback_days is not None and self.lookback_days < 0:
            raise ValueError("lookback_days must not be negative")

    @property
    def next_columns(self) -> list[str]:
        return [f"{self.time}_next", *self.carry.values(), self.gap]

    @classmethod
    def from_dict(cls, settings: Mapping[str, Any], **more: Any) -> LoadConfig:
        """From a config mapping with any of the settings above; ``more`` wins.

        ``data_columns`` declares the columns. Other entries are refused, but for
        ``EXECUTION_ENVIRONMENT``, which says nothing about a load.
        """
        names = {f.name for f in fields(cls)} - {"columns"}
        unknown = set(settings) - names - {"data_columns", "EXECUTION_ENVIRONMENT"}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        known = {k: v for k, v in settings.items() if k in names}
        if "tie_break" in known:
            known["tie_break"] = tuple(known["tie_break"])
        specs = tuple(ColumnSpec.from_dict(entry) for entry in settings["data_columns"])
        return cls(**({"columns": specs} | known | more))

    @classmethod
    def from_file(cls, path: str, **more: Any) -> LoadConfig:
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")), **more)
