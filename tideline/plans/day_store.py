"""Days of events in versioned folders, replaced together by one commit record.

Nothing that a reader may be reading is ever written again: each load writes folders of its own, and
a commit record names, for every day, the folders that are in force. Records are numbered and
created only if their number is free, so of two loads that saw the same state one has to look again.
A writer that is lost before its record leaves the old days as they were.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tideline.operators.naming import column
from tideline.records import Conflict, Records

_COMMITS = "_commits"


@dataclass(frozen=True)
class State:
    """What is in force: of each day its folders (relative to the root) and its counts."""

    number: int = 0
    days: dict[date, dict[str, Any]] = field(default_factory=dict)
    schema: StructType | None = None
    #: Folders of malformed records, by the day of their file; by file, where it holds nothing else.
    malformed: dict[date, str] = field(default_factory=dict)
    undated: dict[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "days": {str(d): entry for d, entry in sorted(self.days.items())},
            "schema": self.schema.jsonValue() if self.schema else None,
            "malformed": {str(d): folder for d, folder in sorted(self.malformed.items())},
            "undated": self.undated,
        })

    @staticmethod
    def from_json(number: int, text: str) -> State:
        found = json.loads(text)
        return State(
            number, {date.fromisoformat(d): e for d, e in found["days"].items()},
            StructType.fromJson(found["schema"]) if found["schema"] else None,
            {date.fromisoformat(d): folder for d, folder in found["malformed"].items()}, found["undated"],
        )

    def folders(self, parts: Iterable[str], days: Iterable[date] | None = None) -> list[str]:
        """Folders of some parts of the days, or of all days."""
        wanted = self.days if days is None else [d for d in days if d in self.days]
        return [f for d in sorted(wanted) for p in parts if (f := self.days[d].get(p))]

    def versions(self) -> set[str]:
        """All versions that the state names."""
        named = [*self.malformed.values(), *self.undated.values()]
        named += [f for e in self.days.values() for p in ("body", "raw", "tails", "firsts") if (f := e.get(p))]
        return {"/".join(f.split("/")[:2]) for f in named}


class DayStore:
    """A folder that holds days of rows; ``day`` names their date column."""

    def __init__(self, spark: SparkSession, root: str, day: str = "FlightDate"):
        self.spark, self.root, self.day = spark, root.rstrip("/"), day
        self.commits = Records(spark, f"{self.root}/{_COMMITS}")

    # Commit records

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, given relative to the root; nothing if there is no such folder."""
        files, path = self._files(), self._path(folder)
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def state(self) -> State:
        """The state after the last commit."""
        numbers = self.commits.numbers()
        return self._record(numbers[-1]) if numbers else State()

    def _record(self, number: int) -> State:
        return State.from_json(number, self.commits.read(number))

    def commit(self, base: State, state: State) -> State:
        """Put ``state`` in the place of ``base``; ``Conflict`` if that is not the last one any more."""
        self.commits.put(base.number + 1, state.to_json())
        return replace(state, number=base.number + 1)

    # Rows

    def new_version(self, kind: str) -> str:
        """A folder, relative to the root, that nothing else uses."""
        return f"{kind}/version={uuid.uuid4().hex}"

    def write(self, rows: DataFrame, kind: str, *parts: str) -> str:
        """Rows as a new version, a folder per day and ``parts``; its path relative to the root."""
        version = self.new_version(kind)
        rows.write.partitionBy(self.day, *parts).parquet(f"{self.root}/{version}")
        return version

    def read(self, folders: Iterable[str], schema: StructType) -> DataFrame | None:
        """Rows of day folders, with the columns of ``schema``; None if there are no folders."""
        kinds: dict[str, list[str]] = {}
        for folder in folders:
            kinds.setdefault(folder.split("/")[0], []).append(f"{self.root}/{folder}")
        names = [f for f in schema.fields if f.name != self.day]
        whole = StructType([*names, StructField(self.day, DateType())])
        found = [
            self.spark.read.schema(whole).option("basePath", f"{self.root}/{kind}").parquet(*paths)
            for kind, paths in kinds.items()
        ]
        return reduce(DataFrame.unionByName, [f.select(*[column(n.name) for n in schema.fields]) for f in found]) if found else None

    def rows(self, days: Iterable[date] | None = None, state: State | None = None) -> DataFrame | None:
        """All rows of the days that are in force, or of some of them; only their folders are read."""
        state = self.state() if state is None else state
        if state.schema is None:
            return None
        found = self.read(state.folders(("body", "tails"), days), state.schema)
        return self.spark.createDataFrame([], state.schema) if found is None else found

    def overwrite(self, rows: DataFrame) -> list[date]:
        """Replace the days in ``rows``, all of them in one step; gives these days."""
        if not rows.where(column(self.day).isNull()).isEmpty():
            raise ValueError(f"rows without {self.day} belong to no day")
        version = self.write(rows.hint("rebalance", self.day), "days")
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{version}")
        sizes = {r[0]: r["count"] for r in stored.groupBy(column(self.day)).count().collect()}
        entries = {
            d: {"body": f"{version}/{self.day}={d}", "raw": None, "tails": None, "firsts": None, "sources": [str(d)],
                "rows": n, "null_times": 0, "open": 0, "first": None, "last": None}
            for d, n in sizes.items()
        }
        while entries:
            base = self.state()
            schema = grown(base.schema, rows.schema, self.day)
            try:
                self.commit(base, replace(base, days=base.days | entries, schema=schema))
                break
            except Conflict:
                continue  # whole days, so the later commit holds
        return sorted(sizes)

    def malformed(self) -> DataFrame:
        """Malformed records of the loads in force: file, day, text."""
        state, kind = self.state(), "file string, text string, day date"
        schema = StructType.fromDDL(kind.replace("day date", f"`{self.day}` date"))
        found = self.read([state.malformed[d] for d in sorted(state.malformed)], schema)
        out = self.spark.createDataFrame([], kind) if found is None else found.toDF("file", "text", "day")
        for folder in sorted(set(state.undated.values())):
            files = [f for f, v in state.undated.items() if v == folder]
            lost = self.spark.read.schema("file string, text string").parquet(f"{self.root}/{folder}")
            out = out.unionByName(lost.where(F.col("file").isin(files)).withColumn("day", F.lit(None).cast("date")))
        return out

    def report(self) -> DataFrame:
        """One row per day: rows, null times, null successors, first and last time, from the record."""
        state = self.state()
        at = lambda micros: F.timestamp_micros(F.col(micros))
        entries = [
            (d, e["rows"], e["null_times"], e["null_times"] + e["open"], e["first"], e["last"])
            for d, e in sorted(state.days.items())
        ]
        counted = self.spark.createDataFrame(
            entries, "d date, rows bigint, null_times bigint, null_next bigint, a bigint, z bigint"
        )
        return counted.select(
            F.col("d").alias(self.day), "rows", "null_times", "null_next",
            at("a").alias("first_time"), at("z").alias("last_time"),
        )

    def clean(self, keep: int = 2, older_than: float = 7 * 86_400) -> int:
        """Delete versions that none of the last ``keep`` records names, and older records.

        Folders changed less than ``older_than`` seconds ago stay, as a load may be at work on them.
        Gives the number of versions deleted.
        """
        files, limit = self._files(), (time.time() - older_than) * 1000
        numbers = self.commits.numbers()
        used: set[str] = set()
        for number in numbers[-keep:]:
            used |= self._record(number).versions()
        deleted = 0
        for kind in files.listStatus(self._path()):
            if kind.getPath().getName() == _COMMITS or not kind.isDirectory():
                continue
            for version in files.listStatus(kind.getPath()):
                name = f"{kind.getPath().getName()}/{version.getPath().getName()}"
                if name not in used and version.getModificationTime() < limit:
                    files.delete(version.getPath(), True)
                    deleted += 1
        for number in numbers[:-keep]:
            self.commits.delete(number)
        return deleted


def grown(old: StructType | None, new: StructType, day: str) -> StructType:
    """The old columns, then those that are new, the day last."""
    fields = {f.name: f for f in [*(old.fields if old else []), *new.fields]}
    last = fields.pop(day)
    return StructType([*fields.values(), last])

