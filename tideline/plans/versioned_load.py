"""Loads into versioned days: one commit, narrow repairs, successors at any distance."""

from __future__ import annotations

import math
from collections.abc import Iterable
from contextlib import ExitStack
from dataclasses import replace
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, Window, functions as F
from pyspark.sql.types import DateType, StructType

from tideline.functions.clock import gap_seconds, local_clock, rolled_day
from tideline.operators.localtime import local_to_utc
from tideline.operators.naming import column
from tideline.operators.sequence import next_event
from tideline.operators.union import align_to
from tideline.plans.config import LoadConfig
from tideline.plans.daily_load import DailyLoad, split_malformed, staged
from tideline.plans.day_store import Conflict, DayStore, State, grown
from tideline.sources.json_events import MALFORMED, SOURCE_FILE

_PART, _KNOWN, _AFTER, _FIRST, _OWN = "_part", "_known", "_after", "_first", "_own"
# A load of fewer rows than the other days hold, by this factor, has their firsts cut to its own keys
_FEW = 10


class VersionedLoad(DailyLoad):
    """Loads event files into a ``DayStore`` at ``output_path``, in any order and any number of times.

    Each day is kept in three parts. Its last timed row of each key, the ``tails``, are the only ones
    whose successor lies on another day; the other rows, the ``body``, never change unless the day is
    loaded again. ``firsts`` holds the first timed row of each key, as others see it. So a load sets
    the successors within its own days by one window over its own rows, and joins tails with the
    firsts of later days by key: of other days it reads one narrow row per key, and rewrites the tails
    of those days in which one has changed. All days of a load come into force at once.

    With ``delay`` rows of one file may belong to several days. A load replaces what its files gave
    to any day, and the rows that other files gave to these days stay.

    Loads may run at the same time: one that finds a commit made in between sets its tails again.
    """

    any_distance = True

    def __init__(self, config: LoadConfig, zones: DataFrame):
        super().__init__(config, zones)
        if config.output_path is None:
            raise ValueError("output_path must name the folder of the store")
        self.store = DayStore(self.spark, config.output_path, config.day)

    def table(self, days: Iterable[date] | None = None) -> DataFrame | None:
        """Rows in force, of some days or of all; None before the first load."""
        return self.store.rows(days)

    @property
    def _source(self) -> str:
        """The column with the day of a row's file."""
        return self.config.source_day if self.config.delay else self.config.day

    def load(self, events: DataFrame, days: Iterable[date] | None = None) -> list[date]:
        """Load flat, typed rows; gives the days that were written.

        ``days`` are those of the files. Rows of other files' days are refused, as are rows without a
        day; without ``days`` the rows are taken to be all there is of the files' days among them.
        """
        c = self.config
        if not isinstance(events.schema[c.day].dataType, DateType):
            raise TypeError(f"{c.day} must be a date")
        with ExitStack() as stages:
            if c.delay:
                really = F.when(
                    local_clock(column(c.day), column(c.clock)).isNotNull(),
                    rolled_day(column(c.day), column(c.clock), column(c.delay)),
                ).otherwise(column(c.day))
                events = events.withColumns({c.source_day: column(c.day), c.day: really})
            batch = stages.enter_context(staged(local_to_utc(
                events, self.zones, c.key, c.day, c.clock, c.time,
                roll_2400=c.roll_2400, rows_per_task=c.rows_per_task,
            )))
            bad = None
            if MALFORMED in batch.columns:
                files = batch.select(column(SOURCE_FILE).alias("file"))
                batch, bad = split_malformed(batch, self._source)
                bad = self._store_malformed(bad, files)
            found = self._measure(batch)
            if any(r.s is None for r in found):
                raise ValueError(f"rows without {c.day} belong to no day of the table")
            sources = {r.s for r in found}
            stray = set() if days is None else sources - set(days)
            if stray:
                raise ValueError(f"rows of other days: {', '.join(map(str, sorted(stray)))}")
            return self._replace(batch, found, sources, bad)

    def _measure(self, rows: DataFrame) -> list[Row]:
        """Counts and times by day and day of the file, from narrow columns."""
        c, time = self.config, F.unix_micros(column(self.config.time))
        return rows.groupBy(column(c.day).alias("d"), column(self._source).alias("s")).agg(
            F.count("*").alias("n"), F.count_if(time.isNull()).alias("untimed"), F.min(time).alias("a"), F.max(time).alias("z")
        ).collect()

    def _store_malformed(self, bad: DataFrame, files: DataFrame) -> tuple[dict[date, str], dict[str, str], set[str]]:
        """Folders of malformed records by day and by file, and the files of the load once listed by file."""
        bad = bad.withColumnRenamed("day", self.config.day)
        day, known = column(self.config.day), self.store.state().undated
        read = {r.file for r in files.where(F.col("file").isin(list(known))).distinct().collect()} if known else set()
        of = {r[0] for r in bad.select(day).distinct().collect()}
        dated, undated = {}, {}
        if of - {None}:
            version = self.store.write(bad.where(day.isNotNull()), "malformed")
            dated = {d: f"{version}/{self.config.day}={d}" for d in of if d}
        if None in of:
            folder, lost = self.store.new_version("undated"), bad.where(day.isNull()).select("file", "text")
            lost.write.parquet(f"{self.store.root}/{folder}")
            undated = {r.file: folder for r in lost.select("file").distinct().collect()}
        return dated, undated, read

    def _replace(
        self, batch: DataFrame, found: list[Row], sources: set[date],
        bad: tuple[dict[date, str], dict[str, str], set[str]] | None,
    ) -> list[date]:
        base = self.store.state()
        written = None
        while True:
            if written is None or self._contributions(base, sources) != given:
                given = self._contributions(base, sources)
                written = self._write_days(batch, found, sources, base)
            schema, entries, firsts = written
            if base.schema is not None and entries:
                schema = grown(base.schema, schema, self.config.day)
            tails, reopened, changed = self._link(base, schema, entries, firsts)
            state_days = dict(base.days)
            for d, entry in entries.items():
                state_days.pop(d, None)
                if entry["rows"]:
                    state_days[d] = entry | {"tails": entry["raw"] and f"{tails}/{self.config.day}={d}", "open": reopened.get(d, 0)}
            for d in changed:
                state_days[d] = state_days[d] | {"tails": f"{tails}/{self.config.day}={d}", "open": reopened.get(d, 0)}
            malformed = {d: f for d, f in base.malformed.items() if d not in sources}
            undated = dict(base.undated)
            if bad is not None:
                malformed |= bad[0]
                undated = {f: v for f, v in undated.items() if f not in bad[2]} | bad[1]
            wanted = replace(base, days=state_days, schema=schema, malformed=malformed, undated=undated)
            if wanted == base:
                return []
            try:
                self.store.commit(base, wanted)
                return sorted({*entries, *changed})
            except Conflict:
                base = self.store.state()

    def _contributions(self, base: State, sources: set[date]) -> dict[date, Any]:
        """Days that hold rows of these files, and the folders from which others' rows are kept."""
        if not self.config.delay:
            return {}
        own = {str(s) for s in sources}
        return {d: (e["body"], e["raw"], e["sources"]) for d, e in base.days.items() if own & set(e["sources"])}

    def _write_days(
        self, batch: DataFrame, found: list[Row], sources: set[date], base: State
    ) -> tuple[StructType, dict[date, dict[str, Any]], DataFrame | None]:
        """Bodies, tails without successors and firsts of all days that get or lose rows.

        Gives the schema, what the state is to say of each of these days, and their firsts.
        """
        c = self.config
        rows, affected = batch, {r.d for r in found} | set(self._contributions(base, sources))
        if c.delay:
            # Other files gave rows to these days as well.
            kept = [d for d in affected if d in base.days and set(base.days[d]["sources"]) - {str(s) for s in sources}]
            others = self.store.read(base.folders(("body", "raw"), kept), base.schema) if kept else None
            if others is not None:
                schema = grown(base.schema, batch.schema, c.day)
                schema = StructType([f for f in schema.fields if f.name not in c.next_columns])
                others = others.where(~column(self._source).isin(sorted(sources)))
                rows = align_to(batch, schema).unionByName(align_to(others, schema))
                found = self._measure(rows)
        if not affected:
            return base.schema, {}, None
        total = sum(r.n for r in found)
        limit = c.rows_per_task if c.rows_per_task is not None and total > c.rows_per_task else None
        placed = next_event(rows, [c.key, c.day], c.time, c.carry, c.gap, c.tie_break, True, rows_per_task=limit)
        schema = grown(base.schema, placed.schema, c.day)
        is_last = column(c.time).isNotNull() & column(c.next_columns[0]).isNull()
        placed = placed.withColumn(_PART, F.when(is_last, "raw").otherwise("body"))
        if len(affected) > 2:
            placed = placed.hint("rebalance", c.day)
        version = self.store.write(placed, "days", _PART)

        parts = {d: set(self.store.names(f"{version}/{c.day}={d}")) for d in affected}
        entries: dict[date, dict[str, Any]] = {}
        for d in sorted(affected):
            mine = [r for r in found if r.d == d]
            folder = {p: f"{version}/{c.day}={d}/{_PART}={p}" for p in ("body", "raw") if f"{_PART}={p}" in parts[d]}
            entries[d] = {
                "body": folder.get("body"), "raw": folder.get("raw"), "tails": None, "firsts": None,
                "sources": sorted({str(r.s) for r in mine}), "rows": sum(r.n for r in mine),
                "null_times": sum(r.untimed for r in mine), "open": 0,
                "first": min((r.a for r in mine if r.a is not None), default=None),
                "last": max((r.z for r in mine if r.z is not None), default=None),
            }
        if not any(e["raw"] for e in entries.values()):
            return schema, entries, None
        # From narrow columns of what was written.
        stored = self.spark.read.schema(placed.schema).parquet(f"{self.store.root}/{version}")
        order = list(dict.fromkeys([c.time, *c.tie_break, *c.carry]))
        least = F.min(F.struct(*[column(n) for n in order]))
        seen = stored.where(column(c.time).isNotNull()).groupBy(column(c.key), column(c.day)).agg(least.alias("_row"))
        firsts = seen.select(
            column(c.key), *[F.col("_row").getField(n).alias(name) for n, name in self._follower.items()], column(c.day)
        )
        folder = self.store.write(firsts, "firsts")
        for d, entry in entries.items():
            entry["firsts"] = entry["raw"] and f"{folder}/{c.day}={d}"
        return schema, entries, self.store.read([e["firsts"] for e in entries.values() if e["firsts"]], firsts.schema)

    @property
    def _follower(self) -> dict[str, str]:
        """What a row tells its predecessor, and the names that has there."""
        c = self.config
        return {c.time: c.next_columns[0], **c.carry}

    def _link(
        self, base: State, schema: StructType, entries: dict[date, dict[str, Any]], firsts: DataFrame | None
    ) -> tuple[str, dict[date, int], list[date]]:
        """Tails with their successors: of the days written, and of other days whose successors change.

        Gives the version they are stored as, how many have none by day, and the other days.
        """
        c = self.config
        if schema is None:
            return "", {}, []  # nothing was loaded yet, and nothing is now
        names = list(self._follower.values())
        narrow = StructType([f for f in schema.fields if f.name in (c.key, c.day, *names)])
        reach = c.lookback_days if c.lookback_days is not None else math.inf
        others = [d for d in base.days if d not in entries and any(abs((d - e).days) <= reach for e in entries)]
        # Days whose tails can have, or have had, a successor on a day that was written.
        earlier = [d for d in others if any(0 < (e - d).days <= reach for e in entries)]
        near = self.store.read(base.folders(["firsts"], others), narrow) if base.schema else None
        timeline = None if firsts is None else firsts.select(*[column(n) for n in narrow.fieldNames()])
        if near is not None:
            if c.lookback_days is None and self._few(base, entries, others):
                # Only keys of the days that were written, now or before, can get another successor.
                lost = self.store.read(base.folders(["firsts"], list(entries)), narrow)
                keys = [f.select(column(c.key).alias("_k")) for f in (timeline, lost) if f is not None]
                if not keys:
                    return "", {}, []
                keys = keys[0] if len(keys) == 1 else keys[0].union(keys[1])
                near = near.join(keys.distinct(), column(c.key) == F.col("_k"), "left_semi")
            timeline = near if timeline is None else timeline.unionByName(near)
        if timeline is None:
            return "", {}, []

        changed = []
        stored = self.store.read(base.folders(["tails"], earlier), narrow) if near is not None else None
        if stored is not None and len(earlier) == 1 and base.days.keys().isdisjoint(entries):
            # Next to a day that is new, the day before is as good as sure to change.
            changed = earlier
        elif stored is not None:
            differs = F.lit(False)
            for n in names:
                differs = differs | ~column(n).eqNullSafe(F.col(_AFTER).getField(n))
            followed = self._followed(stored, timeline)
            changed = sorted(r[0] for r in followed.where(F.col(_KNOWN) & differs).select(column(c.day)).distinct().collect())
        changed = [d for d in changed if base.days[d]["tails"]]
        tails = [e["raw"] for e in entries.values() if e["raw"]] + base.folders(["tails"], changed)
        if not tails:
            return "", {}, []
        rows = self._followed(self.store.read(tails, schema), timeline)
        # Counted while they are written; a day of many goes by its place in the list.
        days = [*(d for d, e in entries.items() if e["raw"]), *changed]
        seen, open_ = Observation(), column(c.next_columns[0]).isNull()
        counts = [F.count_if(open_ & (column(c.day) == F.lit(d))).alias(f"d{i}") for i, d in enumerate(days)]
        version = self.store.write(rows.select(*self._set(schema)).observe(seen, *counts), "tails")
        found = seen.get
        return version, {d: found[f"d{i}"] for i, d in enumerate(days)}, changed

    def _few(self, base: State, entries: dict[date, dict[str, Any]], others: list[date]) -> bool:
        """Whether the days that were written are few beside the others, so that their keys may be too."""
        written = sum(e["rows"] + base.days.get(d, {"rows": 0})["rows"] for d, e in entries.items())
        return written * _FEW < sum(base.days[d]["rows"] for d in others)

    def _followed(self, tails: DataFrame, timeline: DataFrame) -> DataFrame:
        """``tails`` with the row of ``timeline`` that comes next (``_after``, none if too far), and
        whether the timeline has their key and day (``_known``).

        Both lie in one frame, so rows move once: by key, later days first, a tail before the first
        row of its own day.
        """
        c = self.config
        key, day = column(c.key), column(c.day)
        first = F.struct(day.alias("d"), *[column(n) for n in self._follower.values()]).alias(_FIRST)
        firsts = timeline.select(key, day, first)
        both = tails.withColumn(_FIRST, F.lit(None).cast(firsts.schema[_FIRST].dataType)).unionByName(
            firsts, allowMissingColumns=True
        )
        by_key = Window.partitionBy(key).orderBy(day.desc(), F.col(_FIRST).isNotNull())
        later = by_key.rowsBetween(Window.unboundedPreceding, -1)
        both = both.withColumns({
            _AFTER: F.last(F.col(_FIRST), ignorenulls=True).over(later), _OWN: F.lead(F.col(_FIRST)).over(by_key),
        })
        known = key.isNotNull() & F.coalesce(F.col(_OWN).getField("d") == day, F.lit(False))
        within = F.lit(True) if c.lookback_days is None else F.date_diff(F.col(_AFTER).getField("d"), day) <= c.lookback_days
        return both.where(F.col(_FIRST).isNull()).select(
            *[column(n) for n in tails.columns], F.when(within, F.col(_AFTER)).alias(_AFTER), known.alias(_KNOWN)
        )

    def _set(self, schema: StructType) -> list[Column]:
        """The columns of ``schema``, successors taken from ``_after`` where the key is known."""
        c, names = self.config, set(self._follower.values())
        known = F.col(_KNOWN)
        set_to = {n: F.when(known, F.col(_AFTER).getField(n)).otherwise(column(n)) for n in names}
        set_to[c.gap] = F.when(
            known, gap_seconds(F.col(_AFTER).getField(c.next_columns[0]), column(c.time))
        ).otherwise(column(c.gap))
        return [set_to.get(f.name, column(f.name)).alias(f.name) for f in schema.fields]
