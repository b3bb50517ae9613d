"""Loading days of events, and repairing the days around them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import ExitStack, contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, StructType

from tideline.operators.localtime import local_to_utc, zone_lookup
from tideline.operators.naming import column
from tideline.operators.quality import first_per_key
from tideline.operators.sequence import next_event
from tideline.operators.union import align_to
from tideline.plans.config import LoadConfig
from tideline.plans.partitions import evolved_schema, overwrite_days
from tideline.session import check_session, new_table
from tideline.sources.drift import SchemaStore
from tideline.sources.json_events import MALFORMED, SOURCE_FILE, read_events_json
from tideline.sources.tables import day_slice, neighbouring_days

_CONTEXT = "_context"


@contextmanager
def staged(df: DataFrame, label: str = "batch", keep: bool = False) -> Iterator[DataFrame]:
    """The rows of ``df`` as a table of their own while the block runs.

    With ``keep`` the table stays if the block fails, and the error names it.
    """
    spark = df.sparkSession
    table = new_table(spark, label)
    try:
        df.write.format("parquet").saveAsTable(table)
        yield spark.read.table(table)
    except BaseException as error:
        if keep:
            error.add_note(f"rows as they were before are in {table}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def split_malformed(rows: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows of a read with ``on_error="store"``, and its malformed records.

    The latter are (file, day, text); the day is the first one of their file's other rows, if any.
    """
    marked = rows.where(column(MALFORMED).isNotNull()).select(
        column(SOURCE_FILE).alias("file"), column(MALFORMED).alias("text")
    )
    good = rows.where(column(MALFORMED).isNull())
    days = good.groupBy(column(SOURCE_FILE).alias("file")).agg(F.min(column(day)).alias("day"))
    return good.drop(MALFORMED, SOURCE_FILE), marked.join(days, "file", "left").select("file", "day", "text")


class DailyLoad:
    """Loads event files into the output table, in any order and any number of times.

    A row's successor is the next timed row of its key, if that row's day is
    at most ``lookback_days`` later. Days that are loaded are replaced whole;
    earlier days are rewritten only where a successor has changed.
    """

    any_distance = False

    def __init__(self, config: LoadConfig, zones: DataFrame):
        if not self.any_distance and (config.lookback_days is None or config.delay is not None):
            raise ValueError("lookback_days=None and delay need a VersionedLoad")
        self.config = config
        self.spark: SparkSession = zones.sparkSession
        check_session(self.spark)
        self.schemas = config.schema_folder and SchemaStore(self.spark, config.schema_folder, config.json_schema)
        self.zones = zone_lookup(
            zones, config.zone_code, config.zone_name, config.broadcast_rows, keep=True
        )

    def run(self, path: str | list[str], days: Iterable[date] | None = None) -> list[date]:
        """Load files; gives the days that were written. For ``days`` see ``load``."""
        try:
            with ExitStack() as stages:
                return self.load(self._once(self.read(path), stages), days)
        finally:
            if self.schemas:
                self.schemas.release()

    def _once(self, events: DataFrame, stages: ExitStack) -> DataFrame:
        """Parsed rows, stored first if the join with a large lookup would parse them twice."""
        return events if self.zones.small else stages.enter_context(staged(events))

    def read(self, path: str | list[str], source: str | None = None) -> DataFrame:
        """Files as flat, typed rows; ``source`` names a column for the path of each row's file."""
        c = self.config
        return read_events_json(
            self.spark, path, c.columns, c.json_schema, c.multiline, c.on_error,
            c.outer, c.maps, c.on_duplicate, source, self.schemas or None,
        )

    def load(self, events: DataFrame, days: Iterable[date] | None = None) -> list[date]:
        """Load flat, typed rows.

        Beside a lookup too large to broadcast the keys are counted first, by a narrow pass of its
        own, so give stored rows rather than a long computation.
        ``days`` are those that the rows hold whole. A row of another day would replace that
        day, so the load is refused before anything is written. Without ``days`` the rows
        are taken to be all there is of every day among them. Records that ``read`` marked as
        malformed (``on_error="store"``) are added to ``malformed_table`` first.
        """
        c = self.config
        if not isinstance(events.schema[c.day].dataType, DateType):
            raise TypeError(f"{c.day} must be a date")
        with ExitStack() as stages:
            timed = local_to_utc(
                events, self.zones, c.key, c.day, c.clock, c.time,
                roll_2400=c.roll_2400, rows_per_task=c.rows_per_task,
            )
            batch = stages.enter_context(staged(timed))
            if MALFORMED in batch.columns:
                batch, bad = split_malformed(batch, c.day)
                if not bad.isEmpty():
                    bad.withColumn("load", F.lit(uuid.uuid4().hex)).write.format("parquet").mode("append").saveAsTable(
                        self.malformed_table
                    )
            sizes = self._rows_per_day(batch)
            if None in sizes:
                raise ValueError(f"rows without {c.day} belong to no day of the table")
            stray = set() if days is None else set(sizes) - set(days)
            if stray:
                raise ValueError(f"rows of other days: {', '.join(map(str, sorted(stray)))}")
            if not sizes:
                return []
            rows, written = self._with_neighbours(batch, sizes, stages)
            # The window leaves the rows of a day in a few large pieces; only
            # a load of many days has to gather them once more.
            overwrite_days(
                rows, c.output_table, c.day, c.output_partitions, c.output_path,
                spread=len(written) > 2,
            )
        return sorted(written)

    @property
    def malformed_table(self) -> str:
        """Log of malformed records: file, day, text, load. Of a file only its last load counts."""
        return f"{self.config.output_table}_malformed"

    def _rows_per_day(self, rows: DataFrame) -> dict[date, int]:
        counted = rows.groupBy(column(self.config.day).alias("d")).agg(F.count("*").alias("n"))
        return {r.d: r.n for r in counted.collect()}

    def _with_neighbours(
        self, batch: DataFrame, sizes: dict[date, int], stages: ExitStack
    ) -> tuple[DataFrame, list[date]]:
        """Rows to write, successors set, and the days they are of."""
        c = self.config
        days = sorted(sizes)
        near = neighbouring_days(days, c.lookback_days, c.lookback_days)
        table = day_slice(self.spark, c.output_table, [*days, *near], c.day)
        if table is None:
            return self._successors(batch, sum(sizes.values())), days
        # Counts by partition: no column is read for them.
        found = self._rows_per_day(table)
        stored = table.where(column(c.day).isin([d for d in near if d in found]))
        stale = self._stale(batch, stored, days, set(found))
        ahead = [d for d in near if d in found and d not in stale]

        schema = evolved_schema(self.spark, c.output_table, batch, c.day)
        schema = StructType([f for f in schema.fields if f.name not in c.next_columns])
        rows = align_to(batch, schema)
        if stale:
            # These days are read and replaced by one job, so a copy outlives a lost driver.
            before = stored.where(column(c.day).isin(stale))
            copy = stages.enter_context(staged(before, "before", keep=True))
            rows = rows.unionByName(align_to(copy, schema))
        total = sum(sizes.values()) + sum(found[d] for d in [*stale, *ahead])
        if not ahead:
            return self._successors(rows, total), [*days, *stale]
        # Of the days that stay as they are only the first event per key can
        # be a successor; it takes part and is left out again afterwards.
        firsts = first_per_key(
            stored.where(column(c.day).isin(ahead) & column(c.time).isNotNull()).select(
                *self._sequence_columns()
            ),
            [c.key, c.day],
            list(dict.fromkeys([c.time, *c.tie_break, *c.carry])),
        )
        marked = rows.withColumn(_CONTEXT, F.lit(False)).unionByName(
            align_to(firsts, schema).withColumn(_CONTEXT, F.lit(True))
        )
        done = self._successors(marked, total).where(~F.col(_CONTEXT)).drop(_CONTEXT)
        return done, [*days, *stale]

    def _successors(self, rows: DataFrame, total: int) -> DataFrame:
        c = self.config
        limit = c.rows_per_task
        if limit is not None and total <= limit:
            limit = None  # no key can have more rows than there are
        return next_event(
            rows, c.key, c.time, c.carry, c.gap, [c.day, *c.tie_break], True,
            c.day, c.lookback_days, limit,
        )

    def _sequence_columns(self) -> list[Column]:
        c = self.config
        names = dict.fromkeys([c.key, c.day, c.time, *c.tie_break, *c.carry])
        return [column(n) for n in names]

    def _stale(
        self, batch: DataFrame, stored: DataFrame, days: list[date], found: set[date]
    ) -> list[date]:
        """Stored earlier days in which a successor changes."""
        earlier = [d for d in neighbouring_days(days, self.config.lookback_days, 0) if d in found]
        if not earlier or (len(earlier) == 1 and found.isdisjoint(days)):
            # Next to a day that is new, the day before is as good as sure to change.
            return earlier
        # No other day can follow one of these, so the rest of the load is not ordered for it.
        near = [*earlier, *neighbouring_days(earlier, 0, self.config.lookback_days)]
        at_hand = column(self.config.day).isin(near)
        changed = self._changed(batch.where(at_hand), stored.where(at_hand))
        return [d for d in earlier if changed.get(d)]

    def _changed(self, batch: DataFrame, stored: DataFrame) -> dict[date, bool]:
        """Days near the batch, and whether a stored successor no longer holds.

        Only the last event of a key on a day can have its successor on
        another day, so the first and last of each key and day tell. Both are
        partial aggregates; what is ordered afterwards is one row per key and
        day of a few days.
        """
        c = self.config
        parts = ["time", *[f"c{i}" for i in range(len(c.carry))]]

        def ends_of(df: DataFrame, next_names: list[str] | None) -> DataFrame:
            own = [column(n).alias(p) for n, p in zip([c.time, *c.carry], parts)]
            after = [
                (column(n) if n else F.lit(None).cast(df.schema[m].dataType)).alias(p)
                for n, m, p in zip(next_names or [None] * len(parts), [c.time, *c.carry], parts)
            ]
            return df.where(column(c.time).isNotNull()).select(
                column(c.key).alias("k"),
                column(c.day).alias("d"),
                F.struct(*[column(n) for n in dict.fromkeys([c.time, *c.tie_break, *c.carry])]).alias("at"),
                F.struct(*own).alias("own"),
                F.struct(*after).alias("after"),
            )

        ends_day = F.coalesce(F.col("after.time") > F.col("own.time"), F.lit(True))
        ends = (
            ends_of(batch, None)
            .unionByName(ends_of(stored, c.next_columns[:-1]))
            .groupBy("k", "d")
            .agg(
                F.min_by("own", "at").alias("first"),
                # Of events tied for the last place the one that none of them follows
                F.max_by("after", F.struct(F.col(f"own.{parts[0]}"), ends_day)).alias("after"),
            )
        )
        by_day = Window.partitionBy("k").orderBy("d")
        following = ends.withColumn("f", F.lead(F.struct("d", "first")).over(by_day))
        near = F.date_diff("f.d", "d") <= c.lookback_days
        same = F.lit(True)
        for p in parts:
            same = same & F.when(near, F.col(f"f.first.{p}")).eqNullSafe(F.col(f"after.{p}"))
        report = following.groupBy("d").agg(F.max(~same).alias("changed")).collect()
        return {r.d: r.changed for r in report}
