"""The next event of the same key, and the gap to it."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tideline.functions.clock import gap_seconds
from tideline.operators.naming import as_list, column, has_order
from tideline.operators.skew import ROWS_PER_TASK, busy_keys, key_matches
from tideline.session import shared_folder

# Groups that rows without a time are dealt out over
_UNTIMED_GROUPS = 65_536

# Rows of a busy key that are looked at for each range it is cut into
_SAMPLES = 32
# Ranges whose first events may be broadcast
_BROADCAST_HEADS = 200_000
# Stands for a row without a time, which comes before all others
_FIRST = -(2**63)

_NEXT, _HEAD, _SEGMENT, _POSITION, _APART = "_next", "_head", "_segment", "_position", "_apart"
_CUTS, _HEAPS, _PIECE = "_cuts", "_heaps", "_piece"


def next_event(
    df: DataFrame,
    partition_by: str | Iterable[str] = "Origin",
    order_by: str = "FlightTime",
    carry: Mapping[str, str] | None = None,
    gap: str = "diff_next",
    tie_break: Iterable[str] = (),
    skip_null_times: bool = False,
    day: str | None = None,
    max_day_gap: int | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``<order_by>_next``, the carried columns and the gap in seconds.

    ``carry`` maps a column of the next row to the name it gets here. Rows
    without a time come first, like any null in ascending order; with
    ``skip_null_times`` they neither have nor are a successor. With ``day``
    and ``max_day_gap`` a successor more days away than that is none.

    Rows of one time are ordered by ``tie_break``, then the carried columns, then all
    other columns that have an order, as the frame lists them, nulls first. So the
    answer does not depend on where rows lie; rows that still tie are alike.

    Keys are counted first (one narrow pass, partial counts before the
    shuffle). Keys with more than ``rows_per_task`` rows are cut into ranges
    of time at the quantiles of a sample, and the others are dealt out over so many tasks that one
    gets about ``rows_per_task`` rows; ``None`` leaves out the count and never cuts. As the rows are
    read more than once, give stored rows rather than a long computation.
    """
    keys = as_list(partition_by)
    carry = {"Reporting_Airline": "Airline_next"} if carry is None else dict(carry)
    made = [f"{order_by}_next", *carry.values(), gap]
    ordered = [f.name for f in df.schema.fields if f.name not in made and has_order(f.dataType)]
    ties = [c for c in dict.fromkeys([*tie_break, *carry, *ordered]) if c not in (*keys, order_by)]
    base = df.select(*[column(c) for c in df.columns if c not in made])
    follower = _follower(order_by, carry, day)
    order = [column(c).asc_nulls_first() for c in [order_by, *ties]]

    groups, rows = keys, base
    if skip_null_times:
        # Rows without a time belong to no sequence; they are dealt out over
        # many groups of their own, so that they are nobody's burden.
        content = F.xxhash64(*[column(c) for c in [*keys, *ties, *carry]])
        apart = F.when(column(order_by).isNull(), F.pmod(content, F.lit(_UNTIMED_GROUPS)))
        rows = base.withColumn(_APART, apart)
        groups = [*keys, _APART]
    busy, total = busy_keys(rows, groups, rows_per_task)
    tasks = math.ceil(total / rows_per_task) if rows_per_task else 0
    if busy is None:
        found = _by_key(rows, groups, order, follower, tasks)
    else:
        # What a row hands on depends on these alone, unless its day does not.
        telling = list(dict.fromkeys([*tie_break, *carry]))
        if day is not None and day not in (*groups, order_by, *telling):
            telling = ties
        found = _with_busy_keys(rows, groups, order_by, ties, telling, order, follower, busy, rows_per_task, tasks)
    return _unpack(found, base.columns, order_by, carry, gap, skip_null_times, day, max_day_gap)


def _by_key(
    df: DataFrame, keys: list[str], order: list[Column], follower: Column, tasks: int
) -> DataFrame:
    """The follower of each row by a plain window, in ``tasks`` tasks if Spark would take fewer."""
    key_columns = [column(k) for k in keys]
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(tasks, *key_columns)  # which the window uses, so it is no extra shuffle
    return df.withColumn(_NEXT, F.lead(follower).over(Window.partitionBy(*key_columns).orderBy(*order)))


def _follower(order_by: str, carry: Mapping[str, str], day: str | None) -> Column:
    parts = [column(order_by).alias("time")]
    parts += [column(c).alias(f"c{i}") for i, c in enumerate(carry)]
    if day is not None:
        parts.append(column(day).alias("day"))
    return F.struct(*parts)


def _unpack(
    found: DataFrame,
    columns: list[str],
    order_by: str,
    carry: Mapping[str, str],
    gap: str,
    skip_null_times: bool,
    day: str | None,
    max_day_gap: int | None,
) -> DataFrame:
    successor = F.col(_NEXT)
    if skip_null_times:
        successor = F.when(column(order_by).isNotNull(), successor)
    if day is not None and max_day_gap is not None:
        days_away = F.date_diff(successor.getField("day"), column(day))
        successor = F.when(days_away <= max_day_gap, successor)
    time_next = successor.getField("time")
    return found.select(
        *[column(c) for c in columns],
        time_next.alias(f"{order_by}_next"),
        *[successor.getField(f"c{i}").alias(name) for i, name in enumerate(carry.values())],
        gap_seconds(time_next, column(order_by)).alias(gap),
    )


def _with_busy_keys(
    df: DataFrame,
    keys: list[str],
    order_by: str,
    ties: list[str],
    telling: list[str],
    order: list[Column],
    follower: Column,
    busy: DataFrame,
    rows_per_task: int,
    tasks: int,
) -> DataFrame:
    """One window over (key, range of time); the first event of each range is handed to the one before.

    Which range a row is in follows from its own columns and the cuts, which are known before rows
    move, so a task that is run again finds the same one. Only times that fill ranges on their own
    are cut by position.
    """
    value = F.coalesce(F.unix_micros(column(order_by)), F.lit(_FIRST))
    cuts, most, total, any_heap = _cuts(df, keys, value, busy, rows_per_task)
    placed = df.join(F.broadcast(cuts), key_matches(keys), "left").withColumn(
        _SEGMENT, F.when(F.col(_CUTS).isNotNull(), _cuts_below(value, most)).otherwise(F.lit(0))
    )
    grouped = [*keys, _SEGMENT]
    kept = [column(c) for c in [*df.columns, _SEGMENT]]
    is_heap = F.coalesce(F.array_contains(_HEAPS, F.col(_SEGMENT)), F.lit(False))
    ranged = placed.where(~is_heap) if any_heap else placed
    found = _by_key(ranged.select(*kept), grouped, order, follower, max(tasks, total)).select(*kept, _NEXT)
    if any_heap:
        heaps = placed.where(is_heap).select(*kept)
        pieces = max(2, math.ceil(2 * heaps.count() / rows_per_task))
        found = found.unionByName(_cut_by_position(heaps, grouped, order_by, ties, order, follower, pieces))

    # First event of each range: one row per range, from narrow columns.
    place = F.struct(column(order_by), *[column(t) for t in telling])
    heads = (
        placed.where(F.col(_CUTS).isNotNull())
        .groupBy(*[column(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(_SEGMENT).alias("_s"))
        .agg(F.min_by(follower, place).alias("_first"))
    )
    by_key = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_s")
    heads = heads.withColumn(_HEAD, F.lead("_first").over(by_key)).drop("_first")
    if total <= _BROADCAST_HEADS:
        heads = F.broadcast(heads)
    return found.join(heads, key_matches(keys) & (F.col(_SEGMENT) == F.col("_s")), "left").select(
        *[column(c) for c in df.columns], F.coalesce(_NEXT, _HEAD).alias(_NEXT)
    )


def _cuts(
    df: DataFrame, keys: list[str], value: Column, busy: DataFrame, rows_per_task: int
) -> tuple[DataFrame, int, int, bool]:
    """Cuts of each busy key, the most that a key has, the number of all ranges, and if any is a heap.

    ``_cuts`` are the values at which a range begins, ``_heaps`` the numbers of ranges that hold a
    single value with more rows than a range should have. About two ranges a task, so at most
    2 * rows / rows_per_task numbers come to the driver, and as many samples for each as _SAMPLES.
    """
    marks = [f"_k{i}" for i in range(len(keys))]
    share = min(1.0, _SAMPLES * 2 / rows_per_task)
    ranges = F.ceil(2 * F.col("_rows") / rows_per_task).cast("int")
    sampled = df.join(F.broadcast(busy), key_matches(keys)).where(F.rand(7) < share)
    quantiles = (
        sampled.groupBy(*marks).agg(F.sort_array(F.collect_list(value)).alias("v"), F.max(ranges).alias("n"))
        .select(*marks, F.transform(
            F.sequence(F.lit(1), F.col("n") - 1),
            lambda i: F.get("v", F.floor(i.cast("bigint") * F.size("v") / F.col("n")).cast("int")),
        ).alias("q"))
    )
    rows, most, total = [], 1, 0
    for r in quantiles.collect():
        times = Counter(r["q"])
        heavy = [t for t, n in times.items() if n > 1]
        cuts = sorted({t + 1 for t in times} | set(heavy))
        rows.append((*[r[m] for m in marks], cuts, [bisect_right(cuts, t) for t in heavy]))
        most, total = max(most, len(cuts)), total + len(cuts) + 1
    kinds = [StructField(m, busy.schema[m].dataType) for m in marks]
    kinds += [StructField(_CUTS, ArrayType(LongType())), StructField(_HEAPS, ArrayType(IntegerType()))]
    return df.sparkSession.createDataFrame(rows, StructType(kinds)), most, total, any(r[-1] for r in rows)


def _cuts_below(value: Column, most: int) -> Column:
    """How many of the sorted ``_cuts`` are at most ``value``, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(most.bit_length() - 1, -1, -1)])
    fits = lambda at: (at <= F.size(_CUTS)) & (F.get(_CUTS, at - 1) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(fits(at + step), step).otherwise(F.lit(0)))


def _cut_by_position(
    df: DataFrame,
    keys: list[str],
    order_by: str,
    ties: list[str],
    order: list[Column],
    follower: Column,
    pieces: int,
) -> DataFrame:
    """``_next`` within each key, for heaps of rows that no value of a column need tell apart."""
    shared_folder(df.sparkSession)
    key_columns = [column(k) for k in keys]
    # The position tells equal rows apart, so even a heap of copies can be
    # cut. It is stored before rows move by it: a task that is run again must
    # find the same one. So is the range, whose bounds Spark samples.
    pinned = (
        df.withColumn(_POSITION, F.monotonically_increasing_id()).checkpoint()
        .repartitionByRange(pieces, *key_columns, *order, F.col(_POSITION))
        .withColumn(_PIECE, F.spark_partition_id())
        .checkpoint()
    )
    place = F.struct(column(order_by), *[column(t) for t in ties], F.col(_POSITION))
    by_key = Window.partitionBy(*[f"_h{i}" for i in range(len(keys))]).orderBy("_p")
    heads = (
        pinned.groupBy(*[column(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.col(_PIECE).alias("_p"))
        .agg(F.min_by(follower, place).alias("_first"))
        .withColumn(_HEAD, F.lead("_first").over(by_key))
        .drop("_first")
    )
    matches = F.col(_PIECE) == F.col("_p")
    for i, k in enumerate(keys):
        matches = matches & column(k).eqNullSafe(F.col(f"_h{i}"))
    within = Window.partitionBy(*key_columns, F.col(_PIECE)).orderBy(*order, F.col(_POSITION))
    # As many tasks as pieces, or the shuffle for the window would put them together again.
    return (
        pinned.repartition(pieces, *key_columns, F.col(_PIECE))
        .withColumn(_NEXT, F.lead(follower).over(within))
        .join(heads, matches, "left")
        .select(*[column(c) for c in df.columns], F.coalesce(_NEXT, _HEAD).alias(_NEXT))
    )
