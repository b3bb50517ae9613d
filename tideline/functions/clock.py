"""Wall-clock and instant expressions; all of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY = 86_400


def local_clock(
    day: Column, hhmm: Column, roll_2400: bool = False, cut_long: bool = False
) -> Column:
    """Local timestamp of a date and an ``hhmm`` integer such as 5, 734 or 1535.

    Values that are no time of day give null, so do more than four digits unless
    ``cut_long`` takes the first four of them. ``roll_2400`` reads 2400 as midnight
    of the next day.
    """
    value = F.when(hhmm.between(0, 9999), hhmm.cast("int"))
    if cut_long:
        value = F.when(hhmm > 9999, F.substring(hhmm.cast("string"), 1, 4).cast("int")).otherwise(value)
    hour, minute = F.floor(value / 100), F.pmod(value, F.lit(100))
    valid = (value >= 0) & (hour < 24) & (minute < 60)
    if roll_2400:
        valid = valid | (value == 2400)
    # Built from the day number, so that no text is parsed per row and the
    # session zone has no say in it.
    seconds = F.unix_date(day.cast("date")).cast("long") * _DAY + hour * 3600 + minute * 60
    return F.when(valid, F.timestamp_seconds(seconds))


def rolled_day(day: Column, hhmm: Column, delay: Column) -> Column:
    """Date of the actual departure, when ``day`` is the scheduled date.

    A 23:50 departure that leaves 25 minutes late carries 15 as its clock;
    clock minus delay falls before midnight, so the day moves on by one.
    """
    minutes = F.floor(hhmm / 100) * 60 + F.pmod(hhmm, F.lit(100))
    shift = -F.floor((minutes - delay) / 1440)
    return F.date_add(day, F.coalesce(shift, F.lit(0)).cast("int"))


DOUBLED_MODES = ("earlier", "later", "null")
SKIPPED_MODES = ("forward", "null")


def to_utc(
    local: Column, zone: Column, doubled: str = "earlier", skipped: str = "forward"
) -> Column:
    """Instant of a local timestamp in the zone named by a column.

    Where clocks are set back a local time occurs twice (``doubled`` says which is meant), where they
    are set forward it does not occur (``skipped``: as if they had not been, or null).
    """
    if doubled not in DOUBLED_MODES or skipped not in SKIPPED_MODES:
        raise ValueError(f"doubled must be one of {DOUBLED_MODES}, skipped one of {SKIPPED_MODES}")
    if (doubled, skipped) == ("earlier", "forward"):
        return F.to_utc_timestamp(local, zone)
    before, after = _candidates(local, zone)
    fits = local_time_fit(local, zone)
    of_doubled = {"earlier": F.least(before, after), "later": F.greatest(before, after), "null": F.lit(None)}[doubled]
    of_skipped = F.to_utc_timestamp(local, zone) if skipped == "forward" else F.lit(None)
    return F.when(fits == "doubled", of_doubled).when(fits == "skipped", of_skipped).otherwise(
        F.to_utc_timestamp(local, zone)
    )


def _candidates(local: Column, zone: Column) -> tuple[Column, Column]:
    """Instants by the offsets that hold a day before and a day after: alike away from a change."""
    day = F.make_dt_interval(F.lit(1))
    return F.to_utc_timestamp(local - day, zone) + day, F.to_utc_timestamp(local + day, zone) - day


def local_time_fit(local: Column, zone: Column) -> Column:
    """``unique``, ``doubled`` or ``skipped``: how often a local time occurs in its zone.

    An offset fits if the instant that it gives is that local time again. Null without a zone.
    """
    before, after = _candidates(local, zone)
    fits = [F.from_utc_timestamp(instant, zone) == local for instant in (before, after)]
    return (
        F.when(fits[0] & fits[1] & (before != after), "doubled")
        .when(~fits[0] & ~fits[1], "skipped")
        .when(fits[0] | fits[1], "unique")
    )


def gap_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds between two timestamps, each cut to its second first."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)
