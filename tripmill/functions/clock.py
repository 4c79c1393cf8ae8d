"""Time expressions over SQL text. All of them assume the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wall clock the source files are written in, and week day names.
SOURCE_ZONE = "America/New_York"
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def local_to_instant(wall: str) -> Column:
    """Instant of a naive New York wall-clock time.

    The hour that happens twice when summer time ends means the later, standard
    time instant. That hour always starts at 01:00 in this zone, so the second
    conversion is only tried there.
    """
    wall = f"CAST({wall} AS TIMESTAMP)"
    first = f"to_utc_timestamp({wall}, '{SOURCE_ZONE}')"
    second = f"({first} + INTERVAL 1 HOUR)"
    return F.expr(
        f"CASE WHEN hour({wall}) = 1 AND from_utc_timestamp({second}, '{SOURCE_ZONE}') = {wall} "
        f"THEN {second} ELSE {first} END"
    )


def seconds_between(start: str, end: str) -> Column:
    """Second boundaries crossed from start to end (0.9 s to 1.1 s counts as one)."""
    return F.expr(f"unix_seconds({end}) - unix_seconds({start})")


def month_text(moment: str) -> Column:
    return F.expr(f"date_format({moment}, 'yyyy-MM')")


def in_own_month(moment: str, dataset_month: str) -> Column:
    """True when the UTC month of the instant is the month of the file it came in."""
    return F.expr(f"trunc(CAST({moment} AS DATE), 'MM') = CAST(concat({dataset_month}, '-01') AS DATE)")


def weekday_number(moment: str) -> Column:
    """Sunday is 0."""
    return F.expr(f"dayofweek({moment}) - 1")


def weekday_name(number: str) -> Column:
    """English name of a week day number, independent of the session locale."""
    names = ", ".join(f"'{day}'" for day in WEEKDAYS)
    return F.expr(f"element_at(array({names}), {number} + 1)")
