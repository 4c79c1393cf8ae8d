"""A sketch of the trips each fact month holds: which months may hold a trip is told without reading facts.

A sketch has a row (pickup day, mark) per trip, a mark being the leading bits of a hash of the trip id. The id covers
the pickup instant, so a trip can only meet entries of its own day: one trip with a far-off pickup asks that day and
not the years in between. Entries are stored by month and sorted by day, so a load reads the row groups of its days.
An entry that answers by chance makes a month a candidate and never changes a result: candidates are compared by id.
Chance answers are expected for (trips of the load x entries of other months on the same day) / 2**bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK_BITS = 64
# Up to so many days are named in the scan's filter; beyond, the days are joined.
NAMED_DAYS = 1_000
ORDER = ("pickup_day", "mark")
NO_DAY = -(2**31)


def pickup_day() -> Column:
    """The day of a pickup, counted from 1970; trips without one share a day of their own."""
    return F.coalesce(F.unix_date(F.to_date("pickup_at")), F.lit(NO_DAY))


def key_sketch(fact: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """(dataset_month, pickup_day, mark): an entry for each trip."""
    if not 1 <= bits <= 64:
        raise ValueError("a mark has 1 to 64 bits")
    mark = F.shiftrightunsigned(F.xxhash64("trip_id"), 64 - bits)
    return fact.select("dataset_month", pickup_day().alias("pickup_day"), mark.alias("mark"))


def answering(sketch: DataFrame, new: DataFrame, months: Sequence[str], bits: int = MARK_BITS) -> DataFrame:
    """Entries of months outside the load that one of its trips may be."""
    asked = key_sketch(new, bits).select(*ORDER)
    held = sketch.where(~F.col("dataset_month").isin(*months))
    days = asked.select("pickup_day").distinct()
    named = [row[0] for row in days.limit(NAMED_DAYS + 1).collect()]
    if len(named) <= NAMED_DAYS:
        held = held.where(F.col("pickup_day").isin(*named))
    else:
        held = held.join(days, "pickup_day", "left_semi")
    return held.join(asked, list(ORDER), "left_semi").select("dataset_month", *ORDER)


def answering_months(sketch: DataFrame, new: DataFrame, months: Sequence[str], bits: int = MARK_BITS) -> DataFrame:
    """Months outside the load that may hold one of its trips."""
    return answering(sketch, new, months, bits).select("dataset_month").distinct()
