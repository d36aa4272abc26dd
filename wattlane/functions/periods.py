"""Period text and dates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The period layouts, full timestamp with offset, and day. The third is the
# day, a T and the hour.
TIMESTAMP_LAYOUTS = (
    "yyyy-M-d'T'H:m:s[.SSSSSSSSS]XXX",
    "yyyy-M-d'T'H:m:s[.SSSSSSSSS]XX",
    "yyyy-M-d'T'H:m:s[.SSSSSSSSS]X",
)
DAY_LAYOUT = "yyyy-M-d"
SHORTEST_DAY = len("2026-3-7")


def parse_period(period: Column) -> Column:
    """Timestamp of a period text, NULL where no layout fits.

    The layouts exclude each other by shape (a colon, a ``T``, neither), so each text
    meets only the parsers that can accept it: a failed parse costs a JVM exception
    per row, which trying all layouts in turn would raise on nearly every hourly row.
    The hour, by far the most frequent, is completed to a time that a plain cast reads in
    half the time; a ``T`` before any full date would read as a time of today.
    """
    text = F.trim(period)
    as_timestamp = F.coalesce(
        *[F.try_to_timestamp(text, F.lit(layout)) for layout in TIMESTAMP_LAYOUTS]
    )
    hour = F.concat(text, F.lit(":00:00"))
    return (
        F.when(F.contains(text, F.lit(":")), as_timestamp)
        .when(F.instr(text, "T") > SHORTEST_DAY, hour.try_cast("timestamp"))
        .otherwise(F.try_to_timestamp(text, F.lit(DAY_LAYOUT)))
    )


def date_ranges(dates: Iterable[date]) -> list[tuple[date, date]]:
    """Runs of consecutive days, so that a long backfill stays a short predicate."""
    ranges: list[tuple[date, date]] = []
    for day in sorted(set(dates)):
        if ranges and day - ranges[-1][1] == timedelta(days=1):
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    return ranges


def in_dates(column: Column, dates: Iterable[date]) -> Column:
    """Membership in a set of days as literal ranges, which prune partitions statically."""
    bounds = [column.between(F.lit(first), F.lit(last)) for first, last in date_ranges(dates)]
    return reduce(lambda left, right: left | right, bounds, F.lit(False))


def with_history(dates: Iterable[date], days: int) -> set[date]:
    """The dates and the ``days`` calendar days before each of them."""
    return {day - timedelta(days=back) for day in dates for back in range(days + 1)}
