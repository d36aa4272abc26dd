"""Freshness statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Freshness thresholds in hours.
FRESH_HOURS = 6
WARN_HOURS = 6
ERROR_HOURS = 12

MICROS_PER_HOUR = 3_600_000_000


def age_micros(moment: Column, checked_at: Column) -> Column:
    return F.unix_micros(checked_at) - F.unix_micros(moment)


def freshness_status(moment: Column, checked_at: Column) -> Column:
    """``fresh`` up to and including six hours of age; a future moment is fresh too."""
    return (
        F.when(moment.isNull(), "unknown")
        .when(age_micros(moment, checked_at) <= FRESH_HOURS * MICROS_PER_HOUR, "fresh")
        .otherwise("stale")
    )


def source_status(moment: Column, checked_at: Column) -> Column:
    """``warn`` past six hours, ``error`` past twelve or when nothing was loaded."""
    age = age_micros(moment, checked_at)
    return (
        F.when(moment.isNull() | (age > ERROR_HOURS * MICROS_PER_HOUR), "error")
        .when(age > WARN_HOURS * MICROS_PER_HOUR, "warn")
        .otherwise("pass")
    )


def known_status(status: Column) -> Column:
    return F.when(status.isin("fresh", "stale", "unknown"), status).otherwise("unknown")


def combined_status(pipeline: Column, data: Column) -> Column:
    """The worse of two statuses: stale wins, fresh needs both."""
    pipeline, data = known_status(pipeline), known_status(data)
    return (
        F.when((pipeline == "stale") | (data == "stale"), "stale")
        .when((pipeline == "fresh") & (data == "fresh"), "fresh")
        .otherwise("unknown")
    )
