"""Deviation from a baseline and share of a total."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flagging threshold in percent and baseline length in days.
ANOMALY_THRESHOLD_PCT = 50.0
BASELINE_DAYS = 7


def pct_deviation(current: Column, baseline: Column) -> Column:
    """NULL when the baseline is missing or zero."""
    return F.when(
        baseline.isNotNull() & (baseline != 0), (current - baseline) / baseline * 100
    )


def anomaly_flag(deviation: Column) -> Column:
    return F.coalesce(F.abs(deviation) > ANOMALY_THRESHOLD_PCT, F.lit(False))


def share_pct(part: Column, total: Column) -> Column:
    """Percentage rounded half up to two digits; zero when the total is zero."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(part / total * 100, 2))
