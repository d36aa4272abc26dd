"""Status changes of sources by event time: told also when nothing arrives any more.

A source passes with each observation, warns once it has been silent for more than six
hours and errs after twelve: the batch rule of ``status.source_status``, told as changes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wattlane.functions.status import ERROR_HOURS, WARN_HOURS

DELAY = timedelta(hours=2)

HOUR_MS = 3_600_000
LAPSES = (("warn", WARN_HOURS * HOUR_MS), ("error", ERROR_HOURS * HOUR_MS))
STATUSES = ("pass", "warn", "error")


def _settled(
    last: int | None, status: str, times: Iterable[int], watermark: int
) -> tuple[int | None, str, list[tuple[str, int]]]:
    """The last observation before the watermark, the status then and the changes up to it."""
    changes: list[tuple[str, int]] = []

    def lapse(until: int) -> None:
        nonlocal status
        for name, silence in LAPSES:
            later = STATUSES.index(name) > STATUSES.index(status)
            if last is not None and later and last + silence < until:
                changes.append((name, last + silence))
                status = name

    for time in times:
        if last is not None and time <= last:
            continue  # told already, or later than the delay allows
        lapse(time)
        if last is None or status != "pass":
            changes.append(("pass", time))
        last, status = time, "pass"
    lapse(watermark)
    return last, status, changes


def _told(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    watermark = state.getCurrentWatermarkMs()
    last, status, waiting = state.get if state.exists else (None, "pass", "")
    times = {int(time) for time in waiting.split()}
    for frame in frames:
        times.update(frame["observed_ms"].unique().tolist())
    ahead = sorted(time for time in times if time >= watermark)
    due = sorted(time for time in times if time < watermark)
    last, status, changes = _settled(last, status, due, watermark)
    state.update((last, status, " ".join(map(str, ahead))))
    moments = ahead[:1]
    if last is not None:
        moments += [last + silence for name, silence in LAPSES if STATUSES.index(name) > STATUSES.index(status)]
    if moments:
        state.setTimeoutTimestamp(min(moments))
    yield pd.DataFrame(
        {
            "source": [key[0]] * len(changes),
            "status": [name for name, _ in changes],
            "changed_at": pd.to_datetime([time for _, time in changes], unit="ms"),
        }
    )


def status_changes(
    observed: DataFrame, *, source: str = "region", moment: str = "observation_timestamp",
    delay: timedelta = DELAY,
) -> DataFrame:
    """``source``, ``status`` and ``changed_at`` of a stream of observations.

    Changes are told once the watermark, ``delay`` behind the newest observation of any
    source, has passed them: by an observation or, for a silent source, by its timer. Rows
    may come in any order within the delay and repeat; those beyond it change nothing. A
    source's state is its last observation and the distinct times still ahead of the
    watermark. Rows without a source or a moment are not observations.
    """
    times = observed.select(F.col(source).alias("source"), F.col(moment).alias("observed"))
    times = times.where(F.col("source").isNotNull() & F.col("observed").isNotNull())
    marked = times.withWatermark("observed", f"{int(delay.total_seconds())} seconds").select(
        "source", "observed", F.unix_millis("observed").alias("observed_ms")
    )
    return marked.groupBy("source").applyInPandasWithState(
        _told,
        "source string, status string, changed_at timestamp",
        "last long, status string, waiting string",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def past_status_changes(
    rows: DataFrame, until: datetime, *, source: str = "region", moment: str = "observation_timestamp"
) -> DataFrame:
    """The same changes before ``until`` of observations at rest, for history and repairs."""
    times = rows.select(F.col(source).alias("source"), F.col(moment).alias("t"))
    times = times.where(F.col("source").isNotNull() & F.col("t").isNotNull()).distinct()
    by_time = Window.partitionBy("source").orderBy("t")
    end = F.lit(until)
    warn, error = (F.make_dt_interval(hours=F.lit(hours)) for hours in (WARN_HOURS, ERROR_HOURS))
    gaps = times.select(
        "source",
        "t",
        F.lag("t").over(by_time).alias("before"),
        F.least(F.lead("t").over(by_time), end).alias("next"),
    ).where(F.col("t") < end)

    def change(status: str, at, when):
        return F.when(when, F.struct(F.lit(status).alias("status"), at.alias("changed_at")))

    t, silent = F.col("t"), F.col("before").isNull() | (F.col("t") > F.col("before") + warn)
    changes = F.array_compact(
        F.array(
            change("pass", t, silent),
            change("warn", t + warn, t + warn < F.col("next")),
            change("error", t + error, t + error < F.col("next")),
        )
    )
    return gaps.select("source", F.inline(changes))
