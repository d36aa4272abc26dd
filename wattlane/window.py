"""The batch window: the unit of loading, rerunning and backfilling."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from wattlane.functions.arguments import InvalidRequest, coerce_utc


@dataclass(frozen=True)
class BatchWindow:
    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: datetime | str, end: datetime | str) -> BatchWindow:
        window = cls(coerce_utc(start), coerce_utc(end))
        if window.end <= window.start:
            raise InvalidRequest("window end must be later than window start")
        return window

    @classmethod
    def from_batch_id(cls, batch_id: str) -> BatchWindow:
        start, end = (datetime.strptime(text, "%Y%m%dT%H%M%S") for text in batch_id.split("_"))
        return cls.of(start, end)

    @property
    def batch_date(self) -> date:
        return self.start.date()

    @property
    def batch_id(self) -> str:
        return f"{self.start:%Y%m%dT%H%M%S}_{self.end:%Y%m%dT%H%M%S}"


def hourly_windows(start: datetime | str, end: datetime | str) -> list[BatchWindow]:
    """The hourly windows covering ``[start, end)``, oldest first."""
    first, last = coerce_utc(start), coerce_utc(end)
    if any((m.minute, m.second, m.microsecond) != (0, 0, 0) for m in (first, last)):
        raise InvalidRequest("window boundaries must align to an hour")
    hour = timedelta(hours=1)
    count = (last - first) // hour
    return [BatchWindow(first + hour * n, first + hour * (n + 1)) for n in range(count)]


def daily_window(day: date) -> BatchWindow:
    start = datetime(day.year, day.month, day.day, tzinfo=UTC)
    return BatchWindow(start, start + timedelta(days=1))


def utc_now() -> datetime:
    return datetime.now(tz=UTC)
