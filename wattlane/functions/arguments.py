"""Argument checks, done before a plan is built."""

from __future__ import annotations

from datetime import UTC, date, datetime

GRANULARITIES = ("hourly", "daily")


class InvalidRequest(ValueError):
    """A request that cannot be answered as asked; ``hint`` says how to change it."""

    def __init__(self, message: str, hint: str | None = None) -> None:
        super().__init__(message)
        self.hint = hint


def coerce_utc(value: datetime | str) -> datetime:
    """Aware UTC datetime from a datetime or ISO text; naive input is taken as UTC."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        return moment.replace(tzinfo=UTC)
    return moment.astimezone(UTC)


def check_region(region: str) -> str:
    if not region.strip():
        raise InvalidRequest("region must not be empty")
    return region


def check_dates(start: date | None, end: date | None) -> None:
    if start is not None and end is not None and start > end:
        raise InvalidRequest("start_date must be less than or equal to end_date")


def check_limit(limit: int) -> None:
    if limit < 1:
        raise InvalidRequest("limit must be greater than or equal to 1")


def check_granularity(granularity: str) -> None:
    if granularity not in GRANULARITIES:
        raise InvalidRequest(f"granularity must be one of: {', '.join(sorted(GRANULARITIES))}")


def closed_days(start: date, end: date) -> int:
    """Calendar days in the closed interval."""
    check_dates(start, end)
    return (end - start).days + 1


def check_budget(rows: int, max_rows: int | None, what: str) -> None:
    if max_rows is not None and rows > max_rows:
        raise InvalidRequest(
            f"{what}: up to {rows} rows, more than the {max_rows} allowed",
            hint="A shorter range of days, or fewer rows a day, will do.",
        )
