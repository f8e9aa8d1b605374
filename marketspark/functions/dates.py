"""Dates: strict parsing, weeks, windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import types as T

DAY_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
DAY_OR_TIME_PATTERN = (
    r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?( ?(Z|UTC|[+-]\d{1,2}:?\d{2}))?)?$"
)


def day(value: str, kind: T.DataType, allow_time: bool = False) -> str:
    """A column as a date; text of any other shape than year-month-day is null."""
    if isinstance(kind, T.StringType):
        shape = DAY_OR_TIME_PATTERN if allow_time else DAY_PATTERN
        whole = f" and try_cast({value} as timestamp) is not null" if allow_time else ""
        return f"if({value} rlike r'{shape}'{whole}, try_cast({value} as date), null)"
    return f"cast({value} as date)"


def week_start(value: str) -> str:
    """Monday of the week."""
    return f"cast(date_trunc('week', {value}) as date)"


def days(start: str, end: str) -> str:
    """All calendar days of a closed window, as an array."""
    first, last = check_window(start, end)
    return f"sequence(date '{first}', date '{last}', interval 1 day)"


def spine(start: str, end: str) -> str:
    """One row per calendar day, both ends included."""
    return f"explode({days(start, end)})"


def check_window(start: str, end: str) -> tuple[date, date]:
    """Validate a pair of ISO dates given as job arguments."""
    try:
        first, last = date.fromisoformat(start), date.fromisoformat(end)
    except (TypeError, ValueError) as bad:
        raise ValueError(f"dates must look like YYYY-MM-DD: {start!r}, {end!r}") from bad
    if first > last:
        raise ValueError(f"the window starts after it ends: {start} > {end}")
    return first, last


def half_open(start: str, end: str) -> tuple[str, str]:
    """The closed window ``[start, end]`` as ``[start, end + 1 day)``."""
    first, last = check_window(start, end)
    return first.isoformat(), (last + timedelta(days=1)).isoformat()


def in_window(value: str, start: str, end: str, end_inclusive: bool = True) -> str:
    """Filter on a date column, closed unless ``end_inclusive`` is false."""
    first, last = check_window(start, end)
    return f"{value} >= date '{first}' and {value} {'<=' if end_inclusive else '<'} date '{last}'"
