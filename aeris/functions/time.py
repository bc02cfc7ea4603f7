"""Date and time expressions of the measurement documents.

Source datetimes are ISO-8601 strings such as ``2025-03-01T10:00:00+01:00``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"([+-])(\d{2}):(\d{2})$"


def day_text(local: Column) -> Column:
    """Calendar day of a local ISO datetime, as text (``split(s, 'T')[0]``).

    No ``T`` gives the whole string, ``""`` stays ``""``, NULL stays NULL.
    """
    return F.substring_index(local, "T", 1)


def a_day(day: Column) -> Column:
    """Whether a ``day_text`` is a calendar day (never NULL)."""
    return F.coalesce(day.rlike(r"^\d{4}-\d{2}-\d{2}$") & day.try_cast("date").isNotNull(), F.lit(False))


def local_timestamp(text: Column, mode: str = "reference") -> Column:
    """Parse an ISO datetime with an optional UTC offset into ``timestamp_ntz``.

    ``mode="reference"`` keeps the original job's result: a *negative* offset is
    stripped (the wall clock is kept), while ``Z`` and positive offsets are
    converted to UTC, the original session zone (``…T10:00:00+01:00`` → 09:00).
    ``mode="wall_clock"`` strips any offset and keeps the local wall clock
    (``…T10:00:00+01:00`` → 10:00), the evident intent of the location
    timestamp. Malformed text gives NULL in both modes instead of failing the
    job. The result does not depend on the session time zone.
    """
    wall = text.try_cast("timestamp_ntz")
    if mode == "wall_clock":
        return wall
    if mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    sign = F.regexp_extract(text, _OFFSET, 1)
    hours = F.regexp_extract(text, _OFFSET, 2).try_cast("int")
    minutes = F.regexp_extract(text, _OFFSET, 3).try_cast("int")
    shift = F.make_dt_interval(F.lit(0), hours, minutes, F.lit(0))
    return F.when(sign == "+", wall - shift).otherwise(wall)


def run_window(run_date: str | _dt.date, days: int = 1) -> tuple[str, str]:
    """The half-open pull window ``[run_date - days, run_date)`` as ISO dates.

    The run date is always a parameter; operators never read the wall clock.
    """
    if isinstance(run_date, str):
        run_date = _dt.date.fromisoformat(run_date)
    start = run_date - _dt.timedelta(days=days)
    return start.isoformat(), run_date.isoformat()
