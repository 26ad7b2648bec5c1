"""Run-window contract and calendar expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K


def validate_dates(start: str, end: str | None = None) -> tuple[str, str]:
    """ISO dates in, ISO dates out; ``end`` defaults to ``start``.

    Raises ValueError for text that is not ``YYYY-MM-DD`` or when
    ``start`` lies after ``end``.
    """
    try:
        s = _dt.datetime.strptime(str(start), "%Y-%m-%d").date()
        e = _dt.datetime.strptime(str(end or start), "%Y-%m-%d").date()
        if s > e:
            raise ValueError(K.MSG_START_AFTER_END)
    except ValueError as exc:
        raise ValueError(K.MSG_INVALID_DATES.format(error=exc)) from exc
    return s.isoformat(), e.isoformat()


def date_lit(day: str) -> Column:
    return F.lit(day).cast("date")


def calendar(start: str, end: str) -> Column:
    """Generator column with one DATE per day of the inclusive range.

    Used inside ``select``/``withColumn`` on the frame that needs the days, so
    the calendar is expanded row-locally: no join and nothing to broadcast.
    """
    return F.explode(F.sequence(date_lit(start), date_lit(end)))


def in_window(col: Column | str, start: str, end: str | None = None) -> Column:
    """Equality on ``start`` when ``end`` is None, else an inclusive range."""
    c = F.col(col) if isinstance(col, str) else col
    if end is None:
        return c == date_lit(start)
    return c.between(date_lit(start), date_lit(end))
