"""Batch time and the cyclic ``day`` slot.

A run works with ONE batch time, frozen on the driver and passed to every
step, so a run over midnight cannot split its rows over two slots.  The
time is a wall-clock value (``timestamp_ntz``), like the Hive ``timestamp``
columns of the layers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The open end of a validity interval, and the formats used.
OPEN_END = "9999-12-31 00:00:00"
TS_FORMAT = "%Y-%m-%d %H:%M:%S"


def batch_text(batch_ts) -> str:
    """The batch time as ``yyyy-MM-dd HH:mm:ss`` (truncated to the second)."""
    if isinstance(batch_ts, str):
        batch_ts = _dt.datetime.fromisoformat(batch_ts.strip())
    if isinstance(batch_ts, _dt.datetime):
        if batch_ts.tzinfo is not None:
            batch_ts = batch_ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return batch_ts.replace(microsecond=0).strftime(TS_FORMAT)
    if isinstance(batch_ts, _dt.date):
        return _dt.datetime(batch_ts.year, batch_ts.month, batch_ts.day).strftime(TS_FORMAT)
    raise TypeError(f"batch time must be a datetime or a string, not {type(batch_ts)!r}")


def batch_datetime(batch_ts) -> _dt.datetime:
    return _dt.datetime.strptime(batch_text(batch_ts), TS_FORMAT)


def ts_lit(text: str) -> Column:
    """A wall-clock timestamp literal (no time-zone conversion involved)."""
    return F.lit(text).cast("timestamp_ntz")


def batch_lit(batch_ts) -> Column:
    return ts_lit(batch_text(batch_ts))


def open_end_lit() -> Column:
    return ts_lit(OPEN_END)


def slot_of(batch_ts, cycle: str) -> int:
    """The day slot of a batch time, computed once on the driver.

    ``week``: ISO weekday 1 (Monday) .. 7 (Sunday), the snapshot rotation.
    ``month``: day of month 1 .. 31, the incremental loads.
    """
    d = batch_datetime(batch_ts)
    if cycle == "week":
        return d.isoweekday()
    if cycle == "month":
        return d.day
    raise ValueError(f"cycle must be 'week' or 'month', not {cycle!r}")


def day_slot(ts: Column | str, cycle: str) -> Column:
    """Column form of :func:`slot_of` (X2 ``'u'``, X3 ``'d'``)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if cycle == "week":
        return (F.weekday(c) + 1).cast("int")
    if cycle == "month":
        return F.dayofmonth(c).cast("int")
    raise ValueError(f"cycle must be 'week' or 'month', not {cycle!r}")


def midnight_text(batch_ts) -> str:
    """The start of the batch day."""
    d = batch_datetime(batch_ts)
    return _dt.datetime(d.year, d.month, d.day).strftime(TS_FORMAT)


def format_ts(c: Column | str) -> Column:
    """X1 in column form: ``yyyy-MM-dd HH:mm:ss`` text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
