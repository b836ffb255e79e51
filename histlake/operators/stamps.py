"""Row stamps of the three layers.

Layer shapes (``<cols>`` = business columns):

* ff: ``<cols>, dl_loaded_dt, day``
* m:  ``dl_id, <cols>, dl_loaded_dt, dl_start_dt, dl_end_dt, dl_status, day``

Status values: ``A`` current, ``H`` superseded by a later version, ``P``
snapshot backup, ``N`` temporary (defined, never written).
Validity is half-open: ``dl_start_dt <= t < dl_end_dt``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import business_columns
from ..functions.ids import surrogate_id
from ..functions.slots import batch_lit, open_end_lit, slot_of

# Status codes.
STATUS_CURRENT = "A"
STATUS_TEMPORARY = "N"
STATUS_SNAPSHOT = "P"
STATUS_SUPERSEDED = "H"

M_TECH_TAIL = ("dl_loaded_dt", "dl_start_dt", "dl_end_dt", "dl_status", "day")


def _slot(batch_ts, slot: int | None, cycle: str) -> int:
    return slot if slot is not None else slot_of(batch_ts, cycle)


def m_columns(cols: Sequence[str]) -> list[str]:
    """Column order of the main table for the given business columns."""
    return ["dl_id", *cols, *M_TECH_TAIL]


def ff_columns(cols: Sequence[str]) -> list[str]:
    return [*cols, "dl_loaded_dt", "day"]


def stamp_load(df: DataFrame, batch_ts, slot: int | None = None,
               cycle: str = "month") -> DataFrame:
    """business columns + load time + day slot (the ff shape)."""
    cols = business_columns(df)
    return df.select(*cols, batch_lit(batch_ts).alias("dl_loaded_dt"),
                     F.lit(_slot(batch_ts, slot, cycle)).cast("int").alias("day"))


def open_rows(df: DataFrame, batch_ts, slot: int | None = None, cycle: str = "month",
              ori_id: Column | str | None = None) -> DataFrame:
    """new current versions, valid from the batch time on."""
    cols = business_columns(df)
    t = batch_lit(batch_ts)
    return df.select(
        surrogate_id(batch_ts, ori_id).alias("dl_id"), *cols,
        t.alias("dl_loaded_dt"), t.alias("dl_start_dt"), open_end_lit().alias("dl_end_dt"),
        F.lit(STATUS_CURRENT).alias("dl_status"),
        F.lit(_slot(batch_ts, slot, cycle)).cast("int").alias("day"))


def close_values(batch_ts, status: str, slot: int) -> dict[str, Column]:
    """The technical values a version gets when it is closed by this batch.

    ``dl_id`` and ``dl_start_dt`` are kept; load time and end become the
    batch time; the row moves to ``(status, slot)``.
    """
    t = batch_lit(batch_ts)
    return {"dl_loaded_dt": t, "dl_end_dt": t, "dl_status": F.lit(status),
            "day": F.lit(slot).cast("int")}


def close_rows(m: DataFrame, batch_ts, status: str = STATUS_SUPERSEDED,
               slot: int | None = None, cycle: str = "month") -> DataFrame:
    """closed versions (``H`` superseded or ``P`` snapshot backup)."""
    vals = close_values(batch_ts, status, _slot(batch_ts, slot, cycle))
    cols = business_columns(m)
    return m.select("dl_id", *cols, vals["dl_loaded_dt"].alias("dl_loaded_dt"), "dl_start_dt",
                    vals["dl_end_dt"].alias("dl_end_dt"), vals["dl_status"].alias("dl_status"),
                    vals["day"].alias("day"))


def required_predicate(required: Sequence[str], extra: str | Column | None = None) -> Column | None:
    preds = [F.col(c).isNotNull() for c in required]
    if extra is not None:
        preds.append(F.expr(extra) if isinstance(extra, str) else extra)
    return reduce(lambda a, b: a & b, preds) if preds else None


def clean_required(df: DataFrame, required: Sequence[str],
                   extra: str | Column | None = None) -> DataFrame:
    """F4 (+F9): keep rows whose key / not-null columns all have a value."""
    pred = required_predicate(required, extra)
    return df if pred is None else df.filter(pred)


def current(m: DataFrame) -> DataFrame:
    """current versions; on a table partitioned by status this prunes."""
    return m.filter(F.col("dl_status") == STATUS_CURRENT)
