"""Reading and pruning the version history (V1, S16 row form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.slots import batch_lit
from .stamps import STATUS_SUPERSEDED


def as_of(m: DataFrame, ts) -> DataFrame:
    """V1: the versions valid at ``ts`` (``dl_start_dt <= ts < dl_end_dt``)."""
    t = batch_lit(ts)
    return m.filter((F.col("dl_start_dt") <= t) & (t < F.col("dl_end_dt")))


def expired(m: DataFrame, before, statuses: Sequence[str] = (STATUS_SUPERSEDED,)):
    """Predicate of closed versions that ended before ``before``."""
    return F.col("dl_status").isin(list(statuses)) & (F.col("dl_end_dt") < batch_lit(before))


def expire_rows(m: DataFrame, before, statuses: Sequence[str] = (STATUS_SUPERSEDED,)) -> DataFrame:
    """S16, row form: drop closed versions that ended before ``before``.

    The original states "incremental history is kept 30 days" but never
    removes anything; this is the retention it describes.  Current rows are
    never touched.
    """
    return m.filter(~expired(m, before, statuses))
