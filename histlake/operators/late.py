"""An upsert batch that comes after later ones have been loaded (P2, out of order).

Loaded in its turn, an arrival would have closed the version valid at its
batch time and been closed by whatever closed that version.  So the version
is split: its first part ends at the batch time, and the arrival takes over
the second part with its end, load time, status and slot.  A key without a
version at that time opens one that lasts to the key's next start, if it has
one.  What was loaded later is taken to be upserts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import business_columns
from ..functions.ids import surrogate_id
from ..functions.slots import batch_lit, open_end_lit, slot_of
from .match import flag_matches, matched
from .stamps import STATUS_CURRENT, STATUS_SUPERSEDED, close_values

_KNOWN = (STATUS_CURRENT, STATUS_SUPERSEDED)   # snapshot backups take no part


def valid_at(batch_ts) -> Column:
    t = batch_lit(batch_ts)
    return F.col("dl_status").isin(*_KNOWN) & (F.col("dl_start_dt") <= t) & (F.col("dl_end_dt") > t)


def late_facts(m: DataFrame, clean: DataFrame, keys: Sequence[str], batch_ts) -> DataFrame:
    """Per arriving key that has versions ending after the batch time: ``split``
    (the values a version valid at that time ends with, else null), ``slots``
    (the partitions of such versions) and ``next_start``."""
    t = batch_lit(batch_ts)
    valid = valid_at(batch_ts)
    later = m.where(F.col("dl_status").isin(*_KNOWN) & (F.col("dl_end_dt") > t))
    narrow = later.select(*keys, "dl_start_dt", "dl_end_dt", "dl_loaded_dt", "dl_status", "day")
    return matched(narrow, clean, keys).groupBy(*keys).agg(
        F.min(F.when(valid, F.struct("dl_end_dt", "dl_loaded_dt", "dl_status", "day"))).alias("split"),
        F.collect_set(F.when(valid, F.struct("dl_status", "day"))).alias("slots"),
        F.min(F.when(F.col("dl_start_dt") > t, F.col("dl_start_dt"))).alias("next_start"))


def late_rows(touched: DataFrame, clean: DataFrame, facts: DataFrame, keys: Sequence[str], batch_ts,
              slot: int | None = None, ori_id: Column | str | None = None) -> DataFrame:
    """The rows of the partitions ``touched`` with the split versions closed at
    the batch time, and the arrivals as the versions they would have become.

    ``clean`` are the cleaned arrivals (several of one key all open, as in an
    upsert), ``facts`` comes from :func:`late_facts` over the whole table.
    """
    slot = slot if slot is not None else slot_of(batch_ts, "month")
    cols = business_columns(clean)
    vals = close_values(batch_ts, STATUS_SUPERSEDED, slot)
    flagged = flag_matches(touched, facts.where(F.col("split").isNotNull()), keys, flag="_arrived")
    cut = F.col("_arrived") & valid_at(batch_ts)
    kept = flagged.select(*[F.when(cut, vals[c]).otherwise(F.col(c)).alias(c) if c in vals else F.col(c)
                            for c in touched.columns])
    known = facts.select(*[F.col(k).alias("_r_" + k) for k in keys], "split", "next_start")
    on = [clean[k] == known["_r_" + k] for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    # the version an arrival takes over, if it has been closed; else its own opening
    over = F.col("split.dl_status") == STATUS_SUPERSEDED
    ends = F.coalesce(F.when(over, F.col("split.dl_end_dt")), F.when(F.col("split").isNull(), F.col("next_start")))
    t = batch_lit(batch_ts)
    opened = clean.join(known, cond, "left_outer").withColumn("_end", ends).select(
        surrogate_id(batch_ts, ori_id).alias("dl_id"), *cols,
        F.when(over, F.col("split.dl_loaded_dt")).otherwise(F.coalesce("_end", t)).alias("dl_loaded_dt"),
        t.alias("dl_start_dt"), F.coalesce("_end", open_end_lit()).alias("dl_end_dt"),
        F.when(F.col("_end").isNull(), F.lit(STATUS_CURRENT)).otherwise(F.lit(STATUS_SUPERSEDED)).alias("dl_status"),
        F.when(over, F.col("split.day")).when(F.col("_end").isNotNull(), F.dayofmonth("_end"))
         .otherwise(F.lit(slot)).cast("int").alias("day"))
    return kept.unionByName(opened)
