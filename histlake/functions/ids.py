"""Surrogate row ids (X8), computed natively instead of by a Python UDF.

The id packs the batch minute, a partition part and a sequence part:

    id = minutes * 2^44 + (ori_id >> 33) * 2^30 + (ori_id & (2^33 - 1))

``minutes`` counts whole minutes from midnight 2000-01-01 at UTC+8 to the
batch time.  The value needs 68 bits, so it is built in ``decimal(38,0)``
and returned as text; this is the layout for an ``ori_id`` the caller gives
(a key column: ids then do not depend on the partitioning).

From partition 16,384 on the partition part of that layout reaches the
minutes, so ids of two batches could meet.  Without an ``ori_id`` the ids are
therefore wide: ``minutes * 2^63 + monotonically_increasing_id()``, whose
parts never overlap, so ids are unique within a batch and between batches.
``wide`` chooses the layout explicitly.
"""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slots import batch_datetime

# Fixed values of the id layout.
EPOCH_2000_UTC8 = 946656000       # 1999-12-31T16:00:00Z = 2000-01-01 00:00 at UTC+8
MINUTE_SHIFT = 44                 # minutes start at bit 44
PARTITION_SHIFT_IN = 33           # partition part read from ori_id bit 33 on ...
PARTITION_SHIFT_OUT = 30          # ... and written from bit 30 on
SEQUENCE_MASK = (1 << 33) - 1     # low 33 bits of ori_id
# Our own wide layout: the whole row number below the minutes.
WIDE_SHIFT = 63


def batch_minutes(batch_ts) -> int:
    """Minutes since the id epoch; a naive batch time is read as UTC."""
    seconds = calendar.timegm(batch_datetime(batch_ts).timetuple())
    return (seconds - EPOCH_2000_UTC8) // 60


def _packed(minutes: Column, ori_id: Column | str | None, wide: bool | None) -> Column:
    """Minutes (a decimal column) and row number as one text."""
    if ori_id is None:
        oid = F.monotonically_increasing_id()
    else:
        oid = (F.col(ori_id) if isinstance(ori_id, str) else ori_id).cast("bigint")
    if ori_id is None if wide is None else wide:
        total = minutes * F.lit(Decimal(1 << WIDE_SHIFT)).cast("decimal(20,0)") + oid.cast("decimal(38,0)")
    else:
        part = F.shiftleft(F.shiftright(oid, PARTITION_SHIFT_IN), PARTITION_SHIFT_OUT)
        seq = oid.bitwiseAND(F.lit(SEQUENCE_MASK))
        high = minutes * F.lit(Decimal(1 << MINUTE_SHIFT)).cast("decimal(20,0)")
        total = high.cast("decimal(38,0)") + part.cast("decimal(38,0)") + seq.cast("decimal(38,0)")
    return total.cast("decimal(38,0)").cast("string")


def surrogate_id(batch_ts, ori_id: Column | str | None = None, wide: bool | None = None) -> Column:
    """The ``dl_id`` column for rows opened in the batch ``batch_ts``."""
    return _packed(F.lit(Decimal(batch_minutes(batch_ts))).cast("decimal(17,0)"), ori_id, wide)


def minutes_of(ts: Column | str) -> Column:
    """Column form of :func:`batch_minutes` for a wall-clock timestamp column.

    Built from the calendar fields (days since 1970 and time of day), so no
    session time zone takes part.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    secs = (F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600
            + F.minute(c) * 60 + F.second(c))
    return F.floor((secs - F.lit(EPOCH_2000_UTC8)) / 60).cast("bigint")


def surrogate_id_at(ts: Column | str, ori_id: Column | str | None = None, wide: bool | None = None) -> Column:
    """:func:`surrogate_id` with a per-row batch time (for multi-batch loads)."""
    return _packed(minutes_of(ts).cast("decimal(17,0)"), ori_id, wide)


def dense_ids(df: DataFrame, order_by: Sequence[str], path: str, name: str = "row_no") -> DataFrame:
    """``df`` with ``name``: 0 .. n-1 without gaps, in the order of ``order_by``.

    Two passes, no window over all rows: the rows are range-partitioned, sorted
    and written to ``path`` with their place in their task; then every task's
    count gives the offset of the next (one number a task comes to the driver),
    and a row's number is offset + place.  Rows that tie in ``order_by`` follow
    the hash of their columns; rows equal in all are interchangeable, and many
    of them are spread over several tasks.

    Below 2^33 rows the numbers fit the id layout for a given ``ori_id``, in
    which they never meet those of another batch.
    """
    order = [*[F.col(c).asc_nulls_first() for c in order_by], F.col("_tie"), F.col("_no")]
    placed = df.withColumns({"_tie": F.xxhash64(*df.columns), "_no": F.monotonically_increasing_id()})
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed.select(*df.columns, F.shiftright(place, PARTITION_SHIFT_IN).cast("int").alias("_task"),
                  place.bitwiseAND(F.lit(SEQUENCE_MASK)).alias("_place")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    offset, entries = 0, []
    for r in rows.groupBy("_task").count().orderBy("_task").collect():
        entries.append((r["_task"], offset))
        offset += r["count"]
    offsets = df.sparkSession.createDataFrame(entries, "_task int, _offset long")
    return rows.join(F.broadcast(offsets), "_task").select(  # a row a task
        *df.columns, (F.col("_offset") + F.col("_place")).alias(name))
