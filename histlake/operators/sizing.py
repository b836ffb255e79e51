"""Broadcast only what is proven small.

The proof is a measurement, not an estimate: one aggregation over the
(staged) rows adds up the bytes of the key columns -- fixed widths for
numbers and times, ``octet_length`` for text.  The distinct key set is never
larger than that sum, so it may be broadcast when the sum is under the
limit.  Anything larger goes to the planner's shuffle join, which AQE may
still switch to a broadcast from the *measured* shuffle size
(``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DateType, DecimalType,
                               DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, TimestampNTZType, TimestampType)

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32             # hash-table slot and row header per key

_FIXED = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, LongType: 8,
          FloatType: 4, DoubleType: 8, DateType: 4, TimestampType: 8, TimestampNTZType: 8,
          DecimalType: 16}


def key_stats(df: DataFrame, cols: Sequence[str]) -> tuple[int, int]:
    """Row count and exact byte total of ``cols`` over all rows (one small job)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    width = F.lit(ROW_OVERHEAD).cast("bigint")
    for c in cols:
        t = types[c]
        fixed = _FIXED.get(type(t))
        if fixed is not None:
            width = width + F.lit(fixed)
        elif isinstance(t, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
        else:
            width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    row = df.select(width.alias("w")).agg(F.count(F.lit(1)), F.sum("w")).first()
    return int(row[0] or 0), int(row[1] or 0)
