"""Newest row per key, exact-duplicate removal, newest batch.

``row_number() = 1`` over a key window is planned by Spark as a *partial*
WindowGroupLimit before the shuffle and a final one after it: every map
task forwards at most one row per key, so a key holding a third of all rows
does not end up whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import business_columns, row_checksum
from ..functions.slots import midnight_text, ts_lit

_RN = "_rn"
_CK = "_dup_ck"


def _order(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]):
    """Newest first on ``order_cols``; then every other column ascending.

    The tie-break makes the choice total: two rows tie only when they are
    equal in every column, and then either may be returned.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(order_cols)]
    return ([F.col(c).desc_nulls_last() for c in order_cols]
            + [F.col(c).asc_nulls_first() for c in rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The newest row of every key (newest = largest ``order_cols``)."""
    if not keys:
        raise ValueError("latest_per_key needs key columns")
    if not order_cols:
        raise ValueError("latest_per_key needs order columns (the newest-first order)")
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, order_cols))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def drop_exact_duplicates(df: DataFrame, keys: Sequence[str] = (),
                          order_cols: Sequence[str] = ("dl_loaded_dt",),
                          strict: bool = True) -> DataFrame:
    """Rows equal in every business column collapse to the newest load.

    The grouping key is ``keys`` plus the checksum of all business columns
    (the check key); rows differing only in load time or slot are copies.
    """
    cols = business_columns(df)
    with_ck = df.withColumn(_CK, row_checksum(cols, strict))
    group = [*keys, _CK]
    w = Window.partitionBy(*group).orderBy(*_order(with_ck, group, order_cols))
    return (with_ck.withColumn(_RN, F.row_number().over(w))
                   .filter(F.col(_RN) == 1).drop(_RN, _CK))


def latest_batch(ff: DataFrame, load_col: str = "dl_loaded_dt") -> DataFrame:
    """rows of the newest load.

    The maximum is one scalar (a column-only scan); it comes back to the
    driver as a literal so the equality filter reaches the parquet reader.
    """
    dtype = ff.schema[load_col].dataType
    # back and forth as text in the column's own type: no time-zone conversion
    newest = ff.agg(F.max(load_col).cast("string")).first()[0]
    if newest is None:
        return ff.limit(0)
    return ff.filter(F.col(load_col) == F.lit(newest).cast(dtype))


def loaded_since_midnight(ff: DataFrame, slot: int, batch_ts,
                          load_col: str = "dl_loaded_dt") -> bool:
    """did a load land in this slot after midnight of the batch day?

    Partition-pruned on ``day`` and bounded by ``limit(1)``.
    """
    hit = ff.filter((F.col("day") == slot) & (F.col(load_col) > ts_lit(midnight_text(batch_ts))))
    return len(hit.select(load_col).limit(1).collect()) > 0
