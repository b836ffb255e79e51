"""Matching current versions against arrivals.

All joins take the *distinct* keys of the other side: the partial
aggregation runs before the shuffle, so a key that holds a third of the
arrivals sends at most one row per map task, and the join can neither fan
out nor pile a hot key onto one reducer.  The aggregate's hash partitioning
on the keys is the one the join needs, so it costs no extra exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import business_columns, row_checksum

CHECKSUM = "dl_checksum"
_R = "_r_"          # prefix of right-side join columns


def key_set(df: DataFrame, keys: Sequence[str], extra: Sequence[str] = (),
            broadcast: bool = False) -> DataFrame:
    """Distinct ``keys (+ extra)`` of ``df``, renamed with the right-side prefix.

    ``broadcast=True`` is for callers that proved the set small (see
    :func:`histlake.operators.sizing.key_stats`); otherwise the set is merged.
    Left to itself the planner broadcasts by the size of the files, and keys
    that are packed well then fill the memory of every task.
    """
    cols = [*keys, *extra]
    ks = df.select(*[F.col(c).alias(_R + c) for c in cols]).distinct()
    return F.broadcast(ks) if broadcast else ks.hint("merge")


def _on(keys: Sequence[str], extra: Sequence[str], left: DataFrame, right: DataFrame,
        null_safe: bool) -> Column:
    conds = []
    for c in keys:
        conds.append(left[c].eqNullSafe(right[_R + c]) if null_safe else left[c] == right[_R + c])
    for c in extra:
        conds.append(left[c] == right[_R + c])
    return reduce(lambda a, b: a & b, conds)


def matched(open_rows: DataFrame, arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current versions whose key arrives again (semi join: no fan-out)."""
    ks = key_set(arrivals, keys)
    return open_rows.join(ks, _on(keys, (), open_rows, ks, False), "left_semi")


def unmatched(open_rows: DataFrame, arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current versions whose key did not arrive (anti join)."""
    ks = key_set(arrivals, keys)
    return open_rows.join(ks, _on(keys, (), open_rows, ks, False), "left_anti")


def flag_matches(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 extra: Sequence[str] = (), null_safe: bool = False,
                 broadcast: bool = False, flag: str = "_hit") -> DataFrame:
    """``left`` plus a boolean ``flag``: does ``right`` hold the same keys?

    One left outer join against the distinct key set gives J1 and J2 in a
    single pass; the caller splits or stamps on the flag.
    """
    ks = key_set(right, keys, extra, broadcast=broadcast).withColumn(_R + flag, F.lit(True))
    joined = left.join(ks, _on(keys, extra, left, ks, null_safe), "left_outer")
    return joined.select(*[left[c] for c in left.columns],
                         F.coalesce(ks[_R + flag], F.lit(False)).alias(flag))


def with_checksum(df: DataFrame, cols: Sequence[str] | None = None, strict: bool = True,
                  name: str = CHECKSUM) -> DataFrame:
    cols = list(cols) if cols is not None else business_columns(df)
    return df.withColumn(name, row_checksum(cols, strict))


class SnapshotDiff(NamedTuple):
    opened: DataFrame     # new rows whose key+content is not current: to open
    closed: DataFrame     # current rows whose key+content vanished: to close
    kept: DataFrame       # current rows present unchanged: untouched


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  strict: bool = True) -> SnapshotDiff:
    """Both differences of two snapshots on key + content, and the overlap.

    ``old`` may carry technical columns; the checksum covers the business
    columns of ``new``.  Duplicates on the left of each difference are kept
    (a set difference on the check key, not ``EXCEPT``).  The check key is
    one struct of the keys and the checksum: never null and equal when its
    null fields are, so keys compare null-safe (as the text check key of
    the original does) while the distinct key sets' partitioning serves the
    joins directly.  Written into one DataFrame (union) the three branches
    share their exchanges.
    """
    cols = business_columns(new)
    o = with_checksum(old, cols, strict)
    n = with_checksum(new, cols, strict)

    def ck(df: DataFrame) -> Column:
        return F.struct(*[df[k] for k in keys], df[CHECKSUM])

    nk = n.select(ck(n).alias("_r_ck")).distinct()
    ok = o.select(ck(o).alias("_r_ck")).distinct()
    return SnapshotDiff(opened=n.join(ok, ck(n) == ok["_r_ck"], "left_anti"),
                        closed=o.join(nk, ck(o) == nk["_r_ck"], "left_anti"),
                        kept=o.join(nk, ck(o) == nk["_r_ck"], "left_semi"))


def _checksum_halves(ck: Column) -> tuple[Column, Column]:
    """The 128-bit checksum as two decimal(20,0) numbers (hash-aggregatable)."""
    def half(a: int) -> Column:
        return F.conv(F.substring(ck, a, 16), 16, 10).cast("decimal(20,0)")
    return half(1), half(17)


def change_report(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  strict: bool = True) -> DataFrame:
    """One row per key with ``change`` in new / deleted / updated / kept.

    Each side is first reduced to one row per key -- row count and the
    lowest and highest checksum, taken per 64-bit half so the aggregation
    stays hash-based with partial aggregation before the shuffle (skew-safe).
    The key travels as one struct: never null, its null fields compare
    equal, so the full outer join is null-safe and reuses the aggregation's
    partitioning.  A key is ``kept`` only if every row of it on both sides
    has the same content.
    """
    cols = business_columns(new)
    kstruct = F.struct(*[F.col(k) for k in keys])

    def per_key(df: DataFrame, tag: str) -> DataFrame:
        hi, lo = _checksum_halves(row_checksum(cols, strict))
        return (df.select(kstruct.alias("_k"), hi.alias("_hi"), lo.alias("_lo"))
                  .groupBy("_k")
                  .agg(F.count(F.lit(1)).alias(f"{tag}_rows"),
                       F.min("_hi").alias(f"{tag}_hi_min"), F.max("_hi").alias(f"{tag}_hi_max"),
                       F.min("_lo").alias(f"{tag}_lo_min"), F.max("_lo").alias(f"{tag}_lo_max")))

    o = per_key(old, "old")
    n = per_key(new, "new").withColumnRenamed("_k", "_r_k")
    j = o.join(n, o["_k"] == n["_r_k"], "full_outer")
    same = ((F.col("old_hi_min") == F.col("old_hi_max")) & (F.col("old_lo_min") == F.col("old_lo_max"))
            & (F.col("new_hi_min") == F.col("new_hi_max")) & (F.col("new_lo_min") == F.col("new_lo_max"))
            & (F.col("old_hi_min") == F.col("new_hi_min")) & (F.col("old_lo_min") == F.col("new_lo_min")))
    change = (F.when(F.col("old_rows").isNull(), "new")
               .when(F.col("new_rows").isNull(), "deleted")
               .when(same, "kept")
               .otherwise("updated"))
    key = F.coalesce(F.col("_k"), F.col("_r_k"))
    return j.select(*[key.getField(k).alias(k) for k in keys],
                    change.alias("change"),
                    F.coalesce("old_rows", F.lit(0)).alias("old_rows"),
                    F.coalesce("new_rows", F.lit(0)).alias("new_rows"))
