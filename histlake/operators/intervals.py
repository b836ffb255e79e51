"""Versions that only repeat their predecessor are joined with it.

An upsert closes and reopens every key that arrives, changed or not, so a key
that is delivered each day gets a version a day.  Reading the history then
wants the stretches over which the content stayed the same: gaps and islands
over half-open intervals, compared by the content's checksum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import business_columns, row_checksum
from .asof import TimeChunks
from .hotkeys import is_hot


def _islands(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` (group, _ck, _s, _e, _first, _last, _n) with neighbours of equal
    content joined where one ends when the next starts."""
    order = Window.partitionBy(*group).orderBy("_s", "_e", "_ck", "_first")
    before = F.lag(F.struct("_ck", "_e")).over(order)
    joins = F.coalesce((before["_ck"] == F.col("_ck")) & (before["_e"] == F.col("_s")), F.lit(False))
    numbered = rows.withColumn("_new", F.when(joins, 0).otherwise(1)).withColumn(
        "_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # grouped by what the window is partitioned by and more: no further shuffle
    return numbered.groupBy(*group, "_island").agg(
        F.first("_ck").alias("_ck"), F.min("_s").alias("_s"), F.max("_e").alias("_e"),
        F.min_by("_first", "_s").alias("_first"), F.max_by("_last", "_s").alias("_last"), F.sum("_n").alias("_n"))


def coalesce_versions(history: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                      parts: int | None = None) -> DataFrame:
    """The history with equal adjacent versions joined.

    Adjacent are versions of one key of which one ends when the other starts;
    equal are those whose columns ``cols`` (default: all business columns)
    agree.  A joined version keeps the id, start and content of its first
    version and the load time, end, status and slot of its last; ``versions``
    tells how many it stands for.  Columns outside ``cols`` are those of the
    first.  A gap in time, however short, keeps versions apart.

    One shuffle, by key.  A key that holds many versions is cut by time; its
    chunks are joined on their own, then the outermost two of each chunk
    (a few rows) once more.
    """
    if not keys:
        raise ValueError("coalesce_versions needs the key columns")
    parts = parts or int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = list(cols) if cols is not None else business_columns(history)
    tail = ["dl_loaded_dt", "dl_end_dt", "dl_status", "day"]
    head = [c for c in history.columns if c not in set(tail) | set(keys)]
    rows = history.select(
        *keys, row_checksum(cols).alias("_ck"), F.col("dl_start_dt").alias("_s"), F.col("dl_end_dt").alias("_e"),
        F.struct(*head).alias("_first"), F.struct(*tail).alias("_last"), F.lit(1).cast("bigint").alias("_n"))
    chunks = TimeChunks(rows.select(*keys, "_s"), keys, "_s", parts)
    if not chunks.borders:
        done = _islands(rows, keys)
    else:
        local = _islands(rows.withColumn("_c", chunks.of_version(F.col("_s"))), [*keys, "_c"])
        last = Window.partitionBy(*keys, "_c")
        outer = (F.col("_island") == 1) | (F.col("_island") == F.max("_island").over(last))
        local = local.withColumn("_outer", outer & is_hot(keys, chunks.hot))
        kept = [*keys, "_ck", "_s", "_e", "_first", "_last", "_n"]
        done = local.where(~F.col("_outer")).select(kept).unionByName(
            _islands(local.where("_outer").select(kept), keys).select(kept))
    return done.select(
        *[F.col("_first").getField(c).alias(c) if c in head else F.col("_last").getField(c).alias(c) if c in tail
          else F.col(c) for c in history.columns], F.col("_n").alias("versions"))
