"""Many (key, time) rows joined with the version each key had then (V1 for rows).

One sort per key: points and versions are united, ordered by time within
their key, and the last version is carried forward to the points behind it.
No range join, no nested loop, one shuffle.

A key that holds many rows is cut into chunks of time, so that no task gets it
whole (:class:`TimeChunks`); each chunk but the first starts with the version
that was valid at its beginning, which one row per chunk tells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hotkeys import hot_keys, is_hot, key_hash

_POINT, _VERSION, _SEED = 2, 1, 0


class TimeChunks:
    """Chunks of time of the keys that hold many rows of ``rows(keys, at)``.

    Keys above two even shares of ``parts`` tasks (found by a sketch) get
    quantiles of their times as borders, as many as their share asks for, so
    all borders together are about ``parts``.  Every other key has chunk 0.
    """

    def __init__(self, rows: DataFrame, keys: Sequence[str], at: str, parts: int):
        self.keys = list(keys)
        self.hot = hot_keys(rows, self.keys, parts)
        self.borders: dict[int, list] = {}
        if self.hot:
            most = max(self.hot.values())
            cuts = F.percentile_approx(at, [k / most for k in range(1, most)] or [0.5])
            found = rows.where(is_hot(self.keys, self.hot)).groupBy(key_hash(self.keys).alias("h")).agg(
                cuts.cast("array<string>").alias("cuts"))
            for r in found.collect():  # the hot keys only: at most parts / 2 of them
                step = max(1, most // self.hot[r["h"]])
                self.borders[r["h"]] = sorted(r["cuts"])[step - 1::step]

    def _borders(self) -> Column:
        if not self.borders:
            return F.array().cast("array<timestamp_ntz>")
        entries = [F.struct(F.lit(h).cast("bigint"), F.array(*[F.lit(c) for c in cuts]).cast("array<timestamp_ntz>"))
                   for h, cuts in self.borders.items()]
        known = F.map_from_entries(F.array(*entries))
        return F.coalesce(F.try_element_at(known, key_hash(self.keys)), F.array().cast("array<timestamp_ntz>"))

    def of_version(self, at: Column) -> Column:
        """Chunk of a row that begins at ``at``: the first that may need it."""
        b = self._borders()
        before = F.size(F.filter(b, lambda x: x < at))
        return F.when(F.array_contains(b, at), before + 1).otherwise(before).cast("int")

    def of_point(self, at: Column, salt: Column) -> Column:
        """Chunk of a point.  Several borders of one time mean that many points
        have it: they are dealt over the chunks between these borders."""
        b = self._borders()
        before, same = F.size(F.filter(b, lambda x: x < at)), F.size(F.filter(b, lambda x: x == at))
        return F.when(same > 0, before + 1 + F.pmod(salt, F.greatest(same, F.lit(1)).cast("long"))).otherwise(
            before).cast("int")

    def count(self) -> Column:
        """Number of the key's last chunk."""
        return F.size(self._borders())


def _seeds(versions: DataFrame, keys: Sequence[str], chunks: TimeChunks) -> DataFrame:
    """For each chunk of a hot key the last version of the chunks before it."""
    newest = versions.where(is_hot(keys, chunks.hot)).groupBy(*keys, "_c").agg(
        F.max_by(F.struct("_t", "_o", "_v"), F.struct("_t", "_o")).alias("_last"))
    every = newest.select(*keys).distinct().select(
        *keys, F.explode(F.sequence(F.lit(1), chunks.count())).alias("_c"),
        F.lit(None).cast(newest.schema["_last"].dataType).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_c", F.col("_last").isNotNull()).rowsBetween(
        Window.unboundedPreceding, -1)  # as many rows as the key has chunks, twice
    filled = newest.unionByName(every).withColumn("_seed", F.last("_last", ignorenulls=True).over(before))
    return filled.where(F.col("_last").isNull() & F.col("_seed").isNotNull()).select(
        *keys, "_c", F.col("_seed._t").alias("_t"), F.col("_seed._o").alias("_o"), F.col("_seed._v").alias("_v"))


def as_of_join(points: DataFrame, history: DataFrame, keys: Sequence[str], at: str, prefix: str = "v_",
               how: str = "left", parts: int | None = None) -> DataFrame:
    """Every row of ``points`` with the version of its key valid at its time
    ``at`` (``dl_start_dt <= at < dl_end_dt``).

    The history's columns besides the keys get ``prefix``; they are null where
    the key had no version then (``how='inner'`` drops such points).  Versions
    of one key must not overlap; of several that start together the one with
    the largest ``dl_id`` counts.  Points with a null key or time have no
    version.  Points may repeat: every row stays a row.  ``parts`` (default:
    the session's shuffle partitions) is the number of tasks hot keys are
    spread over.
    """
    if not keys:
        raise ValueError("as_of_join needs the key columns")
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    spark = points.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in history.columns if c not in set(keys)]
    time = F.col(at).cast("timestamp_ntz")
    known = time.isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    whole = F.struct(*[F.col(c) for c in points.columns])
    p = points.where(known).select(*keys, time.alias("_t"), whole.alias("_p"))
    v = history.select(*keys, F.col("dl_start_dt").alias("_t"), F.col("dl_id").alias("_o"),
                       F.struct(*[F.col(c) for c in rest]).alias("_v"))
    for k in keys:
        v = v.where(F.col(k).isNotNull())
    chunks = TimeChunks(p.select(*keys, "_t").unionByName(v.select(*keys, "_t")), keys, "_t", parts)
    v = v.withColumn("_c", chunks.of_version(F.col("_t")))
    p = p.withColumn("_c", chunks.of_point(F.col("_t"), F.xxhash64("_p")))
    none_p, none_v = F.lit(None).cast(p.schema["_p"].dataType), F.lit(None).cast(v.schema["_v"].dataType)
    rows = p.select(*keys, "_c", "_t", F.lit(_POINT).alias("_k"), F.lit(None).cast("string").alias("_o"), "_p",
                    none_v.alias("_v"))
    sides = [(v, _VERSION)] + ([(_seeds(v, keys, chunks), _SEED)] if chunks.borders else [])
    for side, kind in sides:
        rows = rows.unionByName(side.select(*keys, "_c", "_t", F.lit(kind).alias("_k"), "_o", none_p.alias("_p"), "_v"))
    order = Window.partitionBy(*keys, "_c").orderBy("_t", "_k", "_o").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = rows.withColumn("_v", F.last("_v", ignorenulls=True).over(order)).where(F.col("_k") == _POINT)
    valid = F.when(F.col("_v.dl_end_dt") > F.col("_t"), F.col("_v"))
    out = carried.select("_p", valid.alias("_v"))
    if how == "left":
        out = out.unionByName(points.where(~known).select(whole.alias("_p"), none_v.alias("_v")))
    else:
        out = out.where(F.col("_v").isNotNull())
    return out.select(*[F.col("_p").getField(c).alias(c) for c in points.columns],
                      *[F.col("_v").getField(c).alias(prefix + c) for c in rest])
