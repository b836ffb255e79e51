"""Keys that hold many rows: found by a sketch, spread over several tasks.

A table bucketed by its key sends all rows of a key to one task.  A key that
holds more than twice an even task's share is found by a frequent-items sketch
of the key hashes (one pass over the key columns, partial per task, no shuffle
of keys; its error is below an even share, so no such key is missed).  Only
the placing of rows depends on it, never the result: keys sharing a hash are
spread alike.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVEN_SHARES = 2              # a key holding more than so many tasks' even share is spread
_SKETCH_LIMIT = 1_000_000    # the most items the sketch can track


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int) -> dict[int, int]:
    """Hash of every hot key and the number of tasks (of ``parts``) to spread
    it over: its rows in even shares, so the numbers add up to ``parts`` or so."""
    if parts <= EVEN_SHARES:
        return {}
    tracked = min(max(1000, 4 * parts), _SKETCH_LIMIT)
    names = ", ".join(f"`{k}`" for k in keys)
    row = df.agg(F.expr(f"approx_top_k(xxhash64({names}), {min(parts, tracked)}, {tracked})").alias("top"),
                 F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: min(parts, math.ceil(r["count"] * parts / row["n"])) for r in row["top"] or []
            if r["count"] * parts > EVEN_SHARES * row["n"]}


def is_hot(keys: Sequence[str], hot: Mapping[int, int]) -> Column:
    return key_hash(keys).isin(list(hot))


def place_by_key(df: DataFrame, keys: Sequence[str], parts: int, hot: Mapping[int, int],
                 by: Sequence[str]) -> DataFrame:
    """One bucket of ``parts`` a task; a hot key's rows go to its bucket's
    task and the following ones, dealt by the columns ``by``.  A task then
    writes its own bucket's file and at most those of the hot keys it helps."""
    if not hot:
        return df.repartition(parts, *keys)
    wide = F.create_map(*[F.lit(x).cast("bigint" if i % 2 == 0 else "int") for kv in hot.items()
                          for i, x in enumerate(kv)])
    width = F.coalesce(F.try_element_at(wide, key_hash(keys)), F.lit(1))
    salt = F.pmod(F.xxhash64(*by), width)
    # the hash is the one of the table's buckets
    return df.repartitionById(parts, F.pmod(F.hash(*keys) + salt, F.lit(parts)).cast("int"))
