"""The key index of the current slice, kept beside the main table.

One folder per day partition, named after the partition's files: a partition
that was rewritten, or that got files, has no index until :func:`refresh_index`
writes one, and its old one is never asked.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyindex import blocks_for, build_filter, hit_parts, key_range
from ..operators.stamps import STATUS_CURRENT, current
from ..plans.spec import TableSpec
from .publish import _names
from .tables import delete_path, partition_location, partitions, table_location

_INDEX = "_histlake_index"


def _folders(spark: SparkSession, spec: TableSpec) -> dict[int, str]:
    """Day partition -> name of the index that its present files would have."""
    out = {}
    for p in partitions(spark, spec.m_table):
        if p["dl_status"] == STATUS_CURRENT:
            names = [n for n in _names(spark, partition_location(spark, spec.m_table, p)) if n[0] not in "._"]
            out[int(p["day"])] = f"day{int(p['day']):02d}-{len(names)}x{zlib.crc32('/'.join(names).encode()):08x}"
    return out


def _root(spark: SparkSession, spec: TableSpec) -> str:
    return f"{table_location(spark, spec.m_table)}/{_INDEX}"


def indexed_days(spark: SparkSession, spec: TableSpec) -> dict[int, str]:
    """The days whose index is there and in step with the files."""
    have = set(_names(spark, _root(spark, spec)))
    return {day: name for day, name in _folders(spark, spec).items()
            if name in have and "_SUCCESS" in _names(spark, f"{_root(spark, spec)}/{name}/range")}


def refresh_index(spark: SparkSession, spec: TableSpec) -> list[int]:
    """Index the days that lack one (reads their key columns); returns them."""
    root, folders, have = _root(spark, spec), _folders(spark, spec), indexed_days(spark, spec)
    todo = sorted(set(folders) - set(have))
    for day in todo:
        rows = current(spark.table(spec.m_table)).where(F.col("day") == day).select(*spec.keys)
        found = key_range(rows, spec.keys)
        blocks = blocks_for(found.first()["n"])
        build_filter(rows, spec.keys, blocks).write.mode("overwrite").parquet(f"{root}/{folders[day]}/filter")
        found.withColumn("blocks", F.lit(blocks)).write.mode("overwrite").parquet(f"{root}/{folders[day]}/range")
    for name in set(_names(spark, root)) - set(folders.values()):
        delete_path(spark, f"{root}/{name}")
    return todo


def days_with(spark: SparkSession, spec: TableSpec, arriving: DataFrame, days: dict[int, str]) -> set[int]:
    """Of the indexed ``days`` those that may hold a key of ``arriving``."""
    if not days:
        return set()
    root = _root(spark, spec)

    def table(kind: str) -> DataFrame:
        parts = [spark.read.parquet(f"{root}/{name}/{kind}").withColumn("part", F.lit(day))
                 for day, name in sorted(days.items())]
        return reduce(DataFrame.unionByName, parts)

    keys = arriving.select(*spec.keys).na.drop().distinct()
    return {r["part"] for r in hit_parts(table("filter"), table("range"), keys, spec.keys).collect()}
