"""Exact-duplicate removal of the ODS copy that rewrites only the days concerned.

Beside the ODS table lies an index per day partition: for every content (its
checksum) the newest load time and the number of rows.  The newest copy of a
content is found from the indexes alone; only days that hold another copy of it
are read and rewritten.  An index is named after the day's files, so a day
that got or lost files has none until it is written again.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import row_checksum
from ..sources.publish import Publication, _names, finish_pending
from ..sources.tables import delete_path, partition_location, partitions, stage, table_location
from .loads import LoadResult, _run_dir, _stage_ods
from .spec import TableSpec

_INDEX = "_histlake_contents"


def _day_names(spark: SparkSession, spec: TableSpec) -> dict[int, str]:
    """Day -> name of the index its present files would have."""
    out = {}
    for p in partitions(spark, spec.ff_table):
        names = [n for n in _names(spark, partition_location(spark, spec.ff_table, p)) if n[0] not in "._"]
        out[int(p["day"])] = f"day{int(p['day']):02d}-{len(names)}x{zlib.crc32('/'.join(names).encode()):08x}"
    return out


def _contents(spark: SparkSession, spec: TableSpec) -> tuple[DataFrame, list[int]]:
    """(day, ck, newest, n) over all days, and the days indexed just now."""
    root = f"{table_location(spark, spec.ff_table)}/{_INDEX}"
    wanted = _day_names(spark, spec)
    built = [day for day, name in sorted(wanted.items()) if "_SUCCESS" not in _names(spark, f"{root}/{name}")]
    for day in built:
        rows = spark.table(spec.ff_table).where(F.col("day") == day)
        rows.groupBy(F.unhex(row_checksum(spec.column_names)).alias("ck")).agg(
            F.max("dl_loaded_dt").alias("newest"), F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
            f"{root}/{wanted[day]}")
    for name in set(_names(spark, root)) - set(wanted.values()):
        delete_path(spark, f"{root}/{name}")
    parts = [spark.read.parquet(f"{root}/{name}").withColumn("day", F.lit(day)) for day, name in sorted(wanted.items())]
    return reduce(DataFrame.unionByName, parts) if parts else None, built


def ods_dedup_days(spark: SparkSession, spec: TableSpec, run_dir: str | None = None, purge: bool = True) -> LoadResult:
    """What ``ods_dedup(by='row')`` leaves with the load time as its order: of
    rows equal in every business column the newest (of the newest the one in
    the smallest day slot).  Days without a superseded row keep their files."""
    finish_pending(spark, spec)
    rd = _run_dir(spark, run_dir, f"dedup-days-{spec.name}")
    index, built = _contents(spark, spec)
    counts: dict = {"indexed_days": built, "rewritten_days": []}
    if index is None:
        return LoadResult(spec.name, "ods_dedup_days", "", 0, rd, counts)
    best = F.struct("newest", (-F.col("day")).alias("d"))
    # contents with more than one row: few, and one row each
    many = stage(index.groupBy("ck").agg(F.max(best).alias("best"), F.sum("n").alias("rows")).where("rows > 1").select(
        "ck", (-F.col("best.d")).alias("home")), f"{rd}/many")
    over = index.join(many, "ck").where((F.col("day") != F.col("home")) | (F.col("n") > 1))
    days = sorted(r["day"] for r in over.select("day").distinct().collect())
    if not days:
        delete_path(spark, rd)
        return LoadResult(spec.name, "ods_dedup_days", "", 0, rd, counts)
    ff = spark.table(spec.ff_table).where(F.col("day").isin(days)).withColumn(
        "ck", F.unhex(row_checksum(spec.column_names)))
    marked = ff.join(many, "ck", "left")
    newest = F.row_number().over(Window.partitionBy("ck").orderBy(F.col("dl_loaded_dt").desc_nulls_last()))
    single = marked.where(F.col("home").isNull())
    one = marked.where(F.col("home") == F.col("day")).withColumn("rn", newest).where("rn = 1").drop("rn")
    staged = _stage_ods(spark, spec, single.unionByName(one).drop("ck", "home"), rd)
    out = Publication(spark, spec, "ods_dedup_days")
    for day in days:
        out.relocate(spec.ff_table, staged, {"day": day}, purge)
    out.forget(staged)
    out.delete(f"{rd}/many")
    out.run()
    counts["rewritten_days"] = days
    return LoadResult(spec.name, "ods_dedup_days", "", 0, rd, counts)


__all__ = ["ods_dedup_days"]
