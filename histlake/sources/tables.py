"""Catalog tables of the three layers and the writes that keep them whole.

Writes follow one rule: compute into a staged parquet folder first, then
publish (:mod:`histlake.sources.publish`).  A slice of the main table is never overwritten by a plan that is
still reading it, and a slice that receives no rows is emptied rather than
left stale.  All appends go by column *name* (:func:`append_by_name`), never
by position.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import expired
from ..operators.stamps import STATUS_SUPERSEDED
from ..plans.spec import TableSpec


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _ddl(fields: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in fields)


def _spark_ddl_type(type_text: str) -> str:
    from ..plans.spec import spark_type
    return spark_type(type_text).simpleString()


def create_layers(spark: SparkSession, spec: TableSpec, root: str) -> None:
    """Create database and the f / ff / m tables under ``root``.

    * f: tab text, every column text (typed later by ``conform``);
    * ff: parquet, partitioned by ``day``;
    * m: parquet, partitioned by ``(dl_status, day)``; with ``spec.buckets``
      also bucketed by the key, so the key join of later loads reads the
      current slice without shuffling it.
    """
    db = spec.database
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{root}/{db}.db'")
    biz = [(c, _spark_ddl_type(t)) for c, t in spec.columns]
    text = [(c, "string") for c, _ in spec.columns]
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {_q(spec.f_table)} ({_ddl(text)})
                  USING csv OPTIONS (sep '\\t', nullValue '\\\\N', quote '')
                  LOCATION '{root}/{spec.prefixes[0]}{spec.name}'""")
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {_q(spec.ff_table)}
                  ({_ddl([*biz, ("dl_loaded_dt", "timestamp_ntz"), ("day", "int")])})
                  USING parquet PARTITIONED BY (day)
                  LOCATION '{root}/{spec.prefixes[1]}{spec.name}'""")
    m_fields = [("dl_id", "string"), *biz, ("dl_loaded_dt", "timestamp_ntz"),
                ("dl_start_dt", "timestamp_ntz"), ("dl_end_dt", "timestamp_ntz"),
                ("dl_status", "string"), ("day", "int")]
    bucket = ""
    if spec.buckets:
        keys = ", ".join(f"`{k}`" for k in spec.keys)
        bucket = f"CLUSTERED BY ({keys}) INTO {int(spec.buckets)} BUCKETS"
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {_q(spec.m_table)} ({_ddl(m_fields)})
                  USING parquet PARTITIONED BY (dl_status, day) {bucket}
                  LOCATION '{root}/{spec.prefixes[2]}{spec.name}'""")


def drop_layers(spark: SparkSession, spec: TableSpec, purge: bool = False) -> None:
    """Roll back :func:`create_layers`: the catalog entries and, with
    ``purge``, the data of ff and m (the raw extract f is the source's)."""
    folders = []
    if purge:
        for t in (spec.ff_table, spec.m_table):
            if spark.catalog.tableExists(t):
                folders += [partition_location(spark, t, p) for p in partitions(spark, t)]
                folders.append(table_location(spark, t))
    for t in (spec.f_table, spec.ff_table, spec.m_table):
        spark.sql(f"DROP TABLE IF EXISTS {_q(t)}")
    for folder in folders:
        delete_path(spark, folder)


def aligned(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """``df`` with the target's columns, in the target's order and types.

    Raises when a target column is missing or ``df`` has columns the target
    does not know: a load never lands values in the wrong column.
    """
    target = spark.table(table).schema
    have = set(df.columns)
    missing = [f.name for f in target.fields if f.name not in have]
    extra = sorted(have - {f.name for f in target.fields})
    if missing or extra:
        raise ValueError(f"{table}: missing columns {missing}, unknown columns {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def append_by_name(df: DataFrame, table: str) -> None:
    """Append aligned by column name and type (dynamic partitions)."""
    spark = df.sparkSession
    aligned(df, spark, table).write.insertInto(table)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Materialise ``df`` as parquet in a run folder and read it back.

    The written folder is the lineage cut: later steps (and retries after a
    lost executor) read the files, not the plan that produced them.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partition specs of ``table`` as dicts (metadata only)."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {_q(table)}").collect():
        spec = {}
        for part in row[0].split("/"):
            k, _, v = part.partition("=")
            spec[k] = v
        out.append(spec)
    return out


def _spec_sql(spec: dict) -> str:
    parts = []
    for k, v in spec.items():
        parts.append(f"`{k}`={int(v)}" if k == "day" else f"`{k}`='{v}'")
    return ", ".join(parts)


def drop_partitions(spark: SparkSession, table: str, purge: bool = True, **match) -> int:
    """Drop every partition whose spec matches ``match``.

    A partial spec is expanded by listing the partitions first, so it works
    the same on every catalog (a partial ``DROP PARTITION`` silently does
    nothing on some).  Dropping a partition of a table with its own
    location only forgets it, and its files would come back with the next
    write to the same slot; with ``purge`` the partition folders are
    deleted too.  Returns the number dropped.
    """
    want = {k: str(v) for k, v in match.items()}
    hits = [p for p in partitions(spark, table) if all(p.get(k) == v for k, v in want.items())]
    if not hits:
        return 0
    locs = [partition_location(spark, table, p) for p in hits]
    specs = ", ".join(f"PARTITION ({_spec_sql(p)})" for p in hits)
    spark.sql(f"ALTER TABLE {_q(table)} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(table)
    if purge:
        for loc in locs:
            delete_path(spark, loc)
    return len(hits)


# ------------------------------------------------------------ stage tables
SCRATCH_DB = "histlake_scratch"


def scratch_database(spark: SparkSession) -> str:
    """A database for stage tables, kept under the shared checkpoint folder."""
    from ..session import checkpoint_root
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{SCRATCH_DB}` "
              f"LOCATION '{checkpoint_root(spark)}/histlake/{SCRATCH_DB}.db'")
    return SCRATCH_DB


def write_stage_table(df: DataFrame, like: str, path: str) -> str:
    """Write ``df`` once, in ``like``'s layout, into a stage table at ``path``.

    The stage table is created ``LIKE`` the target -- same columns,
    partitioning and buckets -- so its partition folders can later become
    the target's partitions without another copy.
    """
    spark = df.sparkSession
    name = f"{scratch_database(spark)}.s_{uuid.uuid4().hex[:16]}"
    spark.sql(f"CREATE TABLE {_q(name)} LIKE {_q(like)} USING parquet LOCATION '{path}'")
    aligned(df, spark, name).write.insertInto(name)
    return name


def partition_location(spark: SparkSession, table: str, spec: dict) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)} PARTITION ({_spec_sql(spec)})").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system holds it (Hadoop FS API)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


_PLAIN_VALUE = re.compile(r"^[A-Za-z0-9_.-]+$")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def _staged_locations(spark: SparkSession, stage_table: str, parts: list[dict]) -> list[str]:
    """Folders of stage partitions: derived from the stage's own location when
    every value is plain text (the default folder layout), else looked up."""
    root = table_location(spark, stage_table)
    out = []
    for p in parts:
        if all(_PLAIN_VALUE.match(v) for v in p.values()):
            out.append(root + "/" + "/".join(f"{k}={v}" for k, v in p.items()))
        else:
            out.append(partition_location(spark, stage_table, p))
    return out


def _matching(parts: list[dict], match: dict) -> list[dict]:
    want = {k: str(v) for k, v in match.items()}
    return [p for p in parts if all(p.get(k) == v for k, v in want.items())]


def _pkey(p: dict) -> tuple:
    return tuple(sorted(p.items()))


def _add_partitions(spark: SparkSession, table: str, parts: list[dict], locs: list[str]) -> None:
    if parts:
        clauses = " ".join(f"PARTITION ({_spec_sql(p)}) LOCATION '{loc}'"
                           for p, loc in zip(parts, locs))
        spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS {clauses}")


def write_layout(df: DataFrame, partition_cols: Sequence[str], bucketed: bool) -> DataFrame:
    """Row placement for a partitioned write.

    Unbucketed: a ``rebalance`` on the partition columns, so every task
    writes one partition and AQE sizes the files (no file per task and
    partition).  Bucketed: unchanged -- the key-partitioned join output
    already holds one bucket per task.
    """
    return df if bucketed else df.hint("rebalance", *partition_cols)


def rotate_slot(spark: SparkSession, table: str, day: int, status: str | None = None) -> int:
    """Empty one reused slot before it is written again."""
    match = {"day": day} if status is None else {"dl_status": status, "day": day}
    return drop_partitions(spark, table, **match)


def expired_survivors(spark: SparkSession, m_table: str, before, run_dir: str,
                      statuses: Sequence[str] = (STATUS_SUPERSEDED,), keys: Sequence[str] = (),
                      buckets: int | None = None) -> tuple[list, str | None]:
    """Stage what stays when closed versions that ended before ``before`` go.

    Only the ``(status, day)`` partitions holding expiring rows are touched:
    their survivors are written once into a stage table in the table's
    layout, on a table bucketed by ``keys`` a bucket a task.  Returns the
    touched partitions and the stage table.
    """
    m = spark.table(m_table)
    cond = expired(m, before, statuses)
    touched = [(r.dl_status, r.day) for r in
               m.filter(cond).select("dl_status", "day").distinct().collect()]
    if not touched:
        return [], None
    in_touched = F.lit(False)
    for s, d in touched:
        in_touched = in_touched | ((F.col("dl_status") == s) & (F.col("day") == d))
    survivors = m.filter(in_touched & ~cond)
    if buckets:
        # a plain repartition by the key would be dropped in favour of the scan's buckets,
        # and then the scan reads without them
        survivors = survivors.repartitionById(buckets, F.pmod(F.hash(*keys), F.lit(buckets)).cast("int"))
    survivors = write_layout(survivors, ["dl_status", "day"], bool(buckets))
    return touched, write_stage_table(survivors, m_table, f"{run_dir}/expire")
