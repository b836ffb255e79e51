"""The user-facing loads over catalog tables (P1-P6, run_all).

Each load freezes one batch time, stages what it reads from the raw layer,
computes the new main-table rows as ONE plan, stages them, checks them, and
only then swaps them in; the ODS copy is appended last, once the rest has
succeeded.  Every step is a Spark job over the whole tables; the driver only
sees counts and partition lists.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.slots import batch_text, slot_of
from ..operators.dedup import drop_exact_duplicates, latest_per_key, loaded_since_midnight
from ..operators.evolve import evolved_repair_rows
from ..operators.hotkeys import hot_keys, place_by_key
from ..operators.scd2 import backfill_rows, repair_rows, upsert_parts
from ..operators.sizing import DEFAULT_BROADCAST_BYTES, key_stats
from ..operators.stamps import (STATUS_CURRENT, STATUS_SNAPSHOT, STATUS_SUPERSEDED,
                                clean_required, close_rows,
                                current, open_rows, stamp_load)
from ..session import new_run_dir
from ..sources.keyindex import days_with, indexed_days, refresh_index
from ..sources.publish import Publication, finish_pending, was_published
from ..sources.raw import conform, read_raw, split_raw
from ..sources.tables import (delete_path, expired_survivors, partitions, stage, table_location, write_layout,
                              write_stage_table)
from .evolution import column_versions
from .spec import TableSpec


@dataclass
class LoadResult:
    table: str
    load: str
    batch_ts: str
    slot: int
    run_dir: str
    counts: dict = field(default_factory=dict)


def _run_dir(spark: SparkSession, run_dir: str | None, label: str) -> str:
    """A folder no other load writes to: published partitions live in it."""
    return f"{run_dir.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}" if run_dir else new_run_dir(spark, label)


def read_source(spark: SparkSession, spec: TableSpec, rejects: str | None = None, escaped: bool = False) -> DataFrame:
    """The raw layer f, typed by the spec (unparsable values become null).

    With ``rejects`` lines without the declared number of fields are written
    there (file, position, reason, fields, line) instead of being read with
    fields missing or dropped; ``escaped`` undoes the raw format's escapes.
    """
    path = table_location(spark, spec.f_table)
    if rejects is None:
        return conform(read_raw(spark, path, spec.column_names, escaped), spec.schema)
    split = split_raw(spark, path, spec.column_names, escaped)
    split.rejected.write.mode("overwrite").parquet(rejects)
    return conform(split.good, spec.schema)


def _arrivals(spark: SparkSession, spec: TableSpec, arrivals: DataFrame | None) -> DataFrame:
    src = arrivals if arrivals is not None else read_source(spark, spec)
    return src.select(*[F.col(c) for c in spec.column_names])


#: partitions whose files one writing task holds open at once; more are sorted first
OPEN_FILES = 4


def job_session(spark: SparkSession, spec: TableSpec) -> SparkSession:
    """The session for a main-table job, lined up with the table's buckets.

    A task writes rows of a few partitions, so it keeps their files open
    instead of sorting all its rows by partition in memory.
    Spark keeps a bucketed side unshuffled only if its bucket count is at
    least ``spark.sql.shuffle.partitions``, and a join on key + checksum
    only reuses a layout bucketed by the key when co-partitioning on a
    subset of the join keys is allowed.  Both are set in a child session
    that shares the catalog, so the caller's settings and loads running
    beside this one are untouched.
    """
    child = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            child.conf.set(k, v)
    child.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    if not spec.buckets:
        return child
    child.conf.set("spark.sql.shuffle.partitions", str(spec.buckets))
    child.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return child


def _verify(staged: DataFrame, bt: str, slot: int, check_ids: bool) -> dict:
    """Row counts per status of a staged result, and unique new ids (of
    caller-given row numbers; the loads' own are unique by construction).

    The counts group by a partition column only (no data pages are read);
    the id check reads only today's current partition, where every row
    opened by this batch lives.
    """
    from ..functions.slots import ts_lit
    counts = {r["dl_status"]: r["count"] for r in staged.groupBy("dl_status").count().collect()}
    if check_ids:
        opened = staged.filter((F.col("dl_status") == STATUS_CURRENT) & (F.col("day") == slot)
                               & (F.col("dl_start_dt") == ts_lit(bt)))
        dup = opened.groupBy("dl_id").count().filter("count > 1").limit(1).collect()
        if dup:
            raise RuntimeError(f"surrogate id {dup[0]['dl_id']} issued twice in batch {bt}")
    return counts


def _any(df: DataFrame) -> bool:
    return len(df.limit(1).collect()) > 0


def _guard_batch_time(spark: SparkSession, spec: TableSpec, bt: str) -> None:
    """Refuse a batch time that the current slice has reached already.

    Ids embed the batch minute, so another batch in the same minute could
    repeat ids, and an earlier batch time would give inverted intervals.
    The filter is on a column that is constant per written file, so parquet
    statistics skip nearly every row group.
    """
    from ..functions.slots import TS_FORMAT, batch_datetime, ts_lit
    minute = batch_datetime(bt).replace(second=0)
    late = current(spark.table(spec.m_table)).filter(F.col("dl_start_dt") >= ts_lit(minute.strftime(TS_FORMAT)))
    clash = late.agg(F.max("dl_start_dt").cast("string")).first()[0]
    if clash is not None:
        raise ValueError(f"{spec.name}: current versions start at {clash}, not before the "
                         f"minute of batch {bt}; use a later batch time, or upsert_late")


def _resume(spark: SparkSession, spec: TableSpec, load: str, bt: str) -> bool:
    """Finish what a failed load left; True if this batch is published now."""
    finish_pending(spark, spec)
    if was_published(spark, spec, load, bt):
        return True
    _guard_batch_time(spark, spec, bt)
    return False


def _changed_days(cur: DataFrame, arrivals: DataFrame, spec: TableSpec, small: bool) -> set[int]:
    """Day partitions of the current slice that hold a key arriving now.

    Reads only the key columns of the slice (``day`` is a partition value),
    semi-joined with the cleaned arrivals' distinct keys -- broadcast when
    measured small, else a shuffle of keys only.  At most 31 values return.
    """
    from ..operators.match import key_set
    clean = clean_required(arrivals, spec.required_all, spec.extra_filter)
    ks = key_set(clean, spec.keys, broadcast=small)
    cond = None
    for k in spec.keys:
        c = cur[k] == ks["_r_" + k]
        cond = c if cond is None else cond & c
    hit = cur.select(*spec.keys, "day").join(ks, cond, "left_semi")
    return {int(r["day"]) for r in hit.select("day").distinct().collect()}


def _stage_main(spec: TableSpec, rows: DataFrame, rd: str) -> str:
    """Write the new main-table rows once, in the table's own layout."""
    return write_stage_table(write_layout(rows, ["dl_status", "day"], bool(spec.buckets)),
                             spec.m_table, f"{rd}/m")


def _stage_ods(spark: SparkSession, spec: TableSpec, rows: DataFrame, rd: str,
               name: str = "ff", placed: bool = False) -> str:
    """Rows in the ODS table's layout, written once into the run folder.
    ``placed``: they are of one day and come from a shuffle, which need not be repeated."""
    return write_stage_table(write_layout(rows, ["day"], placed), spec.ff_table, f"{rd}/{name}")


def upsert(spark: SparkSession, spec: TableSpec, batch_ts, arrivals: DataFrame | None = None,
           run_dir: str | None = None, broadcast_limit: int = DEFAULT_BROADCAST_BYTES,
           dedupe_arrivals: Sequence[str] | None = None, check_ids: bool = True,
           ori_id=None, purge: bool = True, only_changed_days: bool = True,
           key_index: bool = False) -> LoadResult:
    """Incremental upsert of arrivals (default: the raw layer f).

    Every arriving key closes its current version and opens the arrival.
    ``dedupe_arrivals=[order cols]`` keeps only the newest arrival per key
    first (otherwise several arrivals of one key all open, as originally).
    The arrivals' key set is broadcast only when measured under
    ``broadcast_limit`` bytes.  With ``only_changed_days`` (default) only
    the current-slice day partitions holding an arriving key, plus today's
    slot, are read, rewritten and swapped; the others stay untouched.
    ``key_index`` keeps a Bloom filter and key range per day beside the table
    and asks these, instead of the slice's keys, which days hold an arriving
    key (a day it errs on is read and rewritten without need).
    """
    if not spec.keys:
        raise ValueError(f"{spec.name}: upsert needs a primary key")
    bt = batch_text(batch_ts)
    slot = slot_of(bt, "month")
    rd = _run_dir(spark, run_dir, f"upsert-{spec.name}")
    if _resume(spark, spec, "upsert", bt):
        return LoadResult(spec.name, "upsert", bt, slot, rd, {"resumed": True})
    src = _arrivals(spark, spec, arrivals)
    if dedupe_arrivals:
        src = latest_per_key(src, spec.keys, list(dedupe_arrivals))
    n_stage = _stage_ods(spark, spec, stamp_load(src, bt, slot), rd, placed=bool(dedupe_arrivals))
    job = job_session(spark, spec)
    n = job.table(n_stage)
    arrived, key_bytes = key_stats(n, spec.keys)
    small = 0 < broadcast_limit and key_bytes <= broadcast_limit
    counts: dict = {}
    cur = current(job.table(spec.m_table))
    days = None
    a_days = {int(p["day"]) for p in partitions(spark, spec.m_table)
              if p.get("dl_status") == STATUS_CURRENT}
    # the key-only pass pays off only when there are other days to leave alone
    if only_changed_days and len(a_days - {slot}) > 1:
        known = indexed_days(spark, spec) if key_index else {}
        unknown = cur.filter(~F.col("day").isin(list(known))) if known else cur
        days = {slot}
        if a_days - set(known):
            days |= _changed_days(unknown, n, spec, small)
        days |= days_with(job, spec, clean_required(n, spec.required_all, spec.extra_filter), known)
        cur = cur.filter(F.col("day").isin(sorted(days)))
        counts["rewritten_days"] = len(days)
    if not a_days:
        cur = cur.filter(F.lit(False))     # nothing to join with
    old, opened = upsert_parts(cur, n, spec.keys, bt,
                               spec.required, spec.extra_filter, slot, ori_id=ori_id,
                               broadcast_keys=small, opened_partitions=spec.buckets,
                               hot=hot_keys(n, spec.keys, spec.buckets) if spec.buckets else None)
    # opened rows are of one partition and come from files of the staged arrivals, in which
    # they are laid out already; the others are dealt by partition if they are of many
    here = a_days if days is None else a_days & days
    old = write_layout(old, ["dl_status", "day"], bool(spec.buckets) or len(here) < OPEN_FILES)
    staged = write_stage_table(old.unionByName(opened), spec.m_table, f"{rd}/m")
    counts.update(_verify(spark.table(staged), bt, slot, check_ids and ori_id is not None))
    within = None if days is None else (lambda p: int(p["day"]) in days)
    out = Publication(spark, spec, "upsert", bt)
    out.append(spec.m_table, staged, {"dl_status": STATUS_SUPERSEDED})
    out.relocate(spec.m_table, staged, {"dl_status": STATUS_CURRENT}, purge, within)
    out.append(spec.ff_table, n_stage, {})
    out.forget(staged)
    out.forget(n_stage)
    out.run()
    if key_index:
        counts["indexed_days"] = refresh_index(spark, spec)
    counts["arrived"] = arrived
    counts["broadcast_keys"] = small
    counts["resumed"] = False
    return LoadResult(spec.name, "upsert", bt, slot, rd, counts)


def repair(spark: SparkSession, spec: TableSpec, batch_ts, run_dir: str | None = None,
           strict: bool = True, clean_first: bool = False, check_ids: bool = True,
           ori_id=None, purge: bool = True) -> LoadResult:
    """Full repair of the current slice from the ODS copy (a full snapshot)."""
    if not spec.keys:
        raise ValueError(f"{spec.name}: repair needs a primary key")
    bt = batch_text(batch_ts)
    slot = slot_of(bt, "month")
    rd = _run_dir(spark, run_dir, f"repair-{spec.name}")
    if _resume(spark, spec, "repair", bt):
        return LoadResult(spec.name, "repair", bt, slot, rd, {"resumed": True})
    job = job_session(spark, spec)
    snap = job.table(spec.ff_table).select(*spec.column_names)
    # On a bucketed table the join lines up with the buckets (the key alone);
    # keys that hold many rows go their own way, spread by checksum.
    parts = spec.buckets or int(job.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(snap, spec.keys, parts)
    versions = column_versions(spark, spec)
    if len(versions) > 1:
        if clean_first or not strict:
            raise ValueError(f"{spec.name}: its columns changed; only the strict repair that cleans last knows how")
        rows = evolved_repair_rows(current(job.table(spec.m_table)), snap, spec.keys, bt, versions, spec.required,
                                   spec.extra_filter, slot, ori_id=ori_id)
        if spec.buckets:
            rows = place_by_key(rows, spec.keys, spec.buckets, hot, ["dl_id"])
    else:
        rows = repair_rows(current(job.table(spec.m_table)), snap, spec.keys, bt, spec.required,
                           spec.extra_filter, slot, ori_id=ori_id, strict=strict,
                           clean_first=clean_first, buckets=spec.buckets, hot=hot, parts=parts)
    staged = _stage_main(spec, rows, rd)
    counts = _verify(spark.table(staged), bt, slot, check_ids and ori_id is not None)
    if hot:
        counts["hot_keys"] = len(hot)
    out = Publication(spark, spec, "repair", bt)
    out.append(spec.m_table, staged, {"dl_status": STATUS_SUPERSEDED})
    out.relocate(spec.m_table, staged, {"dl_status": STATUS_CURRENT}, purge)
    out.forget(staged)
    out.run()
    return LoadResult(spec.name, "repair", bt, slot, rd, counts)


def rebuild_and_repair(spark: SparkSession, spec: TableSpec, batch_ts,
                       snapshot: DataFrame | None = None, run_dir: str | None = None,
                       purge: bool = True, method: Callable[..., LoadResult] | None = None,
                       **repair_kw) -> LoadResult:
    """P5: replace the ODS copy with the full raw extract, then :func:`repair`.

    The extract is written once, as the ODS table's new partitions.  ``method``
    is another repair to run, such as ``repair_by_digest``.
    """
    bt = batch_text(batch_ts)
    slot = slot_of(bt, "month")
    rd = _run_dir(spark, run_dir, f"rebuild-{spec.name}")
    if _resume(spark, spec, "repair", bt):
        return LoadResult(spec.name, "rebuild_and_repair", bt, slot, rd, {"resumed": True})
    counts: dict = {}
    # the new ODS copy is published on its own; a re-run goes on with the repair
    if not was_published(spark, spec, "rebuild", bt):
        staged = _stage_ods(spark, spec, stamp_load(_arrivals(spark, spec, snapshot), bt, slot), rd)
        counts["ods_rows"] = spark.table(staged).count()
        out = Publication(spark, spec, "rebuild", bt)
        out.relocate(spec.ff_table, staged, {}, purge)
        out.forget(staged)
        out.run()
    if method is None:
        res = repair(spark, spec, bt, run_dir=rd, purge=purge, **repair_kw)
    else:
        res = method(spark, spec, bt, run_dir=rd, **repair_kw)
    res.load = "rebuild_and_repair"
    res.counts.update(counts)
    return res


def snapshot_load(spark: SparkSession, spec: TableSpec, batch_ts,
                  snapshot: DataFrame | None = None, run_dir: str | None = None,
                  keep_same_day_history: bool = False, check_ids: bool = True,
                  ori_id=None, purge: bool = True) -> LoadResult:
    """Full snapshot load with a weekly rotating backup slot.

    * ODS: the weekday slot is emptied unless something was loaded into it
      since midnight today (a same-day reload keeps the earlier versions).
    * main: the current slice moves to today's ``P`` slot (replacing what
      was there) and the cleaned snapshot becomes the current slice.
      ``keep_same_day_history=True`` keeps the ``P`` slot on a same-day
      rerun (the new backup is added beside it) instead of discarding the
      earlier snapshot.
    """
    bt = batch_text(batch_ts)
    slot = slot_of(bt, "week")
    rd = _run_dir(spark, run_dir, f"snapshot-{spec.name}")
    if _resume(spark, spec, "snapshot_load", bt):
        return LoadResult(spec.name, "snapshot_load", bt, slot, rd, {"resumed": True})
    reloaded_today = loaded_since_midnight(spark.table(spec.ff_table), slot, bt)
    n_stage = _stage_ods(spark, spec, stamp_load(_arrivals(spark, spec, snapshot), bt, slot), rd)
    job = job_session(spark, spec)
    backup = close_rows(current(job.table(spec.m_table)), bt, STATUS_SNAPSHOT, slot)
    opened = open_rows(clean_required(job.table(n_stage), spec.required_all, spec.extra_filter), bt,
                       slot=slot, ori_id=ori_id)
    if spec.buckets:
        hot = hot_keys(job.table(n_stage), spec.keys, spec.buckets)
        opened = place_by_key(opened, spec.keys, spec.buckets, hot, ["dl_id"])
    staged = _stage_main(spec, backup.unionByName(opened), rd)
    counts = _verify(spark.table(staged), bt, slot, check_ids and ori_id is not None)
    out = Publication(spark, spec, "snapshot_load", bt)
    if keep_same_day_history and reloaded_today:
        out.append(spec.m_table, staged, {"dl_status": STATUS_SNAPSHOT})
    else:
        out.relocate(spec.m_table, staged, {"dl_status": STATUS_SNAPSHOT, "day": slot}, purge)
    out.relocate(spec.m_table, staged, {"dl_status": STATUS_CURRENT}, purge)
    if reloaded_today:
        out.append(spec.ff_table, n_stage, {})
    else:
        out.relocate(spec.ff_table, n_stage, {"day": slot}, purge)
    out.forget(staged)
    out.forget(n_stage)
    out.run()
    counts["reloaded_today"] = reloaded_today
    counts["resumed"] = False
    return LoadResult(spec.name, "snapshot_load", bt, slot, rd, counts)


def ods_dedup(spark: SparkSession, spec: TableSpec, order_cols: Sequence[str],
              by: str = "key", run_dir: str | None = None, purge: bool = True) -> LoadResult:
    """Rewrite the ODS copy without older / repeated rows.

    ``by='key'``: newest row per primary key (``order_cols`` newest first).
    ``by='row'``: rows equal in every business column collapse to the newest.
    The result is written once and its partitions replace the table's.
    """
    if not order_cols:
        raise ValueError("ods_dedup needs the order columns (newest first)")
    finish_pending(spark, spec)
    rd = _run_dir(spark, run_dir, f"dedup-{spec.name}")
    ff = spark.table(spec.ff_table)
    if by == "key":
        kept = latest_per_key(ff, spec.keys, list(order_cols))
    elif by == "row":
        kept = drop_exact_duplicates(ff, spec.keys, list(order_cols))
    else:
        raise ValueError("by must be 'key' or 'row'")
    before = ff.count()
    staged = _stage_ods(spark, spec, kept, rd)
    after = spark.table(staged).count()
    out = Publication(spark, spec, f"ods_dedup_{by}")
    out.relocate(spec.ff_table, staged, {}, purge)
    out.forget(staged)
    out.run()
    return LoadResult(spec.name, f"ods_dedup_{by}", "", 0, rd,
                      {"before": before, "after": after})


def backfill(spark: SparkSession, spec: TableSpec, batches: DataFrame, batch_col: str,
             order_cols: Sequence[str], run_dir: str | None = None, check_ids: bool = True,
             ori_id=None, purge: bool = True) -> LoadResult:
    """P2 over a whole sequence of past batches in one job (see ``backfill_rows``).

    ``batches`` carries the business columns plus ``batch_col``, the load
    time of each row.  The main table ends as it would after one upsert per
    batch (newest arrival per key and batch); the ODS copy receives every
    arrival stamped with its own batch time and day slot.  A run is known by
    its first and last batch time and its number of rows: run again it is
    skipped (or finished), any other run that reaches back to a time the
    table has passed is refused.
    """
    if not spec.keys:
        raise ValueError(f"{spec.name}: backfill needs a primary key")
    finish_pending(spark, spec)
    rd = _run_dir(spark, run_dir, f"backfill-{spec.name}")
    n = stage(batches.select(*spec.column_names, F.col(batch_col).cast("timestamp_ntz")
                             .alias(batch_col)), f"{rd}/arrivals")
    span = n.agg(F.min(batch_col).cast("string"), F.max(batch_col).cast("string"), F.count("*")).first()
    if span[0] is None:
        delete_path(spark, rd)
        return LoadResult(spec.name, "backfill", "", 0, rd, {})
    first = batch_text(span[0])
    run = f"{first}to{batch_text(span[1])}rows{span[2]}"
    if was_published(spark, spec, "backfill", run):
        delete_path(spark, rd)
        return LoadResult(spec.name, "backfill", first, 0, rd, {"resumed": True})
    _guard_batch_time(spark, spec, first)
    job = job_session(spark, spec)
    rows = backfill_rows(current(job.table(spec.m_table)), job.read.parquet(f"{rd}/arrivals"), spec.keys, batch_col,
                         order_cols, spec.required, spec.extra_filter, ori_id=ori_id)
    staged = _stage_main(spec, rows, rd)
    st = spark.table(staged)
    counts: dict = {"resumed": False}
    counts.update({r["dl_status"]: r["count"] for r in st.groupBy("dl_status").count().collect()})
    if check_ids and ori_id is not None:
        from ..functions.slots import ts_lit
        new = st.filter(F.col("dl_start_dt") >= ts_lit(first))
        if new.groupBy("dl_id").count().filter("count > 1").limit(1).collect():
            raise RuntimeError("a surrogate id was issued twice in the backfill")
    ods = n.select(*spec.column_names, F.col(batch_col).alias("dl_loaded_dt"),
                   F.dayofmonth(batch_col).cast("int").alias("day"))
    ods_stage = _stage_ods(spark, spec, ods, rd, "ff_backfill")
    out = Publication(spark, spec, "backfill", run)
    out.append(spec.m_table, staged, {"dl_status": STATUS_SUPERSEDED})
    out.relocate(spec.m_table, staged, {"dl_status": STATUS_CURRENT}, purge)
    out.append(spec.ff_table, ods_stage, {})
    out.forget(staged)
    out.forget(ods_stage)
    out.delete(f"{rd}/arrivals")
    out.run()
    return LoadResult(spec.name, "backfill", first, 0, rd, counts)


def retain(spark: SparkSession, spec: TableSpec, before, run_dir: str | None = None,
           statuses: Sequence[str] = ("H",)) -> LoadResult:
    """S16 on the table: closed versions that ended before ``before`` go."""
    finish_pending(spark, spec)
    rd = _run_dir(spark, run_dir, f"retain-{spec.name}")
    touched, staged = expired_survivors(spark, spec.m_table, before, rd, statuses, spec.keys, spec.buckets)
    if touched:
        out = Publication(spark, spec, "retain")
        for status, day in touched:
            out.relocate(spec.m_table, staged, {"dl_status": status, "day": day})
        out.forget(staged)
        out.run()
    return LoadResult(spec.name, "retain", batch_text(before), 0, rd, {"partitions": len(touched)})


LOADS: dict[str, Callable[..., LoadResult]] = {
    "snapshot_load": snapshot_load, "upsert": upsert, "repair": repair,
    "rebuild_and_repair": rebuild_and_repair, "ods_dedup": ods_dedup, "backfill": backfill,
}


def run_all(spark: SparkSession, specs: Sequence[TableSpec], load: str, *args, **kw) -> DataFrame:
    """One load over many tables; one result row per table.

    A failing table is reported and the loop continues with the next one.
    This loops over *tables* (a short list), never over data.
    """
    fn = LOADS[load]
    rows = []
    for spec in specs:
        try:
            res = fn(spark, spec, *args, **kw)
            rows.append((spec.name, load, "ok", str(res.counts), None))
        except Exception as exc:   # noqa: BLE001 - reported per table
            rows.append((spec.name, load, "failed", None,
                         f"{type(exc).__name__}: {exc}\n{traceback.format_exc(limit=3)}"))
    return spark.createDataFrame(rows, "table string, load string, status string, "
                                       "counts string, error string")


__all__ = ["LOADS", "LoadResult", "backfill", "ods_dedup", "read_source", "rebuild_and_repair", "repair",
           "retain", "run_all", "snapshot_load", "upsert"]
