"""Upsert batches that come after later ones (see :mod:`histlake.operators.late`)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.slots import TS_FORMAT, batch_datetime, batch_text, slot_of, ts_lit
from ..operators.dedup import latest_per_key
from ..operators.hotkeys import hot_keys, place_by_key
from ..operators.late import late_facts, late_rows
from ..operators.stamps import clean_required, stamp_load
from ..sources.publish import Publication, finish_pending, was_published
from ..sources.tables import partitions, stage
from .loads import LoadResult, _arrivals, _run_dir, _stage_main, _stage_ods, _verify, job_session
from .spec import TableSpec


def _guard_minute(m: DataFrame, spec: TableSpec, bt: str) -> None:
    """Ids hold the batch minute: no other batch of the table may have it."""
    minute = batch_datetime(bt).replace(second=0)
    upto = minute + _dt.timedelta(minutes=1)
    hit = m.filter((F.col("dl_start_dt") >= ts_lit(minute.strftime(TS_FORMAT)))
                   & (F.col("dl_start_dt") < ts_lit(upto.strftime(TS_FORMAT))))
    if hit.select("dl_start_dt").limit(1).collect():
        raise ValueError(f"{spec.name}: another batch was loaded in the minute of {bt}")


def upsert_late(spark: SparkSession, spec: TableSpec, batch_ts, arrivals: DataFrame | None = None,
                run_dir: str | None = None, dedupe_arrivals: Sequence[str] | None = None, check_ids: bool = True,
                ori_id=None, purge: bool = True) -> LoadResult:
    """P2 for a batch the table has passed: the history becomes what it would be
    had the batch been upserted in its turn.

    The table's versions that end after the batch time are read by key and
    times only; of the partitions, those holding a version that is split are
    rewritten, others at most get rows added.  (A batch that is not late gives
    what :func:`upsert` gives, without its short cuts.)
    """
    if not spec.keys:
        raise ValueError(f"{spec.name}: upsert needs a primary key")
    bt = batch_text(batch_ts)
    slot = slot_of(bt, "month")
    rd = _run_dir(spark, run_dir, f"late-{spec.name}")
    finish_pending(spark, spec)
    if was_published(spark, spec, "upsert", bt) or was_published(spark, spec, "late", bt):
        return LoadResult(spec.name, "upsert_late", bt, slot, rd, {"resumed": True})
    _guard_minute(spark.table(spec.m_table), spec, bt)
    src = _arrivals(spark, spec, arrivals)
    if dedupe_arrivals:
        src = latest_per_key(src, spec.keys, list(dedupe_arrivals))
    n_stage = _stage_ods(spark, spec, stamp_load(src, bt, slot), rd)
    job = job_session(spark, spec)
    n = job.table(n_stage)
    clean = clean_required(n, spec.required_all, spec.extra_filter).select(*spec.column_names)
    m = job.table(spec.m_table)
    # a table of its own: read twice, and one shuffled side AQE may split against
    stage(late_facts(m, clean, spec.keys, bt), f"{rd}/facts")
    facts = job.read.parquet(f"{rd}/facts")
    touched = {(r["dl_status"], r["day"]) for r in
               facts.select(F.explode("slots").alias("s")).select("s.*").distinct().collect()}
    where = F.lit(False)
    for status, day in touched:
        where = where | ((F.col("dl_status") == status) & (F.col("day") == day))
    rows = late_rows(m.filter(where), clean, facts, spec.keys, bt, slot, ori_id)
    if spec.buckets:
        rows = place_by_key(rows, spec.keys, spec.buckets, hot_keys(n, spec.keys, spec.buckets), ["dl_id"])
    staged = _stage_main(spec, rows, rd)
    counts = _verify(spark.table(staged), bt, slot, check_ids and ori_id is not None)
    out = Publication(spark, spec, "late", bt)
    for status, day in sorted(touched):
        out.relocate(spec.m_table, staged, {"dl_status": status, "day": day}, purge)
    for p in partitions(spark, staged):
        if (p["dl_status"], int(p["day"])) not in touched:
            out.append(spec.m_table, staged, p)
    out.append(spec.ff_table, n_stage, {})
    out.forget(staged)
    out.forget(n_stage)
    out.delete(f"{rd}/facts")
    out.run()
    counts.update(rewritten=len(touched), resumed=False)
    return LoadResult(spec.name, "upsert_late", bt, slot, rd, counts)


__all__ = ["upsert_late"]
