"""Repair by digest tree: read and rewrite only the buckets that differ.

The current slice's leaf digests are kept beside the main table, under the
name of the publications they were taken after; a load in between makes them
stale, and the next repair takes them anew (one pass over the slice).  A
repair itself leaves them in step: buckets it did not touch keep their digest,
the others get that of their new rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.slots import batch_text, slot_of
from ..operators.digest import bucket_number, differing_leaves, digest_tree, leaf_digests
from ..operators.hotkeys import hot_keys
from ..operators.scd2 import repair_rows
from ..operators.stamps import STATUS_CURRENT, STATUS_SUPERSEDED, clean_required, current
from ..sources.publish import Publication, _journal_id, _log_dir, _names
from ..sources.tables import partition_location, partitions, stage, table_location
from .evolution import column_versions
from .loads import LoadResult, _resume, _run_dir, _stage_main, _verify, job_session, repair
from .spec import TableSpec

_DIGESTS = "_histlake_digest"
# Fixed value of Spark's file names: the bucket number before the extension.
BUCKET_FILE = re.compile(r"_(\d+)(?:\..*)?$")


# Publications that leave the current slice alone.
_ELSEWHERE = ("rebuild-", "ods_dedup_", "retain-")


def _state(done: Iterable[str]) -> str:
    """Name of the current slice's state: which publications it has seen."""
    names = sorted(n for n in done if n.endswith(".done") and not n.startswith(_ELSEWHERE))
    return f"after{len(names)}x{zlib.crc32('/'.join(names).encode()):08x}"


def _bucket_of(name: str) -> int | None:
    hit = BUCKET_FILE.search(name)
    return int(hit[1]) if hit else None


def slice_digests(spark: SparkSession, spec: TableSpec) -> tuple[DataFrame, bool]:
    """Leaf digests of the current slice, and whether they were the kept ones."""
    root = f"{table_location(spark, spec.m_table)}/{_DIGESTS}"
    state = _state(_names(spark, _log_dir(spark, spec)))
    if "_SUCCESS" in _names(spark, f"{root}/{state}"):
        return spark.read.parquet(f"{root}/{state}"), True
    rows = current(spark.table(spec.m_table))
    return stage(leaf_digests(rows, spec.keys, spec.column_names, spec.buckets), f"{root}/{state}"), False


def repair_by_digest(spark: SparkSession, spec: TableSpec, batch_ts, run_dir: str | None = None,
                     check_ids: bool = True, ori_id=None) -> LoadResult:
    """P4 on a bucketed table: like :func:`repair`, but buckets whose digest
    equals the snapshot's are neither read nor rewritten.

    The snapshot is read once for its digests (a sum per task and bucket) and
    once more for the rows of differing buckets.  Rows repeated in the snapshot
    but not in the table make a bucket differ; it is read then, and stays.  A
    table whose columns changed is repaired whole: its versions are compared by
    different columns.
    """
    if not spec.keys or not spec.buckets:
        raise ValueError(f"{spec.name}: a repair by digest needs a table bucketed by its key")
    if len(column_versions(spark, spec)) > 1:
        return repair(spark, spec, batch_ts, run_dir=run_dir, check_ids=check_ids, ori_id=ori_id)
    bt = batch_text(batch_ts)
    slot = slot_of(bt, "month")
    rd = _run_dir(spark, run_dir, f"digest-{spec.name}")
    if _resume(spark, spec, "repair", bt):
        return LoadResult(spec.name, "repair_by_digest", bt, slot, rd, {"resumed": True})
    job = job_session(spark, spec)
    have, kept = slice_digests(spark, spec)
    snap = job.table(spec.ff_table).select(*spec.column_names)
    clean = clean_required(snap, spec.required_all, spec.extra_filter)
    want = stage(leaf_digests(clean, spec.keys, spec.column_names, spec.buckets), f"{rd}/want")
    leaves = differing_leaves(digest_tree(have, spec.buckets), digest_tree(want, spec.buckets))
    counts: dict = {"buckets": len(leaves), "kept_digests": kept, "resumed": False}
    out = Publication(spark, spec, "repair", bt)
    after = _state([*_names(spark, _log_dir(spark, spec)), f"{_journal_id('repair', bt)}.done"])
    digests = f"{table_location(spark, spec.m_table)}/{_DIGESTS}"
    rest = have.where(~F.col("leaf").isin(leaves)) if leaves else have
    if leaves:
        here = F.regexp_extract(F.col("_metadata.file_name"), BUCKET_FILE.pattern, 1).cast("int").isin(leaves)
        cur = current(job.table(spec.m_table)).where(here)   # file names: other buckets' files are not listed
        mine = snap.where(bucket_number(spec.keys, spec.buckets).isin(leaves))
        hot = hot_keys(mine, spec.keys, spec.buckets)
        rows = repair_rows(cur, mine, spec.keys, bt, spec.required, spec.extra_filter, slot, ori_id=ori_id,
                           buckets=spec.buckets, hot=hot, parts=spec.buckets)
        staged = _stage_main(spec, rows, rd)
        counts.update(_verify(spark.table(staged), bt, slot, check_ids and ori_id is not None))
        fresh = leaf_digests(current(spark.table(staged)), spec.keys, spec.column_names, spec.buckets)
        rest = rest.unionByName(fresh)
        old = [f"{loc}/{name}" for p in partitions(spark, spec.m_table) if p["dl_status"] == STATUS_CURRENT
               for loc in [partition_location(spark, spec.m_table, p)] for name in _names(spark, loc)
               if not name.startswith(("_", ".")) and _bucket_of(name) in set(leaves)]
        out.append(spec.m_table, staged, {"dl_status": STATUS_SUPERSEDED})
        out.append(spec.m_table, staged, {"dl_status": STATUS_CURRENT})
        for path in old:
            out.actions.append({"do": "delete", "path": path})
        out.actions.append({"do": "refresh", "table": spec.m_table})
        out.forget(staged)
    rest.write.mode("overwrite").parquet(f"{digests}/{after}")
    for name in _names(spark, digests):   # superseded ones
        if name != after:
            out.delete(f"{digests}/{name}")
    out.delete(f"{rd}/want")
    out.run()
    return LoadResult(spec.name, "repair_by_digest", bt, slot, rd, counts)


__all__ = ["repair_by_digest", "slice_digests"]
