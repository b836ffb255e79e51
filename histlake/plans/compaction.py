"""Joining the small files of slots that many loads added to.

An append to a slot that exists moves files into its folder; nothing else
ever joins them.  Here files are packed by size, per partition and bucket, into
bins of about ``target_bytes``; a bin of two or more becomes one file, one task
each, and files that are large enough, or alone in their bin, stay as they are.
Rows do not change, and the files of the bins are exchanged by the journal.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.stamps import STATUS_SUPERSEDED
from ..sources.publish import Publication, _fs, finish_pending
from ..sources.tables import partition_location, partitions, write_stage_table
from .digests import _bucket_of
from .loads import LoadResult, _run_dir, job_session
from .spec import TableSpec

TARGET_BYTES = 128 << 20


def pack(sizes: Iterable[tuple[str, int]], target: int) -> list[list[str]]:
    """First fit, largest first: bins of names whose sizes add up to ``target``
    at most.  Files of over half the target are left out: joining them gains
    little for what it copies."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if size > target // 2:
            continue
        for k, (held, names) in enumerate(bins):
            if held + size <= target:
                bins[k] = (held + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def _sizes(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    found = [(s.getPath(), s.getLen()) for s in fs.listStatus(path)]
    return [(p.toString(), size) for p, size in found if p.getName()[0] not in "._"]


def compact(spark: SparkSession, spec: TableSpec, run_dir: str | None = None, target_bytes: int = TARGET_BYTES,
            statuses: Sequence[str] = (STATUS_SUPERSEDED,)) -> LoadResult:
    """Fewer, larger files in the main table's slots of these statuses.

    Only file names and sizes come to the driver; the rows of the files to be
    joined are read once and written once, a bin a task; a bin is of one
    partition, so its rows go straight to its file and are not sorted.
    """
    finish_pending(spark, spec)
    rd = _run_dir(spark, run_dir, f"compact-{spec.name}")
    places: dict[str, int] = {}   # file -> bin
    n = 0
    for p in partitions(spark, spec.m_table):
        if p["dl_status"] not in statuses:
            continue
        folder = partition_location(spark, spec.m_table, p)
        groups: dict[int | None, list] = {}
        for name, size in _sizes(spark, folder):
            groups.setdefault(_bucket_of(name) if spec.buckets else None, []).append((name, size))
        for _, files in sorted(groups.items(), key=str):
            for names in pack(files, target_bytes):
                places |= dict.fromkeys(names, n)
                n += 1
    counts = {"joined_files": len(places), "new_files": n}
    if not places:
        return LoadResult(spec.name, "compact", "", 0, rd, counts)
    job = job_session(spark, spec)
    listed = job.createDataFrame(list(places.items()), "_file string, _bin int")
    m = job.table(spec.m_table).where(F.col("dl_status").isin(list(statuses)))
    # the list prunes the files that are opened; the join gives the bin (a row a file)
    chosen = m.where(F.col("_metadata.file_path").isin(list(places)))
    rows = chosen.withColumn("_path", F.col("_metadata.file_path")).join(
        F.broadcast(listed), F.col("_path") == F.col("_file")).repartitionById(n, F.col("_bin"))
    staged = write_stage_table(rows.select(*m.columns), spec.m_table, f"{rd}/m")
    before, after = chosen.count(), spark.table(staged).count()
    if before != after or not before:
        raise RuntimeError(f"{spec.name}: {after} rows in the joined files, {before} in the old ones")
    out = Publication(spark, spec, "compact")
    out.append(spec.m_table, staged, {})
    for path in places:
        out.actions.append({"do": "delete", "path": path})
    out.actions.append({"do": "refresh", "table": spec.m_table})
    out.forget(staged)
    out.run()
    return LoadResult(spec.name, "compact", "", 0, rd, counts)


__all__ = ["compact", "pack"]
