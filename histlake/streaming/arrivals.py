"""Incremental upsert driven by Structured Streaming.

The incremental load (P2) picks up whatever new extract files arrived in the
raw folder.  Here Structured Streaming's file source does the bookkeeping of
which files are new, and ``foreachBatch`` runs the very same
:func:`histlake.plans.loads.upsert` on each micro-batch.  No new operator:
only a trigger for an existing one.

Replays: a micro-batch may run again after a failure.  Its batch time is
written to a small parquet log next to the checkpoint (one folder per epoch,
so a batch reads only its own entry and its predecessor's) *before* the
upsert runs, and marked done after it.  A replayed epoch reuses its logged time, so
the upsert -- resumable by batch time -- finishes only the missing steps,
and a finished epoch is skipped.  Batch times strictly increase by at least
a minute, which keeps the surrogate ids of two batches apart.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.slots import batch_datetime, batch_text
from ..plans.loads import upsert
from ..plans.spec import TableSpec
from ..session import new_run_dir
from ..sources.publish import _names
from ..sources.raw import conform, parse_lines


def _epoch_log(spark: SparkSession, path: str, epoch_id: int) -> list:
    """The log rows of one epoch (its own folder: nothing else is listed).

    Whether there is an entry is asked of the file system; an error in
    reading one stops the batch.
    """
    folder = f"{path}/epoch_id={epoch_id}"
    if not any(n.endswith(".parquet") for n in _names(spark, folder)):
        return []
    return spark.read.parquet(folder).collect()


def _append_log(spark: SparkSession, path: str, epoch_id: int, ts, state: str) -> None:
    spark.createDataFrame([(batch_text(ts), state)], "batch_ts string, state string") \
         .write.mode("append").parquet(f"{path}/epoch_id={epoch_id}")


def upsert_stream(spark: SparkSession, spec: TableSpec, source_dir: str,
                  checkpoint: str | None = None, available_now: bool = True,
                  processing_time: str | None = None,
                  clock: Callable[[], _dt.datetime] | None = None,
                  **upsert_kw) -> StreamingQuery:
    """Start a stream that upserts every new raw file batch into ``spec``'s tables."""
    ckpt = checkpoint or new_run_dir(spark, f"stream-{spec.name}")
    log_path = f"{ckpt}/batches"
    clock = clock or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    raw = parse_lines(spark.readStream.option("lineSep", "\n").text(source_dir), spec.column_names)
    typed = conform(raw, spec.schema)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        mine = _epoch_log(spark, log_path, epoch_id)
        if any(r["state"] == "done" for r in mine):
            return                                   # replay of a finished batch
        if mine:
            ts = batch_datetime(mine[0]["batch_ts"])  # replay of a started batch: same time
        else:
            ts = batch_datetime(clock())
            prev = _epoch_log(spark, log_path, epoch_id - 1)
            if prev:
                floor = batch_datetime(prev[0]["batch_ts"]) + _dt.timedelta(minutes=1)
                ts = max(ts, floor)
            _append_log(spark, log_path, epoch_id, ts, "started")
        upsert(spark, spec, ts, arrivals=batch, **upsert_kw)    # resumable by batch time
        _append_log(spark, log_path, epoch_id, ts, "done")

    writer = typed.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{ckpt}/ckpt")
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
