"""The streaming trigger runs the incremental upsert once per batch of new files."""

from __future__ import annotations

import pytest
import os
import datetime as dt
import itertools

from histlake.plans.registry import orders_spec
from histlake.sources import create_layers, write_raw
from histlake.streaming import upsert_stream

from conftest import SF001


def test_stream_upserts_new_files_once(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    src = f"{run_dir}/incoming"
    write_raw(orders.filter("o_orderkey < 600"), f"{src}/batch1")
    times = itertools.count()
    clock = lambda: dt.datetime(2022, 4, 20, 10, 0, 0) + dt.timedelta(seconds=next(times))
    ckpt = f"{run_dir}/stream"
    q = upsert_stream(spark, spec, f"{src}/*", checkpoint=ckpt, clock=clock)
    q.awaitTermination(120)
    m = spark.table(spec.m_table)
    assert m.filter("dl_status = 'A'").count() == 600
    # a second file batch: overlapping keys close their versions
    write_raw(orders.filter("o_orderkey >= 500 and o_orderkey < 700"), f"{src}/batch2")
    q = upsert_stream(spark, spec, f"{src}/*", checkpoint=ckpt, clock=clock)
    q.awaitTermination(120)
    m = spark.table(spec.m_table)
    assert m.filter("dl_status = 'A'").count() == 700
    assert m.filter("dl_status = 'H'").count() == 100
    # batch times are at least a minute apart, so ids of the two batches differ
    starts = sorted(r[0] for r in m.select("dl_start_dt").distinct().collect())
    assert len(starts) == 2 and starts[1] - starts[0] >= dt.timedelta(minutes=1)
    # nothing new: running again changes nothing
    q = upsert_stream(spark, spec, f"{src}/*", checkpoint=ckpt, clock=clock)
    q.awaitTermination(120)
    assert spark.table(spec.m_table).count() == 800


def test_stream_batch_replayed_after_a_crash(spark, run_dir, fresh_db, monkeypatch):
    """The upsert dies after publishing the main table; the restarted stream
    replays the epoch with the same batch time and ends like a clean run."""
    import histlake.sources.publish as publish
    from histlake.plans.registry import T1, orders_old, orders_spec as spec_of

    def run(db, crash):
        spec = spec_of(db)
        create_layers(spark, spec, f"{run_dir}/{db}")
        src = f"{run_dir}/{db}-in"
        write_raw(orders_old(spark, SF001), f"{src}/b0")
        clock = lambda: dt.datetime.fromisoformat(T1)
        ckpt = f"{run_dir}/{db}-ckpt"
        if crash:
            real = publish._do
            state = {"armed": True}

            def boom(spark, action):
                if state["armed"] and action.get("table") == spec.ff_table:
                    state["armed"] = False
                    raise RuntimeError("crash after the main table was published")
                return real(spark, action)
            monkeypatch.setattr(publish, "_do", boom)
            q = upsert_stream(spark, spec, f"{src}/*", checkpoint=ckpt, clock=clock,
                              ori_id="o_orderkey")
            try:
                q.awaitTermination(120)
            except Exception:  # noqa: BLE001 - the stream stops with the crash
                pass
        q = upsert_stream(spark, spec, f"{src}/*", checkpoint=ckpt, clock=clock,
                          ori_id="o_orderkey")
        q.awaitTermination(120)
        m = sorted(tuple(r) for r in spark.table(spec.m_table).collect())
        ff = sorted(tuple(r) for r in spark.table(spec.ff_table).collect())
        return m, ff

    assert run(fresh_db + "_c", True) == run(fresh_db + "_n", False)


def test_a_failing_log_read_stops_the_batch(spark, run_dir):
    from histlake.streaming.arrivals import _append_log, _epoch_log
    log = f"{run_dir}/batches"
    assert _epoch_log(spark, log, 0) == []
    _append_log(spark, log, 0, "2022-04-13 10:11:12", "started")
    assert len(_epoch_log(spark, log, 0)) == 1
    for name in os.listdir(f"{log}/epoch_id=0"):
        with open(f"{log}/epoch_id=0/{name}", "wb") as f:
            f.write(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet|footer|read|file"):
        _epoch_log(spark, log, 0)
