"""A load that dies at any catalog statement or file move can be run again with
the same batch time and ends exactly like a run that never failed."""

from __future__ import annotations

import os

import pytest
from conftest import SF001

import histlake.sources.publish as publish
from histlake.plans import backfill, rebuild_and_repair, repair, retain, snapshot_load, upsert
from histlake.plans.registry import (T1, T2, T3, customer_new, customer_old, customer_spec, events_by_day,
                                     events_spec, orders_new, orders_old, orders_spec, orders_third)
from histlake.sources import create_layers


class Crash(RuntimeError):
    pass


def contents(spark, spec):
    m = sorted(tuple(r) for r in spark.table(spec.m_table).collect())
    ff = sorted(tuple(r) for r in spark.table(spec.ff_table).collect())
    return m, ff


def kill_at(monkeypatch, k):
    """The k-th action of a publication is not performed; count them all."""
    real, seen = publish._do, {"n": 0}

    def wrapper(spark, action):
        seen["n"] += 1
        if seen["n"] == k:
            raise Crash(action["do"])
        return real(spark, action)

    monkeypatch.setattr(publish, "_do", wrapper)
    return seen


def _upsert(spark, spec):
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001), ori_id="o_orderkey")
    upsert(spark, spec, T2, arrivals=orders_new(spark, SF001).limit(300), ori_id="o_orderkey")
    return lambda: upsert(spark, spec, T3, arrivals=orders_third(spark, SF001), ori_id="o_orderkey")


def _snapshot(spark, spec):
    snapshot_load(spark, spec, T1, snapshot=customer_old(spark, SF001), ori_id="c_custkey")
    return lambda: snapshot_load(spark, spec, T2, snapshot=customer_new(spark, SF001), ori_id="c_custkey")


def _repair(spark, spec):
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001), ori_id="o_orderkey")
    return lambda: repair(spark, spec, T2, ori_id="o_orderkey")


def _rebuild(spark, spec):
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001), ori_id="o_orderkey")
    return lambda: rebuild_and_repair(spark, spec, T2, snapshot=orders_new(spark, SF001), ori_id="o_orderkey")


def _backfill(spark, spec):
    e = events_by_day(spark, SF001)
    run = lambda part: backfill(spark, spec, part, "load_batch", ["ts", "event_id"], ori_id="event_id")
    run(e.where("day(ts) <= 27"))
    return lambda: run(e.where("day(ts) > 27"))


def _retain(spark, spec):
    _upsert(spark, spec)()
    return lambda: retain(spark, spec, T3)


LOADS = {"upsert": (orders_spec, _upsert), "snapshot_load": (customer_spec, _snapshot),
         "repair": (orders_spec, _repair), "rebuild_and_repair": (orders_spec, _rebuild),
         "backfill": (events_spec, _backfill), "retain": (orders_spec, _retain)}


@pytest.mark.parametrize("name", LOADS)
def test_every_statement_can_be_the_last(spark, run_dir, fresh_db, monkeypatch, name):
    spec_of, prepare = LOADS[name]

    def run(k):
        spec = spec_of(f"{fresh_db}_{k}")
        create_layers(spark, spec, f"{run_dir}/{k}")
        last = prepare(spark, spec)
        with monkeypatch.context() as m:
            seen = kill_at(m, k)
            if k:
                with pytest.raises(Crash):
                    last()
            else:
                last()
        if k:
            last()
        return contents(spark, spec), seen["n"]

    clean, actions = run(0)
    assert actions >= 3
    for k in range(1, actions + 1):
        assert run(k)[0] == clean, f"killed at action {k} of {actions}"


def test_any_load_finishes_what_another_left(spark, run_dir, fresh_db, monkeypatch):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001), ori_id="o_orderkey")
    with monkeypatch.context() as m:
        kill_at(m, 2)
        with pytest.raises(Crash):
            upsert(spark, spec, T2, arrivals=orders_new(spark, SF001), ori_id="o_orderkey")
    upsert(spark, spec, T3, arrivals=orders_third(spark, SF001), ori_id="o_orderkey")
    current = spark.table(spec.m_table).where("dl_status = 'A'")
    assert current.count() == current.select("o_orderkey").distinct().count()
    assert upsert(spark, spec, T2, arrivals=orders_new(spark, SF001)).counts["resumed"]


def test_backfill_refuses_what_overlaps(spark, run_dir, fresh_db):
    spec = events_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    e = events_by_day(spark, SF001)
    run = lambda part: backfill(spark, spec, part, "load_batch", ["ts", "event_id"], ori_id="event_id")
    run(e.where("day(ts) between 5 and 15"))
    for part in ("day(ts) between 15 and 20", "day(ts) < 5"):
        with pytest.raises(ValueError):
            run(e.where(part))
    assert run(e.where("day(ts) between 5 and 15")).counts["resumed"]
    assert spark.table(spec.ff_table).count() == e.where("day(ts) between 5 and 15").count()


def test_one_run_dir_for_many_loads_leaves_only_live_files(spark, run_dir, fresh_db):
    """Loads given one folder keep apart, and every data file is a table's."""
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, f"{run_dir}/lake")
    runs = f"{run_dir}/runs"
    for ts, src in ((T1, orders_old), (T2, orders_new), ("2022-05-20 10:11:12", orders_third),
                    ("2022-06-20 10:11:12", orders_third)):
        upsert(spark, spec, ts, arrivals=src(spark, SF001), ori_id="o_orderkey", run_dir=runs)
    live = {f.split("/")[-1] for t in (spec.m_table, spec.ff_table) for f in spark.table(t).inputFiles()}
    found = {n for d, _, names in os.walk(runs) for n in names if n.endswith(".parquet")}
    assert found and found <= live
    current = spark.table(spec.m_table).where("dl_status = 'A'")
    assert current.count() == current.select("o_orderkey").distinct().count()
