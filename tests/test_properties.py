"""Properties of the SCD2 algebra over random batch sequences (hypothesis)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from histlake.functions import OPEN_END, batch_text
from histlake.operators import backfill_rows, current, open_rows, repair_rows

SCHEMA = "k bigint, v string, n int"
BASE = dt.datetime(2022, 4, 1, 8, 0, 0)

rows_st = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", "c"])),
                   min_size=0, max_size=8)
batches_st = st.lists(rows_st, min_size=1, max_size=4)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def _snapshot(rows):
    """A full snapshot has one row per key: the last one listed wins."""
    last = {}
    for k, v in rows:
        last[k] = v
    return sorted(last.items())


def _invariants(m, exact_chain: bool):
    """One open version per key, open end fixed, non-empty intervals, no overlap.

    Upserts never delete, so each closed version ends exactly where the
    next starts; a repair can delete a key and see it come back later,
    which leaves a gap (never an overlap).
    """
    cur = m.filter("dl_status = 'A'")
    assert cur.groupBy("k").count().filter("count > 1").count() == 0
    assert cur.filter(f"dl_end_dt <> timestamp_ntz'{OPEN_END}'").count() == 0
    assert m.filter("dl_start_dt >= dl_end_dt").count() == 0
    w = Window.partitionBy("k").orderBy("dl_start_dt")
    chained = m.withColumn("nxt", F.lead("dl_start_dt").over(w))
    assert chained.filter("nxt is not null and dl_end_dt > nxt").count() == 0
    if exact_chain:
        assert chained.filter("nxt is not null and dl_end_dt <> nxt").count() == 0


@SETTINGS
@given(batches_st)
@example([[(0, "a")], [(4, "a"), (0, "a")], [], [(0, "a"), (4, "a")]])   # deleted, then back
def test_repair_sequence_tracks_snapshots(spark, batches):
    m = open_rows(spark.createDataFrame([], SCHEMA), batch_text(BASE)).filter(F.lit(False))
    history = m
    for i, rows in enumerate(batches):
        ts = batch_text(BASE + dt.timedelta(days=i + 1))
        snap = _snapshot(rows)
        snap_df = spark.createDataFrame([(k, v, 0) for k, v in snap], SCHEMA)
        ids_before = {r.k: (r.v, r.dl_id) for r in current(m).collect()}
        out = repair_rows(current(m), snap_df, ["k"], ts, ori_id="k")
        out = spark.createDataFrame(out.collect(), out.schema)
        history = history.unionByName(out.filter("dl_status = 'H'"))
        m = out
        got = sorted((r.k, r.v) for r in current(m).collect())
        assert got == snap
        for r in current(m).collect():            # unchanged versions keep their id
            if r.k in ids_before and ids_before[r.k][0] == r.v:
                assert r.dl_id == ids_before[r.k][1]
    _invariants(history.unionByName(current(m)), exact_chain=False)


@SETTINGS
@given(batches_st)
def test_backfill_is_a_sequence_of_upserts(spark, batches):
    from histlake.operators import latest_per_key, upsert_rows
    data = []
    for i, rows in enumerate(batches):
        ts = BASE + dt.timedelta(days=i + 1)
        data += [(k, v, j, ts) for j, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA + ", b timestamp_ntz")
    bulk = backfill_rows(None, df, ["k"], "b", ["n"], ori_id="k")
    m = open_rows(spark.createDataFrame([], SCHEMA), batch_text(BASE)).filter(F.lit(False))
    closed = m
    for i, rows in enumerate(batches):
        ts = batch_text(BASE + dt.timedelta(days=i + 1))
        n = latest_per_key(df.filter(F.col("b") == F.lit(ts).cast("timestamp_ntz")).drop("b"),
                           ["k"], ["n"])
        out = upsert_rows(m, n, ["k"], ts, ori_id="k")
        out = spark.createDataFrame(out.collect(), out.schema)
        closed = closed.unionByName(out.filter("dl_status = 'H'"))
        m = out.filter("dl_status = 'A'")
    loop = closed.unionByName(m)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, bulk.collect())) == sorted(map(key, loop.select(*bulk.columns).collect()))
    _invariants(bulk, exact_chain=True)
