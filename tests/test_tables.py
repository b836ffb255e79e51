"""Catalog tables: raw text reads, by-name appends, slice replacement, loads, invariants."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from histlake.plans import TableSpec, ods_dedup, rebuild_and_repair, repair, retain, run_all, \
    snapshot_load, upsert
from histlake.plans.registry import (T1, T2, T3, customer_new, customer_old, orders_new,
                                     orders_old, orders_spec, orders_third)
from histlake.sources import (append_by_name, conform, conform_losses, create_layers,
                              drop_partitions, partitions, read_raw, stage)
from histlake.functions import OPEN_END

from conftest import SF001

SPEC_COLS = (("k", "bigint"), ("v", "varchar(10)"), ("n", "int"))


def small_spec(db, **kw):
    return TableSpec(name="items", database=db, keys=("k",), columns=SPEC_COLS, **kw)


def test_read_raw_text_nulls_quotes_and_bad_ints(spark, run_dir):
    os.makedirs(f"{run_dir}/f", exist_ok=True)
    with open(f"{run_dir}/f/part-0.txt", "w") as fh:
        fh.write("1\tplain\t10\n2\t\\N\t20\n3\tsay \"hi\tx\n")
    raw = read_raw(spark, f"{run_dir}/f", ["k", "v", "n"])
    typed = conform(raw, small_spec("default").schema)
    got = sorted(tuple(r) for r in typed.collect())
    assert got == [(1, "plain", 10), (2, None, 20), (3, 'say "hi', None)]
    lost = {r.column_name: r.lost for r in conform_losses(raw, small_spec("default").schema).collect()}
    assert lost == {"k": 0, "v": 0, "n": 1}


def test_append_by_name_aligns_and_refuses_wrong_columns(spark, run_dir, fresh_db):
    spec = small_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    df = spark.createDataFrame([(5, "x", 1)], "n int, v string, k bigint")   # other column order
    append_by_name(df.withColumn("dl_loaded_dt", F.lit(T1).cast("timestamp_ntz"))
                     .withColumn("day", F.lit(13)), spec.ff_table)
    r = spark.table(spec.ff_table).first()
    assert (r.k, r.v, r.n, r.day) == (1, "x", 5, 13)
    with pytest.raises(ValueError):
        append_by_name(df, spec.ff_table)


def test_swap_empties_stale_days(spark, run_dir, fresh_db):
    """A current-slice day that gets no rows must not keep its old rows."""
    from histlake.operators import open_rows
    from histlake.sources.publish import Publication
    from histlake.sources.tables import write_stage_table
    spec = small_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    day13 = open_rows(spark.createDataFrame([(1, "a", 1)], "k bigint, v string, n int"), T1)
    day20 = open_rows(spark.createDataFrame([(2, "b", 2)], "k bigint, v string, n int"), T2)
    append_by_name(day13.unionByName(day20), spec.m_table)
    out = Publication(spark, spec, "test")
    out.relocate(spec.m_table, write_stage_table(day20, spec.m_table, f"{run_dir}/stage"), {"dl_status": "A"})
    out.run()
    assert sorted(r.k for r in spark.table(spec.m_table).collect()) == [2]


def test_drop_layers_purge_leaves_no_old_rows(spark, run_dir, fresh_db):
    from histlake.sources import drop_layers
    spec = small_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    for ts in (T1, T2):
        upsert(spark, spec, ts, arrivals=spark.createDataFrame([(1, "a", 1)], "k bigint, v string, n int"))
    drop_layers(spark, spec, purge=True)
    create_layers(spark, spec, run_dir)
    assert spark.table(spec.m_table).count() == spark.table(spec.ff_table).count() == 0
    upsert(spark, spec, T1, arrivals=spark.createDataFrame([(2, "b", 1)], "k bigint, v string, n int"))
    assert [r.k for r in spark.table(spec.m_table).collect()] == [2]


def test_drop_partitions_partial_spec_removes_files(spark, run_dir, fresh_db):
    spec = small_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    from histlake.operators import close_rows, open_rows
    a = open_rows(spark.createDataFrame([(1, "a", 1)], "k bigint, v string, n int"), T1)
    append_by_name(a.unionByName(close_rows(a, T2, "H")).unionByName(close_rows(a, T3, "H")),
                   spec.m_table)
    assert drop_partitions(spark, spec.m_table, dl_status="H") == 2
    assert [p["dl_status"] for p in partitions(spark, spec.m_table)] == ["A"]
    # writing the same slot again must not resurrect old files
    append_by_name(close_rows(a, T2, "H"), spec.m_table)
    assert spark.table(spec.m_table).filter("dl_status = 'H'").count() == 1


def check_invariants(m, keys):
    """At most one open row per key; open end fixed; start < end; closed versions chain."""
    assert m.filter("dl_status = 'A'").groupBy(*keys).count().filter("count > 1").count() == 0
    assert m.filter(f"dl_status = 'A' and dl_end_dt <> timestamp_ntz'{OPEN_END}'").count() == 0
    assert m.filter("dl_start_dt >= dl_end_dt").count() == 0
    w = Window.partitionBy(*keys).orderBy("dl_start_dt")
    chained = m.filter("dl_status in ('A', 'H')").withColumn("nxt", F.lead("dl_start_dt").over(w))
    # each closed version ends where the next starts (or at a deletion, with no next)
    assert chained.filter("nxt is not null and dl_end_dt <> nxt").count() == 0


def test_upsert_sequence_invariants_and_replays(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001))
    res = upsert(spark, spec, T2, arrivals=orders_new(spark, SF001))
    assert res.counts["broadcast_keys"] is True
    upsert(spark, spec, T3, arrivals=orders_third(spark, SF001), broadcast_limit=0)
    m = spark.table(spec.m_table)
    check_invariants(m, ["o_orderkey"])
    days = {r.day for r in m.filter("dl_status = 'A'").select("day").distinct().collect()}
    assert days == {13, 20, 27}                      # rows in several day slots
    before = sorted(tuple(r) for r in m.collect())
    upsert(spark, spec, "2022-04-28 10:00:00", arrivals=orders_old(spark, SF001).limit(0))
    assert sorted(tuple(r) for r in spark.table(spec.m_table).collect()) == before
    ff = spark.table(spec.ff_table)
    assert ff.select("day").distinct().count() == 3   # ODS appended after each batch (empty adds none)


def test_repair_via_tables_and_second_repair_no_op(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001))
    res = rebuild_and_repair(spark, spec, T2, snapshot=orders_new(spark, SF001))
    assert res.counts == {"A": 685 + 343 + 300, "H": 172 + 343, "ods_rows": 685 + 343 + 300}
    ids_before = {r.dl_id for r in spark.table(spec.m_table).filter("dl_status='A'").collect()}
    res2 = repair(spark, spec, T3)
    assert res2.counts == {"A": len(ids_before)}
    ids_after = {r.dl_id for r in spark.table(spec.m_table).filter("dl_status='A'").collect()}
    assert ids_after == ids_before
    check_invariants(spark.table(spec.m_table), ["o_orderkey"])


def test_snapshot_load_same_day_rerun(spark, run_dir, fresh_db):
    spec = TableSpec(name="customer", database=fresh_db, keys=("c_custkey",),
                     columns=(("c_custkey", "bigint"), ("c_name", "varchar(25)"),
                              ("c_nationkey", "int"), ("c_acctbal", "double"),
                              ("c_mktsegment", "varchar(10)")))
    create_layers(spark, spec, run_dir)
    snapshot_load(spark, spec, T1, snapshot=customer_old(spark, SF001))
    snapshot_load(spark, spec, T2, snapshot=customer_new(spark, SF001))
    n_new = customer_new(spark, SF001).count()
    res = snapshot_load(spark, spec, "2022-04-20 18:00:00", snapshot=customer_old(spark, SF001),
                        keep_same_day_history=True)
    assert res.counts["reloaded_today"] is True
    m = spark.table(spec.m_table)
    # the earlier backup of the day was kept, the new one added beside it
    assert m.filter("dl_status = 'P'").count() == customer_old(spark, SF001).count() + n_new
    ff = spark.table(spec.ff_table)
    assert ff.select("dl_loaded_dt").distinct().count() == 2   # same-day reload keeps the day's rows


def test_ods_dedup_by_key_and_row(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    upsert(spark, spec, T1, arrivals=spark.read.parquet(f"{SF001}/orders.parquet"))
    upsert(spark, spec, T2, arrivals=orders_new(spark, SF001))
    res = ods_dedup(spark, spec, ["dl_loaded_dt"], by="row")
    assert res.counts["after"] < res.counts["before"]
    res = ods_dedup(spark, spec, ["dl_loaded_dt"], by="key")
    assert res.counts["after"] == 1500
    with pytest.raises(ValueError):
        ods_dedup(spark, spec, [], by="key")


def test_retain_drops_only_old_history(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001))
    upsert(spark, spec, T2, arrivals=orders_new(spark, SF001))
    upsert(spark, spec, T3, arrivals=orders_third(spark, SF001))
    m = spark.table(spec.m_table)
    n_a, n_h3 = m.filter("dl_status='A'").count(), m.filter("dl_status='H' and day=27").count()
    res = retain(spark, spec, "2022-04-21 00:00:00")
    assert res.counts["partitions"] == 1
    m = spark.table(spec.m_table)
    assert m.filter("dl_status='A'").count() == n_a
    assert m.filter("dl_status='H'").count() == n_h3


def test_bucketed_main_table_roundtrip(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db, buckets=4)
    create_layers(spark, spec, run_dir)
    upsert(spark, spec, T1, arrivals=orders_old(spark, SF001))
    upsert(spark, spec, T2, arrivals=orders_new(spark, SF001), broadcast_limit=0)
    check_invariants(spark.table(spec.m_table), ["o_orderkey"])
    by_status = {r.dl_status: r["count"] for r in
                 spark.table(spec.m_table).groupBy("dl_status").count().collect()}
    # P2 closes every arriving key: 172 old keys did not arrive, 1328 arrived
    assert by_status == {"A": 172 + 1328, "H": 1200 - 172}
    # a full repair on the bucketed table: the 172 keys missing from the snapshot close
    res = rebuild_and_repair(spark, spec, T3, snapshot=orders_new(spark, SF001))
    assert res.counts["H"] == 172 and res.counts["A"] == 1328
    check_invariants(spark.table(spec.m_table), ["o_orderkey"])
    retain(spark, spec, "2022-04-26 00:00:00")
    assert spark.table(spec.m_table).filter("dl_status = 'H'").count() == 172


def test_run_all_continues_after_failure(spark, run_dir, fresh_db):
    good = orders_spec(fresh_db)
    create_layers(spark, good, run_dir)
    bad = good.with_(name="missing")
    out = {r.table: r.status for r in run_all(spark, [bad, good], "repair", T2).collect()}
    assert out == {"missing": "failed", "orders": "ok"}


def test_upsert_needs_a_key(spark, fresh_db):
    spec = small_spec(fresh_db).with_(keys=())
    with pytest.raises(ValueError):
        upsert(spark, spec, T1, arrivals=spark.createDataFrame([], "k bigint, v string, n int"))


def test_batch_time_guard(spark, run_dir, fresh_db):
    spec = small_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    rows = spark.createDataFrame([(1, "a", 1)], "k bigint, v string, n int")
    upsert(spark, spec, T2, arrivals=rows)
    with pytest.raises(ValueError):                       # same minute: ids could repeat
        upsert(spark, spec, "2022-04-20 10:11:40", arrivals=rows)
    with pytest.raises(ValueError):                       # earlier batch: inverted intervals
        upsert(spark, spec, T1, arrivals=rows)
    upsert(spark, spec, "2022-04-20 10:12:00", arrivals=rows)
    assert spark.table(spec.m_table).count() == 2


def test_loads_read_the_raw_text_layer(spark, run_dir, fresh_db):
    """S1 end to end: f is a tab-text catalog table; loads type it with the spec."""
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    from histlake.sources import write_raw
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    damaged = o.select(*[F.when((F.col("o_orderkey") % 11 == 0) & F.lit(c == "o_totalprice"),
                                F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c)
                         for c in o.columns])
    write_raw(damaged, f"{run_dir}/f_orders")
    spark.catalog.refreshTable(spec.f_table)
    res = upsert(spark, spec, T1)
    assert res.counts["arrived"] == 1500
    m = spark.table(spec.m_table)
    assert m.count() == 1500
    assert m.filter("o_totalprice is null").count() == o.filter("o_orderkey % 11 = 0").count()
    # P5 from the same raw layer: nothing changed, so every version is kept
    res = rebuild_and_repair(spark, spec, T2)
    assert res.counts == {"A": 1500, "ods_rows": 1500}


def test_upsert_rewrites_only_changed_days(spark, run_dir, fresh_db):
    from histlake.sources.tables import partition_location
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    early, late = o.filter("o_orderkey < 700"), o.filter("o_orderkey >= 700")
    touch = o.filter("o_orderkey >= 1400").withColumn("o_totalprice", F.col("o_totalprice") + 5)

    def load(db, only):
        spec = orders_spec(db)
        create_layers(spark, spec, f"{run_dir}/{db}")
        upsert(spark, spec, T1, arrivals=early)                  # day 13
        upsert(spark, spec, T2, arrivals=late)                   # day 20
        before = {d: partition_location(spark, spec.m_table, {"dl_status": "A", "day": d})
                  for d in (13, 20)}
        res = upsert(spark, spec, T3, arrivals=touch, only_changed_days=only)   # keys of day 20
        after = {d: partition_location(spark, spec.m_table, {"dl_status": "A", "day": d})
                 for d in (13, 20)}
        return res, before, after, sorted(tuple(r)[1:] for r in spark.table(spec.m_table).collect())

    res, before, after, rows_partial = load(fresh_db + "_p", True)
    assert res.counts["rewritten_days"] == 2                     # day 20 and today's slot 27
    assert after[13] == before[13] and after[20] != before[20]   # day 13 never rewritten
    _, b2, a2, rows_full = load(fresh_db + "_f", False)
    assert a2[13] != b2[13]                                      # the full rewrite moves it
    assert rows_partial == rows_full                             # same table either way (ids aside)


def test_bucketed_repair_spreads_a_hot_key(spark, run_dir, fresh_db):
    """One key holds most of the snapshot, partly as copies of one row: its
    rows are spread over the tasks, and the result equals the unbucketed
    table's; rows of other keys keep their one file a bucket."""
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    hot = (spark.range(0, 12000, numPartitions=4)
           .select(F.lit(7).cast("bigint").alias("o_orderkey"), F.least("id", F.lit(2000)).alias("o_custkey"),
                   F.lit("O").alias("o_orderstatus"), (F.least("id", F.lit(2000)) * 1.5).alias("o_totalprice"),
                   F.lit("1998-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
                   F.lit("1-URGENT").alias("o_orderpriority")))
    snap = o.unionByName(hot)

    def run(db, buckets):
        spec = orders_spec(db, buckets=buckets)
        create_layers(spark, spec, f"{run_dir}/{db}")
        upsert(spark, spec, T1, arrivals=o)
        res = rebuild_and_repair(spark, spec, T2, snapshot=snap)
        m = spark.table(spec.m_table)
        assert m.select("dl_id").distinct().count() == m.count()
        files = (m.where("dl_status = 'A' and day = 20").groupBy(F.input_file_name().alias("f"))
                 .agg(F.count("*").alias("n"), F.count_if(F.col("o_orderkey") == 7).alias("hot")))
        spread = [r.hot for r in files.collect() if r.hot]
        rows = sorted(tuple(r)[1:] for r in m.collect())   # ids aside
        return res, rows, spread

    res_b, rows_b, spread = run(fresh_db + "_b", 4)
    res_u, rows_u, _ = run(fresh_db + "_u", None)
    assert res_b.counts.get("hot_keys") == res_u.counts.get("hot_keys") == 1
    assert len(spread) > 1 and max(spread) < 10_000 and len(spread) <= 4, spread
    assert rows_b == rows_u
    assert res_b.counts["A"] == 1500 + 12000
