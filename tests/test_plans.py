"""Physical plan properties that matter at scale."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from histlake.operators import (current, latest_per_key, open_rows, repair_rows, snapshot_diff, stamp_load,
                                upsert_rows)
from histlake.operators.hotkeys import hot_keys, place_by_key
from histlake.plans.registry import T1, T2, orders_new, orders_old, orders_spec
from histlake.plans import loads
from histlake.plans.loads import job_session, upsert
from histlake.sources import create_layers, stage
from histlake.sources.tables import write_stage_table

from conftest import SF001


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_latest_per_key_limits_before_the_shuffle(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    p = plan(latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_upsert_prunes_columns_and_pushes_filters(spark):
    a = open_rows(orders_old(spark, SF001), T1, ori_id="o_orderkey")
    p = plan(upsert_rows(a, orders_new(spark, SF001), ["o_orderkey"], T2, required=["o_custkey"]))
    # the key-set side reads only the columns it needs
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
    assert "PushedFilters: [IsNotNull(o_orderkey), IsNotNull(o_custkey)]" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p     # no Python in the hot path


def test_bucketed_current_slice_is_not_shuffled(spark, run_dir, fresh_db):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spec = orders_spec(fresh_db, buckets=4)
        create_layers(spark, spec, run_dir)
        upsert(spark, spec, T1, arrivals=orders_old(spark, SF001))
        stage(stamp_load(orders_new(spark, SF001), T2), f"{run_dir}/n")
        job = job_session(spark, spec)
        n = job.read.parquet(f"{run_dir}/n")
        p = plan(upsert_rows(current(job.table(spec.m_table)), n, spec.keys, T2), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p
    scan_lines = [ln for ln in p.splitlines() if "Bucketed: true" in ln]
    assert scan_lines, p
    # exactly one exchange: the arrivals' key set, never the current slice
    assert p.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [isnotnull(dl_status" in p and "(dl_status" in p


def test_snapshot_diff_branches_share_exchanges(spark):
    d = snapshot_diff(orders_old(spark, SF001), orders_new(spark, SF001), ["o_orderkey"])
    u = d.opened.withColumn("p", F.lit(1)).unionByName(d.closed.withColumn("p", F.lit(2))) \
        .unionByName(d.kept.withColumn("p", F.lit(3)))
    u.write.format("noop").mode("overwrite").save()
    assert "ReusedExchange" in plan(u) or "BroadcastHashJoin" in plan(u)


def test_hot_key_is_pre_aggregated_before_the_shuffle(spark):
    """One key holds a third of the arrivals: the key set is reduced map-side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(0, 9000, numPartitions=6)
        arrivals = base.select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
                               .alias("k"), F.col("id").cast("string").alias("v"),
                               F.col("id").cast("int").alias("n"))
        a = open_rows(spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("v"),
                                                 F.lit(0).alias("n")), T1, ori_id="k")
        out = upsert_rows(a, arrivals, ["k"], T2, ori_id="n")
        p = plan(out, "simple")
        # partial aggregate of the key set sits below its exchange
        lines = p.splitlines()
        ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(_r_k" in ln]
        assert ex and "HashAggregate" in lines[ex[0] + 1], p
        counts = {r.dl_status: r["count"] for r in out.groupBy("dl_status").count().collect()}
        hot_closed = out.filter("k = 0 and dl_status = 'H'").count()
        assert hot_closed == 1                       # closed once, not once per arrival
        assert counts["A"] == 9000 + 100 - a.join(arrivals.select("k").distinct(), "k").count()
        newest = latest_per_key(arrivals, ["k"], ["n"])
        assert newest.filter("k = 0").count() == 1
        assert "WindowGroupLimit" in plan(newest)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bucketed_repair_shuffles_the_snapshot_once(spark, run_dir, fresh_db):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spec = orders_spec(fresh_db, buckets=4)
        create_layers(spark, spec, run_dir)
        upsert(spark, spec, T1, arrivals=orders_old(spark, SF001))
        stage(stamp_load(orders_new(spark, SF001), T2), f"{run_dir}/n")
        job = job_session(spark, spec)
        n = job.read.parquet(f"{run_dir}/n").drop("dl_loaded_dt", "day")
        p = plan(repair_rows(current(job.table(spec.m_table)), n, spec.keys, T2, buckets=4), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [ln for ln in p.splitlines() if "Bucketed: true" in ln], p
    assert p.count("Exchange hashpartitioning") == 1, p


def test_hot_keys_are_found_whole_and_spread(spark):
    """Every key above twice an even share, and no other, is spread."""
    n = 20_000
    df = spark.range(n, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
         .otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("j"), "id")
    hot = hot_keys(df, ["k", "j"], 50)
    shares = df.groupBy("k", "j", F.xxhash64("k", "j").alias("h")).count().where(f"count * 50 > 2 * {n}").collect()
    assert set(hot) == {r.h for r in shares} and len(hot) == 2
    assert sum(hot.values()) <= 50 + len(hot)
    placed = place_by_key(df, ["k", "j"], 50, hot, ["id"]).select("k", "j", F.spark_partition_id().alias("p"))
    per_task = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert sum(per_task) == n and max(per_task) < 5 * n / 50
    # a cold key's rows stand where a plain placing by key puts them
    plain = df.repartition(50, "k", "j").select("k", "j", F.spark_partition_id().alias("q")).distinct()
    cold = placed.where(~F.coalesce(F.col("k") == "hot", F.lit(True))).join(plain, ["k", "j"])
    assert cold.where("p <> q").count() == 0 and cold.count() > 0
    assert hot_keys(df.limit(0), ["k", "j"], 50) == {}


def test_key_sets_are_broadcast_only_when_proven_small(spark):
    """The size of the files does not tell how many keys they hold."""
    a = open_rows(orders_old(spark, SF001), T1, ori_id="o_orderkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        for proven in (False, True):
            rows = upsert_rows(a, orders_new(spark, SF001), ["o_orderkey"], T2, ori_id="o_orderkey",
                               broadcast_keys=proven)
            rows.write.format("noop").mode("overwrite").save()
            assert ("BroadcastHashJoin" in plan(rows, "simple")) == proven
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_upsert_does_not_repeat_shuffles(spark, run_dir, fresh_db, monkeypatch):
    """Deduplicated arrivals and opened rows are written as they lie; only current rows
    of many days are dealt by partition."""
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    plans = []

    def write(df, like, path):
        plans.append(plan(df, "simple"))
        return write_stage_table(df, like, path)

    monkeypatch.setattr(loads, "write_stage_table", write)
    part = orders_old(spark, SF001)
    for i, day in enumerate(("11", "12", "13", "14")):
        upsert(spark, spec, f"2022-04-{day} 10:11:12", arrivals=part.where(F.col("o_orderkey") % 4 == i),
               dedupe_arrivals=["o_orderdate"], ori_id="o_orderkey")
    upsert(spark, spec, "2022-04-14 12:11:12", arrivals=part.where("o_orderkey % 4 = 3"),
           dedupe_arrivals=["o_orderdate"], ori_id="o_orderkey")
    assert len(plans) == 10 and not any("REBALANCE" in p for p in plans), plans
    assert "Join" not in plans[1]                 # the first load has nothing to join with
    upsert(spark, spec, T2, arrivals=part, dedupe_arrivals=["o_orderdate"], ori_id="o_orderkey")
    assert "REBALANCE" not in plans[10] and plans[11].count("REBALANCE") == 1, plans[10:]
    m = spark.table(spec.m_table)
    n, again = part.count(), part.where("o_orderkey % 4 = 3").count()
    assert {r.dl_status: r["count"] for r in m.groupBy("dl_status").count().collect()} == {"A": n, "H": n + again}
