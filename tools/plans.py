"""Print the physical plans of the core jobs (simple mode), for PLANS.md.

Usage: python tools/plans.py [sf_dir] > /tmp/plans.txt
The main table is bucketed (8 buckets = shuffle partitions) and the
planner's estimate-based broadcast is off, as in RECOMMENDED_CONF; the
arrivals' key set is not broadcast, to show the shuffle-join shape.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from histlake.operators import (backfill_rows, change_report, current, latest_per_key,  # noqa: E402
                                repair_rows, stamp_load, upsert_rows)
from histlake.plans import registry as R  # noqa: E402
from histlake.plans.loads import job_session, upsert  # noqa: E402
from histlake.session import build_session, new_run_dir  # noqa: E402
from histlake.sources import create_layers, stage  # noqa: E402


def show(title, df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    print(f"### {title}\n\n```")
    print(buf.getvalue().strip())
    print("```\n")


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("plans", master="local[8]", shuffle_partitions=8,
                          extra={"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    rd = new_run_dir(spark, "plans")
    spec = R.orders_spec("plans_db", buckets=8)
    create_layers(spark, spec, rd)
    upsert(spark, spec, R.T1, arrivals=R.orders_old(spark, d), ori_id="o_orderkey",
           broadcast_limit=0)
    n = stage(stamp_load(R.orders_new(spark, d), R.T2), f"{rd}/n")
    job = job_session(spark, spec)
    cur, n = current(job.table(spec.m_table)), job.read.parquet(f"{rd}/n")
    show("upsert rows, bucketed main table (no broadcast)",
         upsert_rows(cur, n, spec.keys, R.T2, ["o_custkey"], opened_partitions=8))
    show("repair rows, bucketed main table",
         repair_rows(cur, n.drop("dl_loaded_dt", "day"), spec.keys, R.T2, ["o_custkey"], buckets=8))
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    show("latest per key (lineitem)", latest_per_key(li, ["l_orderkey", "l_linenumber"],
                                                     ["l_shipdate"]))
    show("change report", change_report(R.orders_old(spark, d), R.orders_new(spark, d),
                                        ["o_orderkey"]))
    show("backfill of 30 daily batches (events)",
         backfill_rows(None, R.events_by_day(spark, d), ["user_id"], "load_batch",
                       ["ts", "event_id"]))
    spark.stop()


if __name__ == "__main__":
    main()
