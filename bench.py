"""Benchmark: the headline loads and operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line on stdout:
  {"metric": "total_sec", "value": <sum of headline medians>, "unit": "sec",
   "queries": {name: median sec}, "compare": {name: median sec}, "sf": ...}

Each query is forced to completion with a ``noop`` write (nothing is
(left join + ``is null``, separate diff joins, Python-UDF ids, ``max_by``
of a struct) next to the forms we use.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from histlake.functions import ids as idmod  # noqa: E402
from histlake.operators import (current, latest_per_key, open_rows, snapshot_diff,  # noqa: E402
                                upsert_rows)
from histlake.plans import registry as R  # noqa: E402
from histlake.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = ["scd2_upsert", "scd2_repair", "snapshot_rotate", "scd2_two_batches",
            "latest_per_key", "drop_exact_duplicates", "snapshot_diff_counts", "conform",
            "scd2_backfill", "tables_upsert", "tables_repair", "tables_snapshot",
            "tables_ods_dedup", "tables_backfill"]


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def cmp_keep_left_join_is_null(spark, d):
    a = open_rows(R.orders_old(spark, d), R.T1, ori_id="o_orderkey")
    n = R.orders_new(spark, d).select(F.col("o_orderkey").alias("nk"))
    return a.join(n, a.o_orderkey == n.nk, "left").filter(F.col("nk").isNull()).drop("nk")


def cmp_keep_left_anti(spark, d):
    a = open_rows(R.orders_old(spark, d), R.T1, ori_id="o_orderkey")
    return a.join(R.orders_new(spark, d).select("o_orderkey"), "o_orderkey", "left_anti")


def cmp_repair_separate_joins(spark, d):
    a = open_rows(R.orders_old(spark, d), R.T1, ori_id="o_orderkey")
    diff = snapshot_diff(a, R.orders_new(spark, d), ["o_orderkey"])
    cols = ["dl_id", *R.ORDERS]
    return (diff.kept.select(*cols).unionByName(diff.closed.select(*cols))
            .unionByName(diff.opened.select(F.lit(None).cast("string").alias("dl_id"), *R.ORDERS)))


def cmp_repair_full_outer(spark, d):
    """Repair as one full outer join on the key, classified per pair."""
    from histlake.functions import row_checksum
    from histlake.operators import close_values
    a = open_rows(R.orders_old(spark, d), R.T1, ori_id="o_orderkey")
    n = R.orders_new(spark, d)
    a = a.withColumn("ck", row_checksum(R.ORDERS))
    n = n.select(*[F.col(c).alias("n_" + c) for c in R.ORDERS]).withColumn(
        "n_ck", row_checksum([f"n_{c}" for c in R.ORDERS]))
    j = a.join(n, a.o_orderkey == n.n_o_orderkey, "full_outer")
    same = F.col("ck") == F.col("n_ck")
    vals = close_values(R.T2, "H", 20)
    kept_closed = j.filter(F.col("dl_id").isNotNull()).select(
        "dl_id", *R.ORDERS, *[F.when(same, F.col(c)).otherwise(vals[c]).alias(c) if c in vals
                              else F.col(c) for c in ["dl_loaded_dt", "dl_start_dt", "dl_end_dt",
                                                      "dl_status", "day"]])
    fresh = j.filter(F.col("n_o_orderkey").isNotNull() & (F.col("dl_id").isNull() | ~same)) \
             .select(*[F.col("n_" + c).alias(c) for c in R.ORDERS])
    return kept_closed.unionByName(open_rows(fresh, R.T2, ori_id="o_orderkey"))


def cmp_repair_one_outer_join(spark, d):
    return R.q_scd2_repair(spark, d)


def cmp_repair_two_joins(spark, d):
    from histlake.operators import repair_rows
    a = open_rows(R.orders_old(spark, d), R.T1, ori_id="o_orderkey")
    return repair_rows(a, R.orders_new(spark, d), ["o_orderkey"], R.T2, required=["o_custkey"],
                       ori_id="o_orderkey", method="two_joins")


def cmp_ids_native(spark, d):
    o = R._t(spark, d, "lineitem")
    return o.select(idmod.surrogate_id(R.T1).alias("dl_id"), "*")


def cmp_latest_max_by_struct(spark, d):
    li = R._t(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in li.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct("l_shipdate", *[c for c in rest if c != "l_shipdate"]))
    return li.groupBy(*keys).agg(best.alias("r")).select(*keys, "r.*")


def cmp_latest_window(spark, d):
    return latest_per_key(R._t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def cmp_upsert_whole_rewrite(spark, d):
    """Upsert written as a rewrite of the whole main table (history included)."""
    m = R._m_two_batches(spark, d)
    return m.filter("dl_status <> 'A'").unionByName(
        upsert_rows(current(m), R.orders_new(spark, d), ["o_orderkey"], R.T3, ori_id="o_orderkey"))


def cmp_upsert_current_slice(spark, d):
    m = R._m_two_batches(spark, d)
    return upsert_rows(current(m), R.orders_new(spark, d), ["o_orderkey"], R.T3, ori_id="o_orderkey")


COMPARE = {
    "keep_left_join_is_null": cmp_keep_left_join_is_null,
    "keep_left_anti": cmp_keep_left_anti,
    "repair_separate_joins": cmp_repair_separate_joins,
    "repair_full_outer_on_key": cmp_repair_full_outer,
    "repair_two_joins": cmp_repair_two_joins,
    "repair_one_outer_join": cmp_repair_one_outer_join,
    "ids_native": cmp_ids_native,
    "latest_max_by_struct": cmp_latest_max_by_struct,
    "latest_window": cmp_latest_window,
    "upsert_whole_rewrite": cmp_upsert_whole_rewrite,
    "upsert_current_slice": cmp_upsert_current_slice,
}


def time_query(spark, fn, runs: int) -> tuple[float, float]:
    """Median of the runs after the first, and the first, cold run."""
    times = []
    for _ in range(runs + 1):
        t0 = time.perf_counter()
        fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times[1:]), 3), round(times[0], 3)


def main() -> None:
    spark = build_session("histlake-bench", master=f"local[{CPUS}]", shuffle_partitions=CPUS * 2,
                          extra={"spark.driver.memory": "16g"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histlake-bench-"))
    only = sys.argv[1:]
    # warm-up: JIT and file listing caches, not timed
    R.q_scd2_upsert(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    queries, cold = {}, {}
    registered = R.queries()
    for name in HEADLINE:
        if only and name not in only:
            continue
        queries[name], cold[name] = time_query(spark, registered[name], RUNS)
        print(f"{name}: {queries[name]}s", file=sys.stderr)
    compare = {}
    for name, fn in COMPARE.items():
        if only and name not in only:
            continue
        compare[name], _ = time_query(spark, fn, RUNS)
        print(f"{name}: {compare[name]}s", file=sys.stderr)
    out = {"metric": "total_sec", "value": round(sum(queries.values()), 3), "unit": "sec",
           "queries": queries, "cold": cold, "warm_up": "one untimed query, then one cold run a query",
           "compare": compare, "sf": _sf(SF_DIR), "cpus": CPUS, "runs": RUNS}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
