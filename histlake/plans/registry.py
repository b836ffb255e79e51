"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads whole tables.  Two versions of a table (``old`` / ``new``)
are derived from one snapshot by key arithmetic -- deletions, insertions and
price changes spread over the whole key range -- which is how a change set
is produced from a single extract; nothing is sampled or capped.

Timestamps are returned as ``yyyy-MM-dd HH:mm:ss`` text so that both
engines print them the same way; ids use the key as ``ori_id`` so they do
not depend on partitioning.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..functions.fingerprint import check_key, row_checksum
from ..functions.ids import MINUTE_SHIFT, WIDE_SHIFT, batch_minutes, surrogate_id
from ..functions.slots import day_slot, slot_of
from ..operators import (as_of, backfill_rows, change_report, clean_required, close_rows, current,
                         drop_exact_duplicates, expire_rows, latest_batch, latest_per_key,
                         matched, open_rows, repair_rows, snapshot_diff, snapshot_rows,
                         stamp_load, unmatched, upsert_rows)
from ..session import new_run_dir
from ..sources.raw import conform, conform_losses, read_raw, write_raw
from ..sources.tables import append_by_name, create_layers, table_location
from .loads import backfill, ods_dedup, rebuild_and_repair, repair, retain, snapshot_load, upsert
from .spec import TableSpec

# Batch times of the examples: three Wednesdays (weekday slot 3), days 13/20/27.
T1 = "2022-04-13 10:11:12"
T2 = "2022-04-20 10:11:12"
T3 = "2022-04-27 10:11:12"
T3_LATER = "2022-04-27 15:00:00"
SLOT_TIMES = (T1, T2, T3)
AS_OF = "2022-04-16 00:00:00"
EXTRA_FILTER = "o_totalprice > 50000"

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
          "o_orderpriority"]
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]
M_TAIL = ["dl_loaded_dt", "dl_start_dt", "dl_end_dt", "dl_status", "day"]


# ---------------------------------------------------------------- inputs
def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def orders_old(spark, d):
    return _t(spark, d, "orders").filter(F.col("o_orderkey") % 5 != 0)


def orders_new(spark, d):
    o = _t(spark, d, "orders").filter((F.col("o_orderkey") % 7 != 0) | (F.col("o_orderkey") % 5 == 0))
    price = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return o.withColumn("o_totalprice", price)


def orders_third(spark, d):
    """Third batch of arrivals: every finished order again, 2 dearer."""
    o = _t(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    return o.withColumn("o_totalprice", F.col("o_totalprice") + 2)


def customer_old(spark, d):
    return _t(spark, d, "customer").filter(F.col("c_custkey") % 5 != 0)


def customer_new(spark, d):
    c = _t(spark, d, "customer").filter((F.col("c_custkey") % 7 != 0) | (F.col("c_custkey") % 5 == 0))
    bal = F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    return c.withColumn("c_acctbal", bal)


def orders_with_nulls(spark, d):
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 17 == 0, F.lit(None)).otherwise(k).alias("o_orderkey"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate",
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


def orders_raw_strings(spark, d):
    """orders as raw text, some values damaged: input of ``conform``."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    cols = []
    for c in ORDERS:
        txt = F.col(c).cast("string")
        if c == "o_totalprice":
            txt = F.when(k % 11 == 0, F.lit("n/a")).otherwise(txt)
        if c == "o_orderdate":
            txt = F.when(k % 13 == 0, F.lit("")).otherwise(txt)
        cols.append(txt.alias(c))
    return o.select(*cols)


def orders_spec(db: str = "default", **kw) -> TableSpec:
    return TableSpec(name="orders", database=db, keys=("o_orderkey",),
                     required=("o_custkey",),
                     columns=(("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                              ("o_orderstatus", "varchar(10)"), ("o_totalprice", "double"),
                              ("o_orderdate", "timestamp"), ("o_orderpriority", "varchar(15)")),
                     **kw)


def events_by_day(spark, d):
    """events as daily loads: each row's batch is the start of its day."""
    e = _t(spark, d, "events")
    return e.withColumn("load_batch", F.date_trunc("day", "ts").cast("timestamp_ntz"))


def events_spec(db: str = "default", **kw) -> TableSpec:
    """events kept as versions per user: the user's newest event of each load."""
    return TableSpec(name="events", database=db, keys=("user_id",),
                     columns=(("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"),
                              ("event_type", "varchar(20)"), ("value", "double"),
                              ("props", "varchar(200)")), **kw)


def lineitem_spec(db: str = "default", **kw) -> TableSpec:
    """lineitem keyed by (order, line number): the extract repeats keys."""
    return TableSpec(name="lineitem", database=db, keys=("l_orderkey", "l_linenumber"),
                     columns=(("l_orderkey", "bigint"), ("l_partkey", "bigint"),
                              ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                              ("l_quantity", "double"), ("l_extendedprice", "double"),
                              ("l_discount", "double"), ("l_tax", "double"),
                              ("l_returnflag", "varchar(1)"), ("l_linestatus", "varchar(1)"),
                              ("l_shipdate", "timestamp")), **kw)


LINE_ORI_ID = "l_orderkey * 8 + l_linenumber"   # one number per (order, line); lines are 1..7
SHIPPED_BY = "2000-01-01 00:00:00"


def customer_spec(db: str = "default", **kw) -> TableSpec:
    return TableSpec(name="customer", database=db, keys=("c_custkey",),
                     columns=(("c_custkey", "bigint"), ("c_name", "varchar(25)"),
                              ("c_nationkey", "int"), ("c_acctbal", "double"),
                              ("c_mktsegment", "varchar(10)")), **kw)


# ---------------------------------------------------------------- output
def present(df: DataFrame) -> DataFrame:
    """Timestamps as text, so both engines print them alike."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _empty_m(spark, d):
    return open_rows(customer_old(spark, d), T1, ori_id="c_custkey").filter(F.lit(False))


def _m_two_batches(spark, d):
    """Main table after three upsert batches of orders."""
    k = ["o_orderkey"]
    m1 = open_rows(orders_old(spark, d), T1, ori_id="o_orderkey")
    m2 = upsert_rows(m1, orders_new(spark, d), k, T2, required=["o_custkey"], ori_id="o_orderkey")
    h2 = m2.filter(F.col("dl_status") == "H")
    m3 = upsert_rows(current(m2), orders_third(spark, d), k, T3, required=["o_custkey"],
                     ori_id="o_orderkey")
    return h2.unionByName(m3)


def _fresh_db(spark: SparkSession, label: str):
    rd = new_run_dir(spark, label)
    db = "hl_" + rd.rsplit("-", 1)[-1]
    return rd, db


# ---------------------------------------------------------------- queries
def q_stamp_load(spark, d):
    return present(stamp_load(_t(spark, d, "orders"), T1))


def q_open_rows(spark, d):
    return present(open_rows(_t(spark, d, "orders"), T1, ori_id="o_orderkey"))


def q_close_rows(spark, d):
    return present(close_rows(open_rows(_t(spark, d, "orders"), T1, ori_id="o_orderkey"), T2, "H"))


def q_clean_required(spark, d):
    return present(clean_required(orders_with_nulls(spark, d),
                                  ["o_orderkey", "o_custkey", "o_orderpriority"]))


def q_day_slots(spark, d):
    e = _t(spark, d, "events")
    return present(e.select("event_id", "ts", day_slot("ts", "week").alias("week_slot"),
                            day_slot("ts", "month").alias("month_slot")))


def q_row_checksum(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", row_checksum(CUSTOMER).alias("dl_checksum"))


def q_row_checksum_compat(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", row_checksum(CUSTOMER, strict=False).alias("dl_checksum"))


def q_check_key(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", check_key(["c_custkey"], row_checksum(CUSTOMER)).alias("dl_check_key"))


def q_latest_batch(spark, d):
    e = _t(spark, d, "events")
    ff = e.select("*", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("dl_loaded_dt"),
                  day_slot("ts", "month").alias("day"))
    return present(latest_batch(ff))


def q_keys_matched(spark, d):
    a = open_rows(customer_old(spark, d), T1, ori_id="c_custkey")
    return present(matched(a, customer_new(spark, d), ["c_custkey"]))


def q_keys_unmatched(spark, d):
    a = open_rows(customer_old(spark, d), T1, ori_id="c_custkey")
    return present(unmatched(a, customer_new(spark, d), ["c_custkey"]))


def q_snapshot_diff(spark, d):
    diff = snapshot_diff(orders_old(spark, d), orders_new(spark, d), ["o_orderkey"])
    parts = [diff.opened.withColumn("part", F.lit("opened")),
             diff.closed.withColumn("part", F.lit("closed")),
             diff.kept.withColumn("part", F.lit("kept"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return present(out.select(*ORDERS, "dl_checksum", "part"))


def q_change_report(spark, d):
    return change_report(orders_old(spark, d), orders_new(spark, d), ["o_orderkey"])


def q_snapshot_diff_counts(spark, d):
    rep = change_report(orders_old(spark, d), orders_new(spark, d), ["o_orderkey"])
    return rep.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def q_scd2_upsert(spark, d):
    a = open_rows(orders_old(spark, d), T1, ori_id="o_orderkey")
    return present(upsert_rows(a, orders_new(spark, d), ["o_orderkey"], T2,
                               required=["o_custkey"], ori_id="o_orderkey"))


def q_scd2_repair(spark, d):
    a = open_rows(orders_old(spark, d), T1, ori_id="o_orderkey")
    return present(repair_rows(a, orders_new(spark, d), ["o_orderkey"], T2,
                               required=["o_custkey"], ori_id="o_orderkey"))


def q_snapshot_rotate(spark, d):
    k = ["c_custkey"]
    m1 = snapshot_rows(_empty_m(spark, d), customer_old(spark, d), k, T1, ori_id="c_custkey")
    m2 = snapshot_rows(m1, customer_new(spark, d), k, T2, ori_id="c_custkey")
    m3 = snapshot_rows(m2, customer_old(spark, d), k, T3, ori_id="c_custkey")
    return present(m3)


def q_scd2_two_batches(spark, d):
    return present(_m_two_batches(spark, d))


def q_current_rows(spark, d):
    return present(current(_m_two_batches(spark, d)))


def q_as_of(spark, d):
    return present(as_of(_m_two_batches(spark, d), AS_OF))


def q_expire_history(spark, d):
    return present(expire_rows(_m_two_batches(spark, d), T3))


def q_latest_per_key(spark, d):
    return present(latest_per_key(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                                  ["l_shipdate"]))


def _ff_two_loads(spark, d):
    return stamp_load(_t(spark, d, "orders"), T1).unionByName(stamp_load(orders_new(spark, d), T2))


def q_drop_exact_duplicates(spark, d):
    return present(drop_exact_duplicates(_ff_two_loads(spark, d), ["o_orderkey"]))


def q_latest_per_key_ods(spark, d):
    return present(latest_per_key(_ff_two_loads(spark, d), ["o_orderkey"], ["dl_loaded_dt"]))


def q_conform(spark, d):
    return present(conform(orders_raw_strings(spark, d), orders_spec().schema))


def q_conform_losses(spark, d):
    return conform_losses(orders_raw_strings(spark, d), orders_spec().schema)


def q_conform_text(spark, d):
    rd = new_run_dir(spark, "raw")
    write_raw(orders_raw_strings(spark, d), f"{rd}/f_orders")
    raw = read_raw(spark, f"{rd}/f_orders", ORDERS)
    return present(conform(raw, orders_spec().schema))


def q_tables_upsert(spark, d):
    rd, db = _fresh_db(spark, "q-upsert")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T2, arrivals=orders_new(spark, d), ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_upsert_bucketed(spark, d):
    rd, db = _fresh_db(spark, "q-upsert-b")
    spec = orders_spec(db, buckets=8)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T2, arrivals=orders_new(spark, d), ori_id="o_orderkey",
           broadcast_limit=0)
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_retain(spark, d):
    rd, db = _fresh_db(spark, "q-retain")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T2, arrivals=orders_new(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T3, arrivals=orders_third(spark, d), ori_id="o_orderkey")
    retain(spark, spec, T3)
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_repair(spark, d):
    rd, db = _fresh_db(spark, "q-repair")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    rebuild_and_repair(spark, spec, T2, snapshot=orders_new(spark, d), ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_repair_bucketed(spark, d):
    rd, db = _fresh_db(spark, "q-repair-b")
    spec = orders_spec(db, buckets=8)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    rebuild_and_repair(spark, spec, T2, snapshot=orders_new(spark, d), ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_snapshot(spark, d):
    rd, db = _fresh_db(spark, "q-snapshot")
    spec = customer_spec(db)
    create_layers(spark, spec, rd)
    for ts, src in ((T1, customer_old), (T2, customer_new), (T3, customer_old)):
        snapshot_load(spark, spec, ts, snapshot=src(spark, d), ori_id="c_custkey")
    return present(spark.table(spec.m_table).select("dl_id", *CUSTOMER, *M_TAIL))


def _ff_loaded_table(spark, d, label):
    rd, db = _fresh_db(spark, label)
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    append_by_name(stamp_load(_t(spark, d, "orders"), T1), spec.ff_table)
    append_by_name(stamp_load(orders_new(spark, d), T2), spec.ff_table)
    return spec


def q_tables_ods_dedup(spark, d):
    spec = _ff_loaded_table(spark, d, "q-dedup-row")
    ods_dedup(spark, spec, ["dl_loaded_dt"], by="row")
    return present(spark.table(spec.ff_table).select(*ORDERS, "dl_loaded_dt", "day"))


def q_tables_ods_dedup_key(spark, d):
    spec = _ff_loaded_table(spark, d, "q-dedup-key")
    ods_dedup(spark, spec, ["dl_loaded_dt"], by="key")
    return present(spark.table(spec.ff_table).select(*ORDERS, "dl_loaded_dt", "day"))


def q_scd2_backfill(spark, d):
    rows = backfill_rows(None, events_by_day(spark, d), ["user_id"], "load_batch",
                         ["ts", "event_id"], ori_id="event_id")
    return present(rows)


def q_stream_upsert(spark, d):
    """Structured Streaming: two raw file batches (old, then new orders)
    arrive in a folder; the file-source stream upserts each into the tables."""
    from ..streaming import upsert_stream
    rd, db = _fresh_db(spark, "q-stream")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    clock = iter([_dt.datetime.fromisoformat(T1), _dt.datetime.fromisoformat(T2)])
    for i, batch in enumerate((orders_old, orders_new)):
        write_raw(batch(spark, d), f"{rd}/incoming/batch{i}")
        q = upsert_stream(spark, spec, f"{rd}/incoming/*", checkpoint=f"{rd}/stream",
                          clock=lambda: next(clock), ori_id="o_orderkey")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_upsert_composite(spark, d):
    """Two loads of lineitem keyed by (order, line): the lines shipped before
    2000, then all lines; repeated keys keep their newest arrival."""
    rd, db = _fresh_db(spark, "q-upsert-composite")
    spec = lineitem_spec(db)
    create_layers(spark, spec, rd)
    li = _t(spark, d, "lineitem")
    early = li.filter(F.col("l_shipdate") < F.lit(SHIPPED_BY).cast("timestamp_ntz"))
    for ts, batch in ((T1, early), (T2, li)):
        upsert(spark, spec, ts, arrivals=batch, dedupe_arrivals=["l_shipdate"],
               ori_id=F.expr(LINE_ORI_ID))
    return present(spark.table(spec.m_table).select("dl_id", *LINEITEM, *M_TAIL))


def q_tables_backfill(spark, d):
    rd, db = _fresh_db(spark, "q-backfill")
    spec = events_spec(db)
    create_layers(spark, spec, rd)
    backfill(spark, spec, events_by_day(spark, d), "load_batch", ["ts", "event_id"],
             ori_id="event_id")
    return present(spark.table(spec.m_table).select("dl_id", *EVENTS, *M_TAIL))


def q_open_rows_wide(spark, d):
    o = _t(spark, d, "orders")
    ids = surrogate_id(T1, "o_orderkey", wide=True).alias("dl_id")
    return o.select(ids, "o_orderkey")


def q_tables_default_ids(spark, d):
    """Two loads whose ids the library draws: all but the id, and how many ids there are."""
    rd, db = _fresh_db(spark, "q-ids")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d))
    upsert(spark, spec, T2, arrivals=orders_new(spark, d))
    m = spark.table(spec.m_table)
    n = m.agg(F.countDistinct("dl_id").alias("ids"))
    return present(m.select(*ORDERS, *M_TAIL)).withColumn("ids", n.scalar())


def q_conform_text_empty(spark, d):
    """Empty text in a string column survives the raw layer; null stays null."""
    o = orders_with_nulls(spark, d)
    text = F.when(F.col("o_custkey") % 4 == 0, F.lit("")).otherwise(F.col("o_orderpriority"))
    rd = new_run_dir(spark, "raw")
    write_raw(o.select(*ORDERS[:-1], text.alias("o_orderpriority")), f"{rd}/f_orders")
    return present(conform(read_raw(spark, f"{rd}/f_orders", ORDERS), orders_spec().schema))


def q_tables_upsert_from_raw(spark, d):
    """The default path: the extract lies in f as text, the load reads it there."""
    rd, db = _fresh_db(spark, "q-raw")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    for ts, src in ((T1, orders_old), (T2, orders_new)):
        write_raw(src(spark, d), table_location(spark, spec.f_table))
        upsert(spark, spec, ts, ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def _ods(spark, spec, cols):
    return present(spark.table(spec.ff_table).select(*cols, "dl_loaded_dt", "day"))


def q_tables_upsert_ods(spark, d):
    rd, db = _fresh_db(spark, "q-upsert-ods")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T2, arrivals=orders_new(spark, d), ori_id="o_orderkey")
    return _ods(spark, spec, ORDERS)


def q_tables_repair_ods(spark, d):
    rd, db = _fresh_db(spark, "q-repair-ods")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    rebuild_and_repair(spark, spec, T2, snapshot=orders_new(spark, d), ori_id="o_orderkey")
    return _ods(spark, spec, ORDERS)


def q_tables_snapshot_ods(spark, d):
    """Weekly slot reused twice, then loaded again on the same day."""
    rd, db = _fresh_db(spark, "q-snapshot-ods")
    spec = customer_spec(db)
    create_layers(spark, spec, rd)
    for ts, src in ((T1, customer_old), (T2, customer_new), (T3, customer_old), (T3_LATER, customer_new)):
        snapshot_load(spark, spec, ts, snapshot=src(spark, d), ori_id="c_custkey")
    return _ods(spark, spec, CUSTOMER)


def q_tables_repair_alone(spark, d):
    """Repair against an ODS copy that earlier loads built."""
    rd, db = _fresh_db(spark, "q-repair-alone")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    append_by_name(stamp_load(orders_new(spark, d), T2), spec.ff_table)
    repair(spark, spec, T3, ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_upsert_filter(spark, d):
    """A table with a predicate of its own on the rows that may open."""
    rd, db = _fresh_db(spark, "q-filter")
    spec = orders_spec(db, extra_filter=EXTRA_FILTER)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T2, arrivals=orders_new(spark, d), ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_upsert_slots(spark, d):
    """Four loads over three day slots; the last closes versions of all of them."""
    rd, db = _fresh_db(spark, "q-slots")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    for ts, part in zip(SLOT_TIMES, (0, 1, 2), strict=True):
        upsert(spark, spec, ts, arrivals=_t(spark, d, "orders").where(F.col("o_orderkey") % 3 == part),
               ori_id="o_orderkey")
    upsert(spark, spec, T3_LATER, arrivals=orders_third(spark, d), ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_upsert_embeddings(spark, d):
    """A table with an array column, its spec read from the schema."""
    rd, db = _fresh_db(spark, "q-embeddings")
    e = _t(spark, d, "embeddings")
    spec = TableSpec.from_schema("embeddings", e.schema, ("vec_id",), database=db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=e, ori_id="vec_id")
    m = spark.table(spec.m_table)
    return present(m.select("dl_id", "vec_id", "label", F.size("embedding").alias("dims"),
                            F.md5(F.array_join(F.transform("embedding", lambda x: F.floor(
                                x.cast("double") * 10_000).cast("string")), ",")).alias("digest"), *M_TAIL))


def q_tables_backfill_twice(spark, d):
    """Two consecutive ranges; the second closes versions of the first."""
    rd, db = _fresh_db(spark, "q-backfill-twice")
    spec = events_spec(db)
    create_layers(spark, spec, rd)
    e = events_by_day(spark, d)
    for part in ("day(ts) <= 15", "day(ts) > 15"):
        backfill(spark, spec, e.where(part), "load_batch", ["ts", "event_id"], ori_id="event_id")
    return present(spark.table(spec.m_table).select("dl_id", *EVENTS, *M_TAIL))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "open_rows_wide": q_open_rows_wide,
    "tables_default_ids": q_tables_default_ids,
    "conform_text_empty": q_conform_text_empty,
    "tables_upsert_from_raw": q_tables_upsert_from_raw,
    "tables_upsert_ods": q_tables_upsert_ods,
    "tables_repair_ods": q_tables_repair_ods,
    "tables_snapshot_ods": q_tables_snapshot_ods,
    "tables_repair_alone": q_tables_repair_alone,
    "tables_upsert_filter": q_tables_upsert_filter,
    "tables_upsert_slots": q_tables_upsert_slots,
    "tables_backfill_twice": q_tables_backfill_twice,
    "tables_upsert_embeddings": q_tables_upsert_embeddings,
    "stamp_load": q_stamp_load,
    "open_rows": q_open_rows,
    "close_rows": q_close_rows,
    "clean_required": q_clean_required,
    "day_slots": q_day_slots,
    "row_checksum": q_row_checksum,
    "row_checksum_compat": q_row_checksum_compat,
    "check_key": q_check_key,
    "latest_batch": q_latest_batch,
    "keys_matched": q_keys_matched,
    "keys_unmatched": q_keys_unmatched,
    "snapshot_diff": q_snapshot_diff,
    "change_report": q_change_report,
    "snapshot_diff_counts": q_snapshot_diff_counts,
    "scd2_upsert": q_scd2_upsert,
    "scd2_repair": q_scd2_repair,
    "snapshot_rotate": q_snapshot_rotate,
    "scd2_two_batches": q_scd2_two_batches,
    "current_rows": q_current_rows,
    "as_of": q_as_of,
    "expire_history": q_expire_history,
    "latest_per_key": q_latest_per_key,
    "latest_per_key_ods": q_latest_per_key_ods,
    "drop_exact_duplicates": q_drop_exact_duplicates,
    "conform": q_conform,
    "conform_losses": q_conform_losses,
    "conform_text": q_conform_text,
    "tables_upsert": q_tables_upsert,
    "tables_upsert_bucketed": q_tables_upsert_bucketed,
    "tables_retain": q_tables_retain,
    "tables_repair": q_tables_repair,
    "tables_repair_bucketed": q_tables_repair_bucketed,
    "tables_snapshot": q_tables_snapshot,
    "tables_ods_dedup": q_tables_ods_dedup,
    "tables_ods_dedup_key": q_tables_ods_dedup_key,
    "scd2_backfill": q_scd2_backfill,
    "tables_backfill": q_tables_backfill,
    "stream_upsert": q_stream_upsert,
    "tables_upsert_composite": q_tables_upsert_composite,
}


# ---------------------------------------------------------------- oracle SQL
def _ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def _fmt(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _id_sql(batch: str, key: str) -> str:
    high = batch_minutes(batch) << MINUTE_SHIFT
    k = f"CAST({key} AS BIGINT)"
    return (f"CAST(CAST('{high}' AS HUGEINT) + CAST((({k} >> 33) << 30) AS HUGEINT)"
            f" + CAST(({k} & 8589934591) AS HUGEINT) AS VARCHAR)")


def _cols(cols, alias="", fmt_ts=()):
    out = []
    for c in cols:
        ref = f"{alias}.{c}" if alias else c
        out.append(f"{_fmt(ref)} AS {c}" if c in fmt_ts else f"{ref} AS {c}")
    return ", ".join(out)


ORDERS_TS = ("o_orderdate",)
TS_ALL = ("o_orderdate", "l_shipdate", "ts", "dl_loaded_dt", "dl_start_dt", "dl_end_dt")

SQL_ORDERS_OLD = "(SELECT * FROM orders WHERE o_orderkey % 5 <> 0)"
SQL_ORDERS_NEW = ("(SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 "
                  "THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, "
                  "o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 5 = 0)")
SQL_ORDERS_THIRD = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2 AS o_totalprice, "
                    "o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'F')")
SQL_CUSTOMER_OLD = "(SELECT * FROM customer WHERE c_custkey % 5 <> 0)"
SQL_CUSTOMER_NEW = ("(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 = 0 "
                    "THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment "
                    "FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 5 = 0)")


def _open_sql(src: str, cols, key: str, batch: str, slot: int) -> str:
    """m-shaped rows opened at ``batch`` (raw timestamps)."""
    return (f"SELECT {_id_sql(batch, key)} AS dl_id, {', '.join(cols)}, "
            f"{_ts(batch)} AS dl_loaded_dt, {_ts(batch)} AS dl_start_dt, "
            f"TIMESTAMP '9999-12-31 00:00:00' AS dl_end_dt, 'A' AS dl_status, "
            f"CAST({slot} AS INTEGER) AS day FROM {src} s")


def _close_sql(src: str, cols, batch: str, status: str, slot: int, where: str = "") -> str:
    return (f"SELECT dl_id, {', '.join(cols)}, {_ts(batch)} AS dl_loaded_dt, dl_start_dt, "
            f"{_ts(batch)} AS dl_end_dt, '{status}' AS dl_status, CAST({slot} AS INTEGER) AS day "
            f"FROM {src} {where}")


def _m_select(src: str, cols) -> str:
    return f"SELECT {_cols(['dl_id', *cols, *M_TAIL], fmt_ts=TS_ALL)} FROM {src}"


def _ck_sql(cols, alias="") -> str:
    p = f"{alias}." if alias else ""
    parts = ", ".join(f"coalesce(CAST({p}{c} AS VARCHAR), chr(30))" for c in cols)
    return f"md5(concat_ws(chr(31), {parts}))"


def _upsert_sql(a: str, n: str, cols, key: str, batch: str, required) -> str:
    """One upsert batch: kept + closed + opened (raw timestamps)."""
    slot = slot_of(batch, "month")
    req = " AND ".join(f"{c} IS NOT NULL" for c in [key, *required])
    nc = f"(SELECT * FROM {n} WHERE {req})"
    return (f"SELECT * FROM {a} WHERE NOT EXISTS (SELECT 1 FROM {nc} x WHERE x.{key} = {a}.{key}) "
            f"UNION ALL "
            + _close_sql(a, cols, batch, "H", slot,
                         f"WHERE EXISTS (SELECT 1 FROM {nc} x WHERE x.{key} = {a}.{key})")
            + " UNION ALL " + _open_sql(nc, cols, key, batch, slot))


def _two_batches_sql() -> str:
    k, req = "o_orderkey", ["o_custkey"]
    return (f"WITH m1 AS ({_open_sql(SQL_ORDERS_OLD, ORDERS, k, T1, slot_of(T1, 'month'))}), "
            f"m2 AS ({_upsert_sql('m1', SQL_ORDERS_NEW, ORDERS, k, T2, req)}), "
            f"a2 AS (SELECT * FROM m2 WHERE dl_status = 'A'), "
            f"m3 AS (SELECT * FROM m2 WHERE dl_status = 'H' UNION ALL "
            f"{_upsert_sql('a2', SQL_ORDERS_THIRD, ORDERS, k, T3, req)}) ")


def _repair_sql() -> str:
    k = "o_orderkey"
    slot = slot_of(T2, "month")
    return (f"WITH a AS ({_open_sql(SQL_ORDERS_OLD, ORDERS, k, T1, slot_of(T1, 'month'))}), "
            f"ak AS (SELECT *, {_ck_sql(ORDERS)} AS ck FROM a), "
            f"n AS (SELECT *, {_ck_sql(ORDERS)} AS ck FROM {SQL_ORDERS_NEW}), "
            f"kept AS (SELECT * FROM ak WHERE EXISTS (SELECT 1 FROM n WHERE n.{k} IS NOT DISTINCT FROM ak.{k} AND n.ck = ak.ck)), "
            f"gone AS (SELECT * FROM ak WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.{k} IS NOT DISTINCT FROM ak.{k} AND n.ck = ak.ck)), "
            f"fresh AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM ak WHERE ak.{k} IS NOT DISTINCT FROM n.{k} AND ak.ck = n.ck) "
            f"AND o_orderkey IS NOT NULL AND o_custkey IS NOT NULL), "
            f"r AS (SELECT dl_id, {', '.join(ORDERS)}, {', '.join(M_TAIL)} FROM kept UNION ALL "
            f"{_close_sql('gone', ORDERS, T2, 'H', slot)} UNION ALL "
            f"{_open_sql('fresh', ORDERS, k, T2, slot)}) ")


def _snapshot_sql() -> str:
    k = "c_custkey"
    w = slot_of(T1, "week")
    # after T1: A(old@T1); after T2: P(old T1->T2) + A(new@T2);
    # after T3: P slot emptied, P(new T2->T3) + A(old@T3)
    return (f"WITH a2 AS ({_open_sql(SQL_CUSTOMER_NEW, CUSTOMER, k, T2, w)}), "
            f"m3 AS ({_close_sql('a2', CUSTOMER, T3, 'P', w)} UNION ALL "
            f"{_open_sql(SQL_CUSTOMER_OLD, CUSTOMER, k, T3, w)}) ")


def _ff_two_loads_sql() -> str:
    return (f"WITH u AS (SELECT *, {_ts(T1)} AS dl_loaded_dt, CAST({slot_of(T1, 'month')} AS INTEGER) AS day "
            f"FROM orders UNION ALL SELECT *, {_ts(T2)} AS dl_loaded_dt, "
            f"CAST({slot_of(T2, 'month')} AS INTEGER) AS day FROM {SQL_ORDERS_NEW}) ")


def _raw_strings_sql() -> str:
    return ("(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
            "o_orderstatus, CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice, "
            "CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_orderdate AS VARCHAR) END AS o_orderdate, "
            "o_orderpriority FROM orders)")


def _conform_sql() -> str:
    r = _raw_strings_sql()
    return (f"SELECT TRY_CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(o_custkey AS BIGINT) AS o_custkey, "
            f"o_orderstatus, TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice, "
            f"{_fmt('TRY_CAST(o_orderdate AS TIMESTAMP)')} AS o_orderdate, o_orderpriority FROM {r} r")


def _backfill_cte() -> str:
    minutes = "((CAST(epoch(batch) AS BIGINT) - 946656000) // 60)"
    k = "CAST(event_id AS BIGINT)"
    dl_id = (f"CAST(CAST({minutes} AS HUGEINT) * CAST('{1 << MINUTE_SHIFT}' AS HUGEINT) "
             f"+ CAST((({k} >> 33) << 30) AS HUGEINT) + CAST(({k} & 8589934591) AS HUGEINT) AS VARCHAR)")
    return ("WITH b AS (SELECT *, date_trunc('day', ts) AS batch FROM events), "
            "n AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, batch "
            "ORDER BY ts DESC, event_id DESC) = 1), "
            "v AS (SELECT *, lead(batch) OVER (PARTITION BY user_id ORDER BY batch) AS nxt FROM n), "
            f"r AS (SELECT {dl_id} AS dl_id, {', '.join(EVENTS)}, coalesce(nxt, batch) AS dl_loaded_dt, "
            "batch AS dl_start_dt, coalesce(nxt, TIMESTAMP '9999-12-31 00:00:00') AS dl_end_dt, "
            "CASE WHEN nxt IS NULL THEN 'A' ELSE 'H' END AS dl_status, "
            "CAST(day(coalesce(nxt, batch)) AS INTEGER) AS day FROM v) ")


def _backfill_sql() -> str:
    return _backfill_cte() + _m_select("r", EVENTS)


def _composite_sql() -> str:
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in LINEITEM if c not in (*keys, "l_shipdate")]
    order = ", ".join(["l_shipdate DESC NULLS LAST", *[f"{c} ASC NULLS FIRST" for c in rest]])
    newest = (f"SELECT * FROM {{src}} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
              f"ORDER BY {order}) = 1")
    n1 = newest.format(src=f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SHIPPED_BY}')")
    n2 = newest.format(src="lineitem")
    s1, s2 = slot_of(T1, "month"), slot_of(T2, "month")

    def opened(src, batch, slot):
        return (f"SELECT {_id_sql(batch, '(l_orderkey * 8 + l_linenumber)')} AS dl_id, "
                f"{', '.join(LINEITEM)}, {_ts(batch)} AS dl_loaded_dt, {_ts(batch)} AS dl_start_dt, "
                f"TIMESTAMP '9999-12-31 00:00:00' AS dl_end_dt, 'A' AS dl_status, "
                f"CAST({slot} AS INTEGER) AS day FROM {src} s")
    match = "EXISTS (SELECT 1 FROM n2 x WHERE x.l_orderkey = a.l_orderkey AND x.l_linenumber = a.l_linenumber)"
    return (f"WITH n1 AS ({n1}), n2 AS ({n2}), a AS ({opened('n1', T1, s1)}), "
            f"r AS (SELECT * FROM a WHERE NOT {match} UNION ALL "
            f"{_close_sql('a', LINEITEM, T2, 'H', s2, 'WHERE ' + match)} UNION ALL "
            f"{opened('n2', T2, s2)}) " + _m_select("r", LINEITEM))


def oracle_sql() -> dict[str, str]:
    s1, s2 = slot_of(T1, "month"), slot_of(T2, "month")
    k = "o_orderkey"
    open_t1 = _open_sql("orders", ORDERS, k, T1, s1)
    upsert_sql = (f"WITH a AS ({_open_sql(SQL_ORDERS_OLD, ORDERS, k, T1, s1)}), "
                  f"r AS ({_upsert_sql('a', SQL_ORDERS_NEW, ORDERS, k, T2, ['o_custkey'])}) "
                  + _m_select("r", ORDERS))
    repair_sql = _repair_sql() + _m_select("r", ORDERS)
    snapshot_sql = _snapshot_sql() + _m_select("m3", CUSTOMER)
    two = _two_batches_sql()
    cust_open = (f"WITH a AS ({_open_sql(SQL_CUSTOMER_OLD, CUSTOMER, 'c_custkey', T1, s1)}) ")
    ff2 = _ff_two_loads_sql()
    dedup_row = (ff2 + f"SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, {_fmt('max(dl_loaded_dt)')} AS dl_loaded_dt, "
                 f"arg_max(day, dl_loaded_dt) AS day FROM u GROUP BY ALL")
    dedup_key = (ff2 + f"SELECT {_cols([*ORDERS, 'dl_loaded_dt', 'day'], fmt_ts=TS_ALL)} FROM u "
                 f"QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY dl_loaded_dt DESC) = 1")
    li_rest = [c for c in LINEITEM if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    li_order = ", ".join(["l_shipdate DESC NULLS LAST", *[f"{c} ASC NULLS FIRST" for c in li_rest]])
    s3 = slot_of(T3, "month")
    upsert_cte = (f"WITH a AS ({_open_sql(SQL_ORDERS_OLD, ORDERS, k, T1, s1)}), "
                  f"r AS ({_upsert_sql('a', SQL_ORDERS_NEW, ORDERS, k, T2, ['o_custkey'])}) ")
    nulls = ("(SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, "
             "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, "
             "o_orderdate, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority "
             "FROM orders)")

    def loaded(src, cols, ts, slot):
        return (f"SELECT {', '.join(cols)}, {_ts(ts)} AS dl_loaded_dt, CAST({slot} AS INTEGER) AS day "
                f"FROM {src} s")

    def ods(parts, cols):
        return (f"WITH u AS ({' UNION ALL '.join(parts)}) "
                f"SELECT {_cols([*cols, 'dl_loaded_dt', 'day'], fmt_ts=TS_ALL)} FROM u")

    filtered = [f"(SELECT * FROM {t} WHERE {EXTRA_FILTER})" for t in (SQL_ORDERS_OLD, SQL_ORDERS_NEW)]
    thirds = " UNION ALL ".join(
        _open_sql(f"(SELECT * FROM orders WHERE o_orderkey % 3 = {i})", ORDERS, k, ts, slot_of(ts, "month"))
        for i, ts in enumerate(SLOT_TIMES))
    week = slot_of(T3, "week")
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in ORDERS)
    fresh = f"(SELECT * FROM {SQL_ORDERS_NEW} n WHERE NOT EXISTS (SELECT 1 FROM {SQL_ORDERS_OLD} o WHERE {same}))"
    q = {
        "open_rows_wide": f"SELECT CAST(CAST('{batch_minutes(T1) << WIDE_SHIFT}' AS HUGEINT) "
                          "+ CAST(o_orderkey AS HUGEINT) AS VARCHAR) AS dl_id, o_orderkey FROM orders",
        "tables_default_ids": upsert_cte + f"SELECT {_cols([*ORDERS, *M_TAIL], fmt_ts=TS_ALL)}, "
                              "(SELECT count(DISTINCT dl_id) FROM r) AS ids FROM r",
        "conform_text_empty": f"SELECT {_cols(ORDERS[:-1], fmt_ts=ORDERS_TS)}, CASE WHEN o_custkey % 4 = 0 THEN '' "
                              f"ELSE o_orderpriority END AS o_orderpriority FROM {nulls} n",
        "tables_upsert_from_raw": upsert_sql,
        "tables_upsert_ods": ods([loaded(SQL_ORDERS_OLD, ORDERS, T1, s1), loaded(SQL_ORDERS_NEW, ORDERS, T2, s2)],
                                 ORDERS),
        "tables_repair_ods": ods([loaded(SQL_ORDERS_NEW, ORDERS, T2, s2)], ORDERS),
        "tables_snapshot_ods": ods([loaded(SQL_CUSTOMER_OLD, CUSTOMER, T3, week),
                                    loaded(SQL_CUSTOMER_NEW, CUSTOMER, T3_LATER, week)], CUSTOMER),
        "tables_repair_alone": (f"WITH r AS ({_open_sql(SQL_ORDERS_OLD, ORDERS, k, T1, s1)} UNION ALL "
                                f"{_open_sql(fresh, ORDERS, k, T3, s3)}) " + _m_select("r", ORDERS)),
        "tables_upsert_filter": (f"WITH a AS ({_open_sql(filtered[0], ORDERS, k, T1, s1)}), "
                                 f"r AS ({_upsert_sql('a', filtered[1], ORDERS, k, T2, ['o_custkey'])}) "
                                 + _m_select("r", ORDERS)),
        "tables_upsert_slots": (f"WITH a AS ({thirds}), "
                                f"r AS ({_upsert_sql('a', SQL_ORDERS_THIRD, ORDERS, k, T3_LATER, ['o_custkey'])}) "
                                + _m_select("r", ORDERS)),
        "tables_backfill_twice": _backfill_sql(),
        "tables_upsert_embeddings": (
            "WITH e AS (SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, md5(array_to_string(list_transform("
            "embedding, lambda x: CAST(CAST(floor(CAST(x AS DOUBLE) * 10000) AS BIGINT) AS VARCHAR)), ',')) AS digest "
            f"FROM embeddings), r AS ({_open_sql('e', ['vec_id', 'label', 'dims', 'digest'], 'vec_id', T1, s1)}) "
            + _m_select("r", ["vec_id", "label", "dims", "digest"])),
        "stamp_load": f"SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, '{T1}' AS dl_loaded_dt, "
                      f"CAST({s1} AS INTEGER) AS day FROM orders",
        "open_rows": f"WITH r AS ({open_t1}) " + _m_select("r", ORDERS),
        "close_rows": f"WITH a AS ({open_t1}), r AS ({_close_sql('a', ORDERS, T2, 'H', s2)}) "
                      + _m_select("r", ORDERS),
        "clean_required": (
            "WITH n AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, "
            "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus, "
            "o_totalprice, o_orderdate, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END "
            "AS o_orderpriority FROM orders) "
            f"SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)} FROM n WHERE o_orderkey IS NOT NULL "
            "AND o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL"),
        "day_slots": f"SELECT event_id, {_fmt('ts')} AS ts, CAST(isodow(ts) AS INTEGER) AS week_slot, "
                     "CAST(day(ts) AS INTEGER) AS month_slot FROM events",
        "row_checksum": f"SELECT c_custkey, {_ck_sql(CUSTOMER)} AS dl_checksum FROM customer",
        "row_checksum_compat": "SELECT c_custkey, md5(concat_ws('', "
                               + ", ".join(f"CAST({c} AS VARCHAR)" for c in CUSTOMER)
                               + ")) AS dl_checksum FROM customer",
        "check_key": f"SELECT c_custkey, concat_ws(chr(31), coalesce(CAST(c_custkey AS VARCHAR), chr(30)), "
                     f"{_ck_sql(CUSTOMER)}) AS dl_check_key FROM customer",
        "latest_batch": "SELECT event_id, " + _fmt("ts") + " AS ts, user_id, event_type, value, props, "
                        + _fmt("date_trunc('day', ts)") + " AS dl_loaded_dt, CAST(day(ts) AS INTEGER) AS day "
                        "FROM events WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)",
        "keys_matched": cust_open + "SELECT " + _cols(['dl_id', *CUSTOMER, *M_TAIL], fmt_ts=TS_ALL)
                        + f" FROM a WHERE c_custkey IN (SELECT c_custkey FROM {SQL_CUSTOMER_NEW})",
        "keys_unmatched": cust_open + "SELECT " + _cols(['dl_id', *CUSTOMER, *M_TAIL], fmt_ts=TS_ALL)
                          + f" FROM a WHERE NOT EXISTS (SELECT 1 FROM {SQL_CUSTOMER_NEW} n "
                          "WHERE n.c_custkey = a.c_custkey)",
        "snapshot_diff": (
            f"WITH o AS (SELECT *, {_ck_sql(ORDERS)} AS dl_checksum FROM {SQL_ORDERS_OLD}), "
            f"n AS (SELECT *, {_ck_sql(ORDERS)} AS dl_checksum FROM {SQL_ORDERS_NEW}) "
            f"SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, dl_checksum, 'opened' AS part FROM n WHERE NOT EXISTS "
            "(SELECT 1 FROM o WHERE o.o_orderkey IS NOT DISTINCT FROM n.o_orderkey AND o.dl_checksum = n.dl_checksum) "
            f"UNION ALL SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, dl_checksum, 'closed' AS part FROM o WHERE NOT EXISTS "
            "(SELECT 1 FROM n WHERE n.o_orderkey IS NOT DISTINCT FROM o.o_orderkey AND n.dl_checksum = o.dl_checksum) "
            f"UNION ALL SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, dl_checksum, 'kept' AS part FROM o WHERE EXISTS "
            "(SELECT 1 FROM n WHERE n.o_orderkey IS NOT DISTINCT FROM o.o_orderkey AND n.dl_checksum = o.dl_checksum)"),
        "change_report": (
            f"WITH o AS (SELECT *, {_ck_sql(ORDERS)} AS ck FROM {SQL_ORDERS_OLD}), "
            f"n AS (SELECT *, {_ck_sql(ORDERS)} AS ck FROM {SQL_ORDERS_NEW}) "
            "SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'new' "
            "WHEN n.o_orderkey IS NULL THEN 'deleted' WHEN o.ck = n.ck THEN 'kept' ELSE 'updated' END AS change, "
            "CAST(CASE WHEN o.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS old_rows, "
            "CAST(CASE WHEN n.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS new_rows "
            "FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey"),
        "snapshot_diff_counts": (
            "SELECT CASE WHEN o.o_orderkey IS NULL THEN 'new' WHEN n.o_orderkey IS NULL THEN 'deleted' "
            "WHEN o.o_totalprice = n.o_totalprice THEN 'kept' ELSE 'updated' END AS change, count(*) AS n "
            f"FROM {SQL_ORDERS_OLD} o FULL OUTER JOIN {SQL_ORDERS_NEW} n ON o.o_orderkey = n.o_orderkey GROUP BY 1"),
        "scd2_upsert": upsert_sql,
        "scd2_repair": repair_sql,
        "snapshot_rotate": snapshot_sql,
        "scd2_two_batches": two + _m_select("m3", ORDERS),
        "current_rows": two + _m_select("m3", ORDERS) + " WHERE dl_status = 'A'",
        "as_of": two + _m_select("m3", ORDERS)
                 + f" WHERE dl_start_dt <= {_ts(AS_OF)} AND {_ts(AS_OF)} < dl_end_dt",
        "expire_history": two + _m_select("m3", ORDERS)
                          + f" WHERE NOT (dl_status = 'H' AND dl_end_dt < {_ts(T3)})",
        "latest_per_key": f"SELECT {_cols(LINEITEM, fmt_ts=TS_ALL)} FROM lineitem QUALIFY row_number() OVER "
                          f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {li_order}) = 1",
        "latest_per_key_ods": dedup_key,
        "drop_exact_duplicates": dedup_row,
        "conform": _conform_sql(),
        "conform_losses": (
            f"WITH r AS {_raw_strings_sql()} "
            "SELECT 'o_orderkey' AS column_name, CAST(count(*) FILTER (WHERE o_orderkey IS NOT NULL AND TRY_CAST(o_orderkey AS BIGINT) IS NULL) AS BIGINT) AS lost FROM r "
            "UNION ALL SELECT 'o_custkey', CAST(count(*) FILTER (WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS BIGINT) IS NULL) AS BIGINT) FROM r "
            "UNION ALL SELECT 'o_orderstatus', CAST(0 AS BIGINT) "
            "UNION ALL SELECT 'o_totalprice', CAST(count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DOUBLE) IS NULL) AS BIGINT) FROM r "
            "UNION ALL SELECT 'o_orderdate', CAST(count(*) FILTER (WHERE o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS TIMESTAMP) IS NULL) AS BIGINT) FROM r "
            "UNION ALL SELECT 'o_orderpriority', CAST(0 AS BIGINT)"),
        "conform_text": _conform_sql(),
        "tables_upsert": upsert_sql,
        "tables_upsert_bucketed": upsert_sql,
        "tables_retain": two + _m_select("m3", ORDERS)
                         + f" WHERE NOT (dl_status = 'H' AND dl_end_dt < {_ts(T3)})",
        "tables_repair": repair_sql,
        "tables_repair_bucketed": repair_sql,
        "tables_snapshot": snapshot_sql,
        "tables_ods_dedup": dedup_row,
        "tables_ods_dedup_key": dedup_key,
        "scd2_backfill": _backfill_sql(),
        "tables_backfill": _backfill_sql(),
        "stream_upsert": upsert_sql,
        "tables_upsert_composite": _composite_sql(),
    }
    from . import history_queries
    return q | history_queries.oracle_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import history_queries
    return QUERIES | history_queries.QUERIES


__all__ = ["AS_OF", "QUERIES", "T1", "T2", "T3", "oracle_sql", "present", "queries"]
