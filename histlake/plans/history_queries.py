"""Registered queries on histories: joins with them, their upkeep, and loads out
of the ordinary.  Conventions as in :mod:`histlake.plans.registry`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import as_of_join, coalesce_versions
from ..functions.ids import dense_ids, surrogate_id
from ..functions.slots import slot_of
from ..session import new_run_dir
from ..sources.raw import read_raw, split_raw, write_raw
from ..sources.tables import create_layers, drop_partitions, rotate_slot
from .compaction import compact
from .dedup_days import ods_dedup_days
from .digests import repair_by_digest
from .evolution import evolve
from .late import upsert_late
from .loads import backfill, rebuild_and_repair, repair, upsert
from .registry import (LINEITEM, M_TAIL, ORDERS, ORDERS_TS, SQL_ORDERS_NEW, SQL_ORDERS_OLD, SQL_ORDERS_THIRD, T1, T2,
                       T3, T3_LATER, _backfill_cte, _close_sql, _cols, _ff_loaded_table, _ff_two_loads_sql, _fmt,
                       _fresh_db, _id_sql, _m_select, _m_two_batches, _open_sql, _repair_sql, _t, _two_batches_sql,
                       _upsert_sql, events_by_day, events_spec, orders_new, orders_old, orders_spec, orders_third,
                       present)

LOOK_BACK_HOURS = 36


def q_as_of_join(spark, d):
    """Every event with the version its user had 36 hours before."""
    rd, db = _fresh_db(spark, "q-asof")
    spec = events_spec(db)
    create_layers(spark, spec, rd)
    backfill(spark, spec, events_by_day(spark, d), "load_batch", ["ts", "event_id"], ori_id="event_id")
    back = F.col("ts").cast("timestamp_ntz") - F.expr(f"interval {LOOK_BACK_HOURS} hours")
    points = _t(spark, d, "events").select("event_id", "user_id", back.alias("at"))
    return present(as_of_join(points, spark.table(spec.m_table), ["user_id"], "at").select(
        "event_id", "user_id", "at", "v_dl_id", "v_event_id", "v_event_type", "v_value", "v_dl_start_dt",
        "v_dl_end_dt", "v_dl_status"))


def q_coalesce_history(spark, d):
    """Three batches of orders; versions that repeat their predecessor joined with it."""
    return present(coalesce_versions(_m_two_batches(spark, d), ["o_orderkey"]).select(
        "dl_id", *ORDERS, *M_TAIL, "versions"))


def q_tables_upsert_late(spark, d):
    """Batches T1, T3 and then T2: the table is that of T1, T2, T3."""
    rd, db = _fresh_db(spark, "q-late")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    upsert(spark, spec, T3, arrivals=orders_third(spark, d), ori_id="o_orderkey")
    upsert_late(spark, spec, T2, arrivals=orders_new(spark, d), ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_repair_digest(spark, d):
    """The repair of ``tables_repair`` by digests: every bucket differs at T2,
    none does when the same snapshot comes again at T3."""
    rd, db = _fresh_db(spark, "q-digest")
    spec = orders_spec(db, buckets=8)
    create_layers(spark, spec, rd)
    upsert(spark, spec, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    rebuild_and_repair(spark, spec, T2, snapshot=orders_new(spark, d), method=repair_by_digest, ori_id="o_orderkey")
    repair_by_digest(spark, spec, T3, ori_id="o_orderkey")
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_upsert_indexed(spark, d):
    """Three batches; a key index tells which days of the slice hold an arriving key."""
    rd, db = _fresh_db(spark, "q-indexed")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    for ts, src in ((T1, orders_old), (T2, orders_new), (T3, orders_third)):
        upsert(spark, spec, ts, arrivals=src(spark, d), ori_id="o_orderkey", key_index=True)
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_dense_ids(spark, d):
    """Every line item numbered without gaps, and the surrogate id made of the number."""
    rows = dense_ids(_t(spark, d, "lineitem").select(*LINEITEM), LINEITEM, f"{new_run_dir(spark, 'dense')}/rows")
    return present(rows.select(*LINEITEM, "row_no", surrogate_id(T1, "row_no").alias("dl_id")))


def q_raw_quarantine(spark, d):
    """Raw lines, every third of them a field short or with one too many: rows
    that are read and lines that are kept aside, together the input."""
    k = F.col("o_orderkey")
    fields = [k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")]
    whole = F.concat_ws("\t", *fields)
    line = F.when(k % 9 == 0, F.concat_ws("\t", *fields[:3])).when(k % 9 == 3, F.concat(whole, F.lit("\tmore")))
    path = f"{new_run_dir(spark, 'raw')}/f_orders"
    _t(spark, d, "orders").select(F.coalesce(line, whole).alias("value")).write.option("lineSep", "\n").text(path)
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    good, rejected = split_raw(spark, path, names)
    good = good.select(F.lit("read").alias("reason"), F.lit(len(names)).alias("fields"),
                       F.concat_ws("\t", *names).alias("line"))
    return good.unionByName(rejected.select("reason", "fields", "line"))


def q_raw_escaped(spark, d):
    """Text with tabs, line ends and backslashes through the raw layer and back."""
    k = F.col("o_orderkey")
    odd = F.concat(F.lit("\\"), "o_orderstatus", F.when(k % 2 == 0, "\t").otherwise("\\t"), "o_orderpriority",
                   F.when(k % 3 == 0, "\n").otherwise("\\\\n"))
    rows = _t(spark, d, "orders").select(k.cast("string").alias("o_orderkey"), F.when(
        k % 5 == 0, F.lit("\\N")).when(k % 7 == 0, F.lit(None)).otherwise(odd).alias("note"))
    path = f"{new_run_dir(spark, 'raw')}/f_notes"
    write_raw(rows, path, escaped=True)
    return read_raw(spark, path, ["o_orderkey", "note"], escaped=True)


def q_tables_drop_status(spark, d):
    """All closed versions and one day of the current slice dropped: what stays."""
    rd, db = _fresh_db(spark, "q-drop")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    for ts, src in ((T1, orders_old), (T2, orders_new), (T3, orders_third)):
        upsert(spark, spec, ts, arrivals=src(spark, d), ori_id="o_orderkey")
    drop_partitions(spark, spec.m_table, dl_status="H")
    drop_partitions(spark, spec.m_table, dl_status="A", day=slot_of(T1, "month"))
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_rotate_slot(spark, d):
    """The ODS copy's slot of the first load emptied before the month comes round."""
    rd, db = _fresh_db(spark, "q-rotate")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    for ts, src in ((T1, orders_old), (T2, orders_new)):
        upsert(spark, spec, ts, arrivals=src(spark, d), ori_id="o_orderkey")
    rotate_slot(spark, spec.ff_table, slot_of(T1, "month"))
    return present(spark.table(spec.ff_table).select(*ORDERS, "dl_loaded_dt", "day"))


COMPACTED = ((T1, orders_old, SQL_ORDERS_OLD), (T2, orders_third, SQL_ORDERS_THIRD), (T3, orders_new, SQL_ORDERS_NEW),
             (T3_LATER, orders_third, SQL_ORDERS_THIRD))


def q_tables_compact(spark, d):
    """Four loads, two into one slot; then the small files of closed slots are joined."""
    rd, db = _fresh_db(spark, "q-compact")
    spec = orders_spec(db)
    create_layers(spark, spec, rd)
    for ts, src, _ in COMPACTED:
        upsert(spark, spec, ts, arrivals=src(spark, d), ori_id="o_orderkey")
    compact(spark, spec, statuses=("H", "A"))
    return present(spark.table(spec.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_schema_change(spark, d):
    """T1 without the priority and with narrow customer numbers; from T2 on the
    priority is there.  Orders whose other columns stay keep their version."""
    rd, db = _fresh_db(spark, "q-evolve")
    new = orders_spec(db)
    narrow = tuple((c, "int" if c == "o_custkey" else t) for c, t in new.columns if c != "o_orderpriority")
    old = new.with_(columns=narrow)
    create_layers(spark, old, rd)
    upsert(spark, old, T1, arrivals=orders_old(spark, d), ori_id="o_orderkey")
    evolve(spark, old, new, T2)
    rebuild_and_repair(spark, new, T2, snapshot=orders_new(spark, d), ori_id="o_orderkey")
    repair(spark, new, T3, ori_id="o_orderkey")   # the same snapshot again: nothing changes
    return present(spark.table(new.m_table).select("dl_id", *ORDERS, *M_TAIL))


def q_tables_ods_dedup_days(spark, d):
    """The deduplication of ``tables_ods_dedup``, day by day."""
    spec = _ff_loaded_table(spark, d, "q-dedup-days")
    ods_dedup_days(spark, spec)
    return present(spark.table(spec.ff_table).select(*ORDERS, "dl_loaded_dt", "day"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "as_of_join": q_as_of_join,
    "coalesce_history": q_coalesce_history,
    "tables_upsert_late": q_tables_upsert_late,
    "tables_repair_digest": q_tables_repair_digest,
    "tables_upsert_indexed": q_tables_upsert_indexed,
    "dense_ids": q_dense_ids,
    "raw_quarantine": q_raw_quarantine,
    "raw_escaped": q_raw_escaped,
    "tables_drop_status": q_tables_drop_status,
    "tables_rotate_slot": q_tables_rotate_slot,
    "tables_compact": q_tables_compact,
    "tables_schema_change": q_tables_schema_change,
    "tables_ods_dedup_days": q_tables_ods_dedup_days,
}


def _as_of_join_sql() -> str:
    at = f"(ts - INTERVAL {LOOK_BACK_HOURS} HOUR)"
    names = ["dl_id", "event_id", "event_type", "value"]
    return (_backfill_cte() + f"SELECT e.event_id, e.user_id, {_fmt('e.at')} AS at, "
            + ", ".join(f"r.{c} AS v_{c}" for c in names) + ", "
            + ", ".join(f"{_fmt('r.' + c)} AS v_{c}" for c in ("dl_start_dt", "dl_end_dt"))
            + f", r.dl_status AS v_dl_status FROM (SELECT *, {at} AS at FROM events) e LEFT JOIN r "
            "ON r.user_id = e.user_id AND r.dl_start_dt <= e.at AND e.at < r.dl_end_dt")


def _coalesce_sql() -> str:
    same = " AND ".join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c}" for c in ORDERS if c != "o_orderkey")
    head = ", ".join(f"arg_min({c}, dl_start_dt) AS {c}" for c in ["dl_id", *ORDERS[1:]])
    tail = ", ".join(f"arg_max({c}, dl_start_dt) AS {c}" for c in ["dl_loaded_dt", "dl_end_dt", "dl_status", "day"])
    return (_two_batches_sql()
            + f", marked AS (SELECT *, CASE WHEN lag(dl_end_dt) OVER w = dl_start_dt AND {same} THEN 0 ELSE 1 END "
            "AS fresh FROM m3 WINDOW w AS (PARTITION BY o_orderkey ORDER BY dl_start_dt)), "
            "islands AS (SELECT *, sum(fresh) OVER (PARTITION BY o_orderkey ORDER BY dl_start_dt) AS island FROM marked), "
            f"r AS (SELECT o_orderkey, {head}, min(dl_start_dt) AS dl_start_dt, {tail}, count(*) AS versions "
            "FROM islands GROUP BY o_orderkey, island) "
            + _m_select("r", ORDERS).replace(" FROM r", ", versions FROM r"))


def _batches_sql(batches) -> str:
    """Upserts one after the other; ``m`` is the table after them all."""
    first, (ts, _, src) = [], batches[0]
    first.append(f"a0 AS ({_open_sql(src, ORDERS, 'o_orderkey', ts, slot_of(ts, 'month'))})")
    for i, (ts, _, src) in enumerate(batches[1:], 1):
        first.append(f"m{i} AS ({_upsert_sql(f'a{i - 1}', src, ORDERS, 'o_orderkey', ts, ['o_custkey'])})")
        first.append(f"a{i} AS (SELECT * FROM m{i} WHERE dl_status = 'A')")
    closed = " UNION ALL ".join(f"SELECT * FROM m{i} WHERE dl_status = 'H'" for i in range(1, len(batches)))
    return f"WITH {', '.join(first)}, m AS (SELECT * FROM a{len(batches) - 1} UNION ALL {closed}) "


def _schema_change_sql() -> str:
    old = [c for c in ORDERS if c != "o_orderpriority"]
    bare = f"(SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM {SQL_ORDERS_OLD})"
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM a.{c}" for c in old)
    s1, s2 = slot_of(T1, "month"), slot_of(T2, "month")
    fresh = f"(SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM a WHERE {same}) AND o_custkey IS NOT NULL)"
    return (f"WITH a AS ({_open_sql(bare, ORDERS, 'o_orderkey', T1, s1)}), n AS (SELECT * FROM {SQL_ORDERS_NEW}), "
            f"r AS (SELECT * FROM a WHERE EXISTS (SELECT 1 FROM n WHERE {same}) UNION ALL "
            + _close_sql("a", ORDERS, T2, "H", s2, f"WHERE NOT EXISTS (SELECT 1 FROM n WHERE {same})")
            + " UNION ALL " + _open_sql(fresh, ORDERS, "o_orderkey", T2, s2) + ") " + _m_select("r", ORDERS))


def oracle_sql() -> dict[str, str]:
    return {
        "tables_compact": _batches_sql(COMPACTED) + _m_select("m", ORDERS),
        "tables_schema_change": _schema_change_sql(),
        "tables_ods_dedup_days": (
            _ff_two_loads_sql() + f"SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, {_fmt('max(dl_loaded_dt)')} AS "
            "dl_loaded_dt, arg_max(day, dl_loaded_dt) AS day FROM u GROUP BY ALL"),
        "as_of_join": _as_of_join_sql(),
        "coalesce_history": _coalesce_sql(),
        "tables_upsert_late": _two_batches_sql() + _m_select("m3", ORDERS),
        "tables_repair_digest": _repair_sql() + _m_select("r", ORDERS),
        "tables_upsert_indexed": _two_batches_sql() + _m_select("m3", ORDERS),
        "dense_ids": (
            f"WITH n AS (SELECT *, row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in LINEITEM)}) - 1 "
            f"AS row_no FROM lineitem) SELECT {_cols(LINEITEM, fmt_ts=('l_shipdate',))}, row_no, "
            f"{_id_sql(T1, 'row_no')} AS dl_id FROM n"),
        "raw_quarantine": (
            "WITH o AS (SELECT o_orderkey AS k, concat_ws(chr(9), o_orderkey, o_custkey, o_orderstatus) AS short, "
            "concat_ws(chr(9), o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS line FROM orders) "
            "SELECT CASE WHEN k % 9 = 0 THEN 'missing fields' WHEN k % 9 = 3 THEN 'surplus fields' ELSE 'read' END "
            "AS reason, CAST(CASE WHEN k % 9 = 0 THEN 3 WHEN k % 9 = 3 THEN 5 ELSE 4 END AS INTEGER) AS fields, "
            "CASE WHEN k % 9 = 0 THEN short WHEN k % 9 = 3 THEN line || chr(9) || 'more' ELSE line END AS line FROM o"),
        "raw_escaped": (
            "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN chr(92) || 'N' "
            "WHEN o_orderkey % 7 = 0 THEN NULL ELSE chr(92) || o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN chr(9) "
            "ELSE chr(92) || 't' END || o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) "
            "ELSE chr(92) || chr(92) || 'n' END END AS note FROM orders"),
        "tables_drop_status": (_two_batches_sql() + _m_select("m3", ORDERS)
                               + f" WHERE dl_status = 'A' AND day <> {slot_of(T1, 'month')}"),
        "tables_rotate_slot": (f"SELECT {_cols(ORDERS, fmt_ts=ORDERS_TS)}, '{T2}' AS dl_loaded_dt, "
                               f"CAST({slot_of(T2, 'month')} AS INTEGER) AS day FROM {SQL_ORDERS_NEW} s"),
    }


__all__ = ["QUERIES", "oracle_sql"]
