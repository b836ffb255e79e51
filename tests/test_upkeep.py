"""Compaction, columns that change, and the day-wise deduplication."""

from __future__ import annotations

import os
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F
from test_resume import contents, kill_at

from histlake.plans import TableSpec, column_versions, compact, evolve, ods_dedup, ods_dedup_days, repair, upsert
from histlake.plans.compaction import pack
from histlake.plans.registry import T1, T2, T3, T3_LATER, orders_new, orders_old, orders_spec, orders_third
from histlake.sources import append_by_name, create_layers, partitions
from histlake.sources.publish import _names
from histlake.sources.tables import partition_location, write_stage_table
from histlake.operators import stamp_load


def test_packing_fills_bins():
    rng = random.Random(1)
    files = [(f"f{i}", rng.randint(1, 70)) for i in range(300)]
    size = dict(files)
    bins = pack(files, 100)
    names = [n for b in bins for n in b]
    assert len(names) == len(set(names)) and all(len(b) > 1 and sum(size[n] for n in b) <= 100 for b in bins)
    assert all(size[n] <= 50 for n in names)
    small = [n for n, s in files if s <= 50]
    assert len(small) - len(names) <= 1 and len(bins) <= sum(size[n] for n in names) / 100 * 1.25
    assert pack([("a", 10)], 100) == pack([], 100) == pack([("a", 60), ("b", 60)], 100) == []


def files_of(spark, spec):
    return {(p["dl_status"], p["day"]): [n for n in _names(spark, partition_location(spark, spec.m_table, p))
                                         if n.startswith("part-")] for p in partitions(spark, spec.m_table)}


def loaded(spark, spec, root):
    create_layers(spark, spec, root)
    for ts, src in ((T1, orders_old), (T2, orders_third), (T3, orders_new), (T3_LATER, orders_third)):
        upsert(spark, spec, ts, arrivals=src(spark, SF001), ori_id="o_orderkey")


@pytest.mark.parametrize("buckets", [None, 4])
def test_compaction_joins_files_and_keeps_rows(spark, run_dir, fresh_db, buckets):
    spec = orders_spec(fresh_db, buckets=buckets)
    loaded(spark, spec, run_dir)
    before, rows = files_of(spark, spec), contents(spark, spec)
    assert len(before["H", "27"]) > (buckets or 1)
    res = compact(spark, spec)
    after = files_of(spark, spec)
    assert contents(spark, spec) == rows and res.counts["joined_files"] > res.counts["new_files"] > 0
    assert all(len(names) == (buckets or 1) for p, names in after.items() if p[0] == "H")
    assert all(after[p] == before[p] for p in before if p[0] == "A")
    assert compact(spark, spec).counts == {"joined_files": 0, "new_files": 0}
    # a target that holds no two files leaves all as they are
    assert compact(spark, spec, target_bytes=10, statuses=("A", "H")).counts["joined_files"] == 0
    upsert(spark, spec, "2022-04-28 10:11:12", arrivals=orders_old(spark, SF001), ori_id="o_orderkey")
    assert spark.table(spec.m_table).where("dl_status = 'A'").groupBy("o_orderkey").count().where("count > 1").isEmpty()


def test_compaction_does_not_sort_a_bin(spark, run_dir, fresh_db, monkeypatch):
    """A sort of a bin by partition would hold its rows, many times the file, in one task."""
    from histlake.plans import compaction
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    for ts, src in ((T1, orders_old), (T2, orders_new), (T3, orders_old), (T3_LATER, orders_new)):
        upsert(spark, spec, ts, arrivals=src(spark, SF001), ori_id="o_orderkey")
    plans = []

    def write(df, like, path):
        df.createOrReplaceTempView("bins")
        plans.append(df.sparkSession.sql(f"EXPLAIN INSERT INTO {like} SELECT * FROM bins").first()[0])
        return write_stage_table(df, like, path)

    monkeypatch.setattr(compaction, "write_stage_table", write)
    assert compact(spark, spec).counts["new_files"] > 0
    assert len(plans) == 1 and "InsertInto" in plans[0] and "Sort" not in plans[0], plans


def test_compaction_can_die_at_any_action(spark, run_dir, fresh_db, monkeypatch):
    spec = orders_spec(fresh_db)
    loaded(spark, spec, run_dir)
    rows = contents(spark, spec)
    for k in range(1, 50):
        with monkeypatch.context() as m:
            seen = kill_at(m, k)
            try:
                compact(spark, spec)
            except RuntimeError:
                pass
        if seen["n"] < k:
            break
        compact(spark, spec)
        assert contents(spark, spec) == rows, f"killed at action {k}"
        upsert(spark, spec, f"2022-05-27 10:{10 + k}:12", arrivals=orders_third(spark, SF001).limit(50 + k),
               ori_id="o_orderkey")   # a file more in the slot of the 27th
        rows = contents(spark, spec)
    assert k > 3


ITEMS = (("k", "bigint"), ("v", "varchar(9)"), ("n", "int"), ("x", "float"))


def test_columns_change_between_loads(spark, run_dir, fresh_db):
    old = TableSpec(name="items", database=fresh_db, keys=("k",), columns=ITEMS)
    new = old.with_(columns=(("k", "bigint"), ("v", "varchar(9)"), ("extra", "varchar(9)"), ("n", "bigint"),
                             ("x", "double")))
    create_layers(spark, old, run_dir)
    upsert(spark, old, T1, arrivals=spark.createDataFrame(
        [(1, "a", 1, 1.1), (2, "b", 2, 0.5), (3, "c", None, None), (4, "d", 4, 4.0)], "k long, v string, n int, x float"),
        ori_id="k")
    assert len(column_versions(spark, old)) == 1
    evolve(spark, old, new, T2)
    assert len(column_versions(spark, new)) == 2
    first = spark.table(new.m_table).orderBy("k").select("k", "v", "extra", "n", "x").collect()
    assert [tuple(r)[:4] for r in first] == [(1, "a", None, 1), (2, "b", None, 2), (3, "c", None, None), (4, "d", None, 4)]
    shape = "k long, v string, extra string, n long, x double"

    def load(ts, rows):
        spark.sql(f"ALTER TABLE {new.ff_table} DROP IF EXISTS PARTITION (day={int(ts[8:10])})")
        for p in partitions(spark, new.ff_table):
            spark.sql(f"ALTER TABLE {new.ff_table} DROP IF EXISTS PARTITION (day={p['day']})")
        append_by_name(stamp_load(spark.createDataFrame(rows, shape), ts), new.ff_table)
        spark.catalog.refreshTable(new.ff_table)
        repair(spark, new, ts, ori_id="k")
        return {(r.k, r.extra, r.n, r.x and round(r.x, 6)): (str(r.dl_start_dt), r.dl_status)
                for r in spark.table(new.m_table).collect()}

    big = 3_000_000_000
    got = load(T2, [(1, "a", "new", 1, 1.1), (2, "b", "new", big, 0.5), (3, "c", "new", None, None),
                    (5, "e", "new", 5, 5.0)])
    assert got[1, None, 1, 1.1] == (T1, "A")          # its own columns are as they were
    assert got[3, None, None, None] == (T1, "A")
    assert got[2, "new", big, 0.5] == (T2, "A") and got[2, None, 2, 0.5] == (T1, "H")
    assert got[4, None, 4, 4.0] == (T1, "H") and got[5, "new", 5, 5.0] == (T2, "A")
    # versions of the new columns are compared by all of them
    got = load(T3, [(1, "a", "newer", 1, 1.1), (2, "b", "newer", big, 0.5), (3, "c", "new", None, 0.25),
                    (5, "e", "new", 5, 5.0)])
    assert got[1, None, 1, 1.1] == (T1, "A") and got[5, "new", 5, 5.0] == (T2, "A")
    assert got[2, "newer", big, 0.5] == (T3, "A") and got[2, "new", big, 0.5] == (T2, "H")
    assert got[3, "new", None, 0.25] == (T3, "A") and got[3, None, None, None] == (T1, "H")
    evolve(spark, new, new, T3)                                      # nothing to do
    assert len(column_versions(spark, new)) == 2


def test_columns_that_cannot_change(spark, run_dir, fresh_db):
    old = TableSpec(name="items", database=fresh_db, keys=("k",), columns=ITEMS)
    create_layers(spark, old, run_dir)
    for cols in (ITEMS[:3], (*ITEMS[:2], ("n", "varchar(3)"), ITEMS[3]), (("k", "int"), *ITEMS[1:])):
        with pytest.raises(ValueError):
            evolve(spark, old, old.with_(columns=cols), T2)
    with pytest.raises(ValueError):
        evolve(spark, old, old.with_(buckets=4), T2)


def test_change_of_columns_can_be_made_again(spark, run_dir, fresh_db, monkeypatch):
    import histlake.plans.evolution as E
    old = TableSpec(name="items", database=fresh_db, keys=("k",), columns=ITEMS)
    new = old.with_(columns=(*ITEMS, ("extra", "int")))
    create_layers(spark, old, run_dir)
    upsert(spark, old, T1, arrivals=spark.createDataFrame([(1, "a", 1, 1.0)], "k long, v string, n int, x float"), ori_id="k")
    for broken in ("create_layers", "_add_partitions", "_write"):
        with monkeypatch.context() as m:
            if broken == "_write":
                real = E._write
                m.setattr(E, "_write", lambda s, p, t: real(s, p, t) if p.endswith(".note") else 1 / 0)
            else:
                m.setattr(E, broken, lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                evolve(spark, old, new, T2)
    evolve(spark, old, new, T2)
    assert [(r.k, r.extra) for r in spark.table(new.m_table).collect()] == [(1, None)]
    assert spark.table(new.ff_table).count() == 1 and len(column_versions(spark, new)) == 2


def test_dedup_by_days_equals_the_whole_and_leaves_other_days(spark, run_dir, fresh_db):
    spec = TableSpec(name="items", database=fresh_db, keys=("k",), columns=(("k", "bigint"), ("v", "varchar(9)")))
    plain = spec.with_(database=fresh_db + "_p")
    df = lambda rows: spark.createDataFrame(rows, "k long, v string")
    days = [("2022-04-01 00:00:00", [(1, "a"), (2, "b"), (2, "b"), (None, None)]),
            ("2022-04-02 00:00:00", [(3, "c"), (4, "d")]),
            ("2022-04-03 00:00:00", [(1, "a"), (5, "e"), (2, "other")]),
            ("2022-04-04 00:00:00", [(6, "f")] * 3 + [(None, None)])]
    for s, name in ((spec, "d"), (plain, "p")):
        create_layers(spark, s, f"{run_dir}/{name}")
        for ts, rows in days:
            append_by_name(stamp_load(df(rows), ts), s.ff_table)
    files = lambda: {p["day"]: set(_names(spark, partition_location(spark, spec.ff_table, p)))
                     for p in partitions(spark, spec.ff_table)}
    whole = lambda s: sorted((tuple(r) for r in spark.table(s.ff_table).collect()), key=str)
    before = files()
    res = ods_dedup_days(spark, spec)
    ods_dedup(spark, plain, ["dl_loaded_dt"], by="row")
    assert whole(spec) == whole(plain)
    assert res.counts == {"indexed_days": [1, 2, 3, 4], "rewritten_days": [1, 4]}
    assert all(files()[d] == before[d] for d in ("2", "3"))
    # a further day that repeats one row of the second: only these are read
    for s in (spec, plain):
        append_by_name(stamp_load(df([(4, "d"), (9, "z")]), "2022-04-05 00:00:00"), s.ff_table)
    saved = {}
    for day in ("1", "3", "4"):
        p = next(p for p in partitions(spark, spec.ff_table) if p["day"] == day)
        folder = partition_location(spark, spec.ff_table, p).removeprefix("file:")
        for name in os.listdir(folder):
            if name.startswith("part-") and day == "3":
                with open(f"{folder}/{name}", "rb") as fh:
                    saved[f"{folder}/{name}"] = fh.read()
                with open(f"{folder}/{name}", "wb") as fh:
                    fh.write(b"not parquet")
    res = ods_dedup_days(spark, spec)
    for path, data in saved.items():
        with open(path, "wb") as fh:
            fh.write(data)
    spark.catalog.refreshTable(spec.ff_table)
    ods_dedup(spark, plain, ["dl_loaded_dt"], by="row")
    assert saved and whole(spec) == whole(plain)
    assert res.counts == {"indexed_days": [1, 4, 5], "rewritten_days": [2]}    # 1 and 4 were written anew
    assert ods_dedup_days(spark, spec).counts == {"indexed_days": [2], "rewritten_days": []}


def test_dedup_by_days_can_die_at_any_action(spark, run_dir, fresh_db, monkeypatch):
    def run(k):
        spec = orders_spec(f"{fresh_db}_{k}")
        create_layers(spark, spec, f"{run_dir}/{k}")
        append_by_name(stamp_load(orders_old(spark, SF001), T1), spec.ff_table)
        append_by_name(stamp_load(orders_new(spark, SF001), T2), spec.ff_table)
        with monkeypatch.context() as m:
            seen = kill_at(m, k)
            if k:
                with pytest.raises(RuntimeError):
                    ods_dedup_days(spark, spec)
            else:
                ods_dedup_days(spark, spec)
        if k:
            ods_dedup_days(spark, spec)
        return contents(spark, spec), seen["n"]

    clean, actions = run(0)
    assert spark.table(f"{fresh_db}_0.ff_orders").where(F.col("o_orderkey") % 3 == 0).count() > 0
    for k in range(1, actions + 1):
        assert run(k)[0] == clean, f"killed at action {k} of {actions}"
