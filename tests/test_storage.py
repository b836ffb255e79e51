"""Key index, dense ids, quarantine of raw lines, retention in the bucket layout."""

from __future__ import annotations

import os
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F
from test_plans import plan

from histlake.functions.ids import dense_ids, surrogate_id
from histlake.operators.keyindex import blocks_for, build_filter, hit_parts, key_range
from histlake.plans import TableSpec, loads, retain, upsert
from histlake.plans.registry import T1, T2, T3, orders_new, orders_old, orders_spec, orders_third
from histlake.plans.loads import read_source
from histlake.session import new_run_dir
from histlake.sources import create_layers, partitions, read_raw, split_raw, write_raw
from histlake.sources.keyindex import indexed_days
from histlake.sources.publish import _names
from histlake.sources.tables import partition_location, table_location


def test_filter_misses_no_key_and_seldom_errs(spark):
    rows = spark.range(40_000).select((F.col("id") * 7).alias("a"), F.concat(F.lit("k"), F.col("id") % 5).alias("b"))
    keys = ["a", "b"]
    filters, ranges = None, None
    for part in (1, 2):
        own = rows.where(F.col("a") % 2 == part - 1)
        blocks = blocks_for(own.count())
        f = build_filter(own, keys, blocks).withColumn("part", F.lit(part))
        r = key_range(own, keys).withColumns({"blocks": F.lit(blocks), "part": F.lit(part)})
        filters, ranges = (f, r) if filters is None else (filters.unionByName(f), ranges.unionByName(r))
    assert blocks_for(20_000) > 1
    hits = lambda df: sorted(r["part"] for r in hit_parts(filters, ranges, df, keys).collect())
    for a in (0, 14, 279_986):   # even a in part 1
        assert hits(rows.where(F.col("a") == a)) == [1]
    assert hits(rows.where("a in (0, 7)")) == [1, 2]
    absent = spark.range(40_000).select((F.col("id") * 7 + 1).alias("a"), F.lit("k1").alias("b"))
    wrong = sum(len(hits(absent.where(F.col("a") == 7 * i + 1))) for i in range(30))
    assert wrong <= 2
    outside = rows.select((F.col("a") + 1_000_000).alias("a"), "b")
    assert hits(outside) == []
    assert "NestedLoop" not in plan(hit_parts(filters, ranges, rows, keys), "simple")


def test_days_without_a_hit_are_not_read(spark, run_dir, fresh_db, monkeypatch):
    """Files of the other days cannot be opened while the load runs."""
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    o = orders_old(spark, SF001)
    upsert(spark, spec, T1, arrivals=o.where("o_orderkey % 2 = 0"), ori_id="o_orderkey", key_index=True)
    upsert(spark, spec, T2, arrivals=o.where("o_orderkey % 2 = 1"), ori_id="o_orderkey", key_index=True)
    assert set(indexed_days(spark, spec)) == {13, 20}
    arriving = o.where("o_orderkey % 2 = 1 and o_orderkey % 3 = 0")
    arriving = arriving.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    saved = {}
    for p in partitions(spark, spec.m_table):
        if p["dl_status"] == "A" and p["day"] == "13":
            folder = partition_location(spark, spec.m_table, p).removeprefix("file:")
            for name in os.listdir(folder):
                if name.startswith("part-"):
                    with open(f"{folder}/{name}", "rb") as fh:
                        saved[f"{folder}/{name}"] = fh.read()
                    with open(f"{folder}/{name}", "wb") as fh:
                        fh.write(b"not parquet")
    with monkeypatch.context() as m:  # the guard looks at the statistics in every file's footer
        m.setattr(loads, "_guard_batch_time", lambda *_: None)
        res = upsert(spark, spec, T3, arrivals=arriving, ori_id="o_orderkey", key_index=True)
    for path, data in saved.items():
        with open(path, "wb") as fh:
            fh.write(data)
    spark.catalog.refreshTable(spec.m_table)
    assert saved and res.counts["rewritten_days"] == 2           # 20 and today's 27
    assert res.counts["indexed_days"] == [20, 27]                # 13 keeps its index
    m = spark.table(spec.m_table)
    assert m.where("dl_status = 'A'").count() == o.count()
    assert m.where("dl_status = 'H'").count() == arriving.count()


def test_index_of_a_changed_partition_is_not_asked(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    for ts, src in ((T1, orders_old), (T2, orders_new)):
        upsert(spark, spec, ts, arrivals=src(spark, SF001), ori_id="o_orderkey")      # no index yet
    assert indexed_days(spark, spec) == {}
    upsert(spark, spec, T3, arrivals=orders_third(spark, SF001), ori_id="o_orderkey", key_index=True)
    assert set(indexed_days(spark, spec)) == {int(p["day"]) for p in partitions(spark, spec.m_table)
                                              if p["dl_status"] == "A"}
    upsert(spark, spec, "2022-05-27 10:11:12", arrivals=orders_third(spark, SF001).limit(5), ori_id="o_orderkey")
    assert 27 not in indexed_days(spark, spec)


def test_dense_ids_have_no_gaps(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "x", "y"]), rng.randrange(40)) for _ in range(3000)] + [("hot", 7)] * 2000
    df = spark.createDataFrame(rows, "a string, b int").repartition(9)
    got = dense_ids(df, ["a", "b"], f"{new_run_dir(spark, 'dense')}/r")
    text = plan(got, "simple")
    assert "Window" not in text and "SinglePartition" not in text
    have = sorted((r.row_no, r.a, r.b) for r in got.collect())
    assert [r[0] for r in have] == list(range(5000))
    assert [r[1:] for r in have] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    # many copies of one row lie in several tasks
    path = f"{new_run_dir(spark, 'dense')}/hot"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dense_ids(spark.range(20_000).select(F.lit(1).alias("a")).repartition(8), ["a"], path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    shares = [r["count"] for r in spark.read.parquet(path).groupBy("_task").count().collect()]
    assert len(shares) == 8 and max(shares) < 10_000
    assert dense_ids(df.limit(0), ["a"], f"{new_run_dir(spark, 'dense')}/none").count() == 0
    ids = got.select(surrogate_id(T1, "row_no").alias("i")).union(got.select(surrogate_id(T2, "row_no").alias("i")))
    assert ids.distinct().count() == 10_000


def test_quarantine_keeps_lines_with_their_place(spark, run_dir):
    """Positions are those of the bytes in the file, over several blocks."""
    os.makedirs(f"{run_dir}/f")
    rng = random.Random(2)
    want, good = [], []
    for name in ("a.txt", "b.txt", "clean.txt"):
        data = b""
        for i in range(2000):
            n = 3 if name == "clean.txt" else rng.choice([3, 3, 3, 2, 4, 1])
            line = "\t".join([f"{i}", "é" * rng.randint(0, 9), "x" * rng.randint(0, 40), "more"][:n])
            if n == 3:
                good.append(tuple(line.split("\t")))
            else:
                want.append((name, len(data), "missing fields" if n < 3 else "surplus fields", n, line))
            data += line.encode() + b"\n"
        with open(f"{run_dir}/f/{name}", "wb") as fh:
            fh.write(data)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        split = split_raw(spark, f"{run_dir}/f", ["a", "b", "c"])
        got = sorted((r.file.rsplit("/", 1)[1], r.position, r.reason, r.fields, r.line) for r in split.rejected.collect())
        assert got == sorted(want)
        assert sorted(tuple(r) for r in split.good.collect()) == sorted(good)
        for file, position, _, _, line in rng.sample(want, 20):
            with open(f"{run_dir}/f/{file}", "rb") as fh:
                fh.seek(position)
                assert fh.readline() == line.encode() + b"\n"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_load_writes_its_rejects(spark, run_dir, fresh_db):
    spec = TableSpec(name="items", database=fresh_db, keys=("k",), columns=(("k", "bigint"), ("v", "varchar(10)")))
    create_layers(spark, spec, run_dir)
    raw = table_location(spark, spec.f_table).removeprefix("file:")
    os.makedirs(raw, exist_ok=True)
    with open(f"{raw}/part-0.txt", "w") as fh:
        fh.write("1\ta\n2\n3\tc\td\n4\td\n")
    upsert(spark, spec, T1, arrivals=read_source(spark, spec, rejects=f"{run_dir}/rejects"))
    assert sorted(r.k for r in spark.table(spec.m_table).collect()) == [1, 4]
    kept = [(r.position, r.reason, r.line) for r in spark.read.parquet(f"{run_dir}/rejects").orderBy("position").collect()]
    assert kept == [(4, "missing fields", "2"), (6, "surplus fields", "3\tc\td")]


def test_raw_text_escapes_and_refusal(spark, run_dir):
    values = ["plain", "", None, "\\N", "a\tb", "line\nend\r\n", "\\", "\\\\t", "\\t", "\t\\\n", "end\\", "\\\\\\n", "日\té"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "i string, v string")
    write_raw(df, f"{run_dir}/e", escaped=True)
    got = {r.i: r.v for r in read_raw(spark, f"{run_dir}/e", ["i", "v"], escaped=True).collect()}
    assert got == {str(i): v for i, v in enumerate(values)}
    for bad in ("a\tb", "line\nend\r\n", "\\N"):
        with pytest.raises(Exception, match="column v"):
            write_raw(df.where(F.col("v") == bad), f"{run_dir}/bad")
    write_raw(df.where("i in ('0', '1', '2', '6')"), f"{run_dir}/p")
    assert {r.i: r.v for r in read_raw(spark, f"{run_dir}/p", ["i", "v"]).collect()} == {
        "0": "plain", "1": "", "2": None, "6": "\\"}


def test_retention_keeps_the_bucket_layout(spark, run_dir, fresh_db):
    """A slot that retention rewrites has one file a bucket at most."""
    spec = orders_spec(fresh_db, buckets=4)
    create_layers(spark, spec, run_dir)
    for ts, src in ((T1, orders_old), (T2, orders_new), (T3, orders_third)):
        upsert(spark, spec, ts, arrivals=src(spark, SF001), ori_id="o_orderkey")
    late = spark.table(spec.m_table).where("dl_status = 'H'")
    want = late.where(F.col("dl_end_dt") >= F.lit(T3).cast("timestamp_ntz")).count()
    # rows that stay share a slot with rows that go
    moved = late.where(F.col("dl_end_dt") < F.lit(T3).cast("timestamp_ntz")).withColumn("day", F.lit(27))
    moved.select(spark.table(spec.m_table).columns).write.insertInto(spec.m_table)
    retain(spark, spec, T3)
    left = [p for p in partitions(spark, spec.m_table) if p["dl_status"] == "H"]
    assert spark.table(spec.m_table).where("dl_status = 'H'").count() == want
    for p in left:
        files = [n for n in _names(spark, partition_location(spark, spec.m_table, p)) if n.startswith("part-")]
        assert 0 < len(files) <= 4, files
