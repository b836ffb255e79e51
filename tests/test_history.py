"""Joins with a history, its coalescing, late batches and repair by digest."""

from __future__ import annotations

import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F
from test_plans import plan
from test_resume import contents, kill_at

from histlake.functions import OPEN_END
from histlake.operators import as_of_join, coalesce_versions, differing_leaves, digest_tree, leaf_digests, open_rows
from histlake.operators.asof import TimeChunks
from histlake.operators.digest import bucket_number
from histlake.plans import TableSpec, loads, rebuild_and_repair, repair_by_digest, upsert, upsert_late
from histlake.plans.digests import _bucket_of, slice_digests
from histlake.plans.registry import T1, T2, T3, orders_new, orders_old, orders_spec, orders_third
from histlake.sources import create_layers, partitions
from histlake.sources.publish import _names
from histlake.sources.tables import partition_location

M = ("dl_id string, k bigint, v string, dl_loaded_dt timestamp_ntz, dl_start_dt timestamp_ntz, "
     "dl_end_dt timestamp_ntz, dl_status string, day int")


def at(n):
    """The n-th minute of a day as text."""
    return f"2022-04-{1 + n // 1440:02d} {n // 60 % 24:02d}:{n % 60:02d}:00"


def history(spark, rng, keys, n):
    """Versions of each key, some with gaps, some repeating their predecessor."""
    rows = []
    for k in keys:
        t = 0
        for i in range(n(k)):
            start, t = t + rng.choice([0, 0, 3]), t + rng.randint(4, 9)
            rows.append((f"{k}-{i:05d}", k, rng.choice("ab"), at(t), at(start), at(t), "H", 1))
    df = spark.createDataFrame(rows, M.replace("timestamp_ntz", "string"))
    times = [c for c in df.columns if c.endswith("_dt")]
    return rows, df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def test_as_of_join_by_definition_with_a_hot_key(spark):
    """Key 7 has over a third of all rows, and many points at one instant."""
    rng = random.Random(1)
    rows, h = history(spark, rng, range(12), lambda k: 400 if k == 7 else 20)
    points = [(i, rng.choice([7, 7, rng.randrange(14), None]), at(rng.randint(0, 2400))) for i in range(3000)]
    points += [(i, 7, at(600)) for i in range(3000, 4500)] + [(9000, 3, None), (9000, 3, None)]
    p = spark.createDataFrame(points, "i long, k bigint, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    p = p.repartition(6)
    want = sorted(((i, k, next((r[0] for r in rows if r[1] == k and t is not None and r[4] <= t < r[5]), None))
                   for i, k, t in points), key=str)
    joined = as_of_join(p, h, ["k"], "t", parts=16)
    got = sorted(((r.i, r.k, r.v_dl_id) for r in joined.collect()), key=str)
    assert got == want
    assert as_of_join(p, h, ["k"], "t", how="inner", parts=16).count() == sum(x[2] is not None for x in want)
    text = plan(joined, "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text
    chunks = TimeChunks(p.select("k", "t").where("k is not null"), ["k"], "t", 16)
    placed = p.where("k = 7").select(chunks.of_point(F.col("t"), F.xxhash64("i")).alias("c")).groupBy("c").count()
    per_chunk = [r["count"] for r in placed.collect()]
    assert len(per_chunk) > 8 and max(per_chunk) < 4 * sum(per_chunk) / len(per_chunk)


def test_as_of_join_takes_one_shuffle(spark):
    _, h = history(spark, random.Random(2), range(300), lambda k: 2)
    p = spark.range(3000).select("id", (F.col("id") % 300).alias("k"),
                                 F.lit(at(5)).cast("timestamp_ntz").alias("t"))
    joined = as_of_join(p, h, ["k"], "t")
    text = plan(joined, "simple")
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert as_of_join(p.limit(0), h, ["k"], "t").count() == 0
    none = as_of_join(p, h.limit(0), ["k"], "t")
    assert none.where("v_dl_id is null").count() == 3000 and as_of_join(p, h.limit(0), ["k"], "t", how="inner").count() == 0
    with pytest.raises(ValueError):
        as_of_join(p, h, ["k"], "t", how="outer")


def brute_islands(rows):
    out = []
    for r in sorted(rows, key=lambda r: (r[1], r[4])):
        last = out[-1] if out else None
        if last and last[1] == r[1] and last[2] == r[2] and last[4] == r[4]:
            out[-1] = [last[0], last[1], last[2], last[3], r[5], last[5] + 1]
        else:
            out.append([r[0], r[1], r[2], r[4], r[5], 1])
    return sorted(tuple(x) for x in out)


@pytest.mark.parametrize("parts", [4, 24])
def test_coalescing_by_definition(spark, parts):
    rows, h = history(spark, random.Random(3), range(9), lambda k: 500 if k == 4 else 30)
    # a stretch of equal versions that runs through several chunks of the hot key
    rows = [(*r[:2], "same", *r[3:]) if r[1] == 4 and 100 <= int(r[0][2:]) < 400 else r for r in rows]
    h = h.withColumn("v", F.when((F.col("k") == 4) & F.substring("dl_id", 3, 9).cast("int").between(100, 399), "same")
                     .otherwise(F.col("v")))
    got = coalesce_versions(h.repartition(5), ["k"], parts=parts)
    have = sorted((r.dl_id, r.k, r.v, str(r.dl_start_dt), str(r.dl_end_dt), r.versions) for r in got.collect())
    assert have == brute_islands(rows)
    assert [r[0] for r in got.select("dl_loaded_dt", "dl_end_dt").where("dl_loaded_dt <> dl_end_dt").collect()] == []
    assert coalesce_versions(h.limit(0), ["k"]).count() == 0


def test_coalescing_takes_one_shuffle(spark):
    _, h = history(spark, random.Random(4), range(200), lambda k: 3)
    text = plan(coalesce_versions(h, ["k"]), "simple")
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def _in_order(spark, spec, batches, **kw):
    for ts, df in batches:
        upsert(spark, spec, ts, arrivals=df, ori_id="o_orderkey", **kw)


def whole(spark, spec):
    return sorted(tuple(r) for r in spark.table(spec.m_table).collect())


@pytest.mark.parametrize("buckets", [None, 4])
def test_late_batch_equals_its_turn(spark, run_dir, fresh_db, buckets):
    """Every order of the two later batches, keys that repeat in the late one."""
    twice = orders_new(spark, SF001).unionByName(orders_new(spark, SF001).where("o_orderkey % 4 = 0"))
    batches = [(T1, orders_old(spark, SF001)), (T2, twice), (T3, orders_third(spark, SF001))]
    results = []
    for name, order in (("a", (0, 1, 2)), ("b", (0, 2, 1)), ("c", (2, 1, 0))):
        spec = orders_spec(f"{fresh_db}_{name}", buckets=buckets)
        create_layers(spark, spec, f"{run_dir}/{name}")
        for k, i in enumerate(order):
            late = any(j > i for j in order[:k])
            load = upsert_late if late else upsert
            load(spark, spec, batches[i][0], arrivals=batches[i][1], ori_id="o_orderkey", check_ids=False)
        results.append(whole(spark, spec))
        assert spark.table(spec.ff_table).count() == sum(df.count() for _, df in batches)
    assert results[0] == results[1] == results[2]


def test_late_batch_rewrites_only_touched_slots(spark, run_dir, fresh_db):
    spec = orders_spec(fresh_db)
    create_layers(spark, spec, run_dir)
    o = orders_old(spark, SF001)
    _in_order(spark, spec, [(T1, o.where("o_orderkey % 2 = 0")), (T2, o.where("o_orderkey % 2 = 1")),
                            (T3, o.where("o_orderkey % 4 = 0"))])
    files = lambda: {(p["dl_status"], p["day"]): set(_names(spark, partition_location(spark, spec.m_table, p)))
                     for p in partitions(spark, spec.m_table)}
    before = files()
    late = "2022-04-15 08:00:00"
    res = upsert_late(spark, spec, late, arrivals=o.where("o_orderkey % 2 = 1 and o_orderkey % 3 = 0"),
                      ori_id="o_orderkey")
    after = files()
    # these keys have no version on the 15th: theirs starts on the 20th
    assert res.counts["rewritten"] == 0
    assert all(before[p] <= after[p] for p in before) and set(after) - set(before) <= {("H", "20"), ("A", "15")}
    res = upsert_late(spark, spec, "2022-04-22 08:00:00", arrivals=o.where("o_orderkey % 4 = 2 and o_orderkey % 3 = 0"),
                      ori_id="o_orderkey")
    assert res.counts["rewritten"] == 1                     # (A, 13): where those keys stand
    same = [p for p in after if p != ("A", "13")]
    assert all(after[p] <= files()[p] for p in same) and not after["A", "13"] & files()["A", "13"]
    assert upsert_late(spark, spec, late, arrivals=o).counts["resumed"]
    with pytest.raises(ValueError):
        upsert_late(spark, spec, "2022-04-20 10:11:40", arrivals=o)


def test_late_batch_can_die_at_any_action(spark, run_dir, fresh_db, monkeypatch):
    def run(k):
        spec = orders_spec(f"{fresh_db}_{k}")
        create_layers(spark, spec, f"{run_dir}/{k}")
        _in_order(spark, spec, [(T1, orders_old(spark, SF001)), (T3, orders_third(spark, SF001))])
        last = lambda: upsert_late(spark, spec, T2, arrivals=orders_new(spark, SF001), ori_id="o_orderkey")
        with monkeypatch.context() as m:
            seen = kill_at(m, k)
            if k:
                with pytest.raises(RuntimeError):
                    last()
            else:
                last()
        if k:
            last()
        return contents(spark, spec), seen["n"]

    clean, actions = run(0)
    for k in range(1, actions + 1):
        assert run(k)[0] == clean, f"killed at action {k} of {actions}"


def test_digest_tree_finds_what_differs(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    rows = rows.unionByName(rows.where("k % 50 = 0"))
    tree = lambda df: digest_tree(leaf_digests(df, ["k"], ["k", "v"], 100), 100)
    assert differing_leaves(tree(rows), tree(rows.repartition(9, "v"))) == []
    changed = rows.withColumn("v", F.when(F.col("k") == 77, "new").otherwise(F.col("v"))).where("k <> 4000").unionByName(
        spark.createDataFrame([(9999, "x"), (50, "1")], "k bigint, v string"))
    want = sorted({r[0] for r in spark.createDataFrame([(77,), (4000,), (9999,), (50,)], "k bigint").select(
        bucket_number(["k"], 100)).collect()})
    assert differing_leaves(tree(rows), tree(changed)) == want
    assert differing_leaves(tree(rows.limit(0)), tree(rows.where("k = 3"))) == differing_leaves(
        tree(rows.where("k = 3")), tree(rows.limit(0))) != []
    assert differing_leaves(tree(rows.limit(0)), tree(rows.limit(0))) == []


SMALL = TableSpec(name="items", database="x", keys=("k",), columns=(("k", "bigint"), ("v", "varchar(10)")), buckets=16)


def items(spark, change=()):
    df = spark.range(2000).select(F.col("id").alias("k"), F.lit("same").alias("v"))
    return df.withColumn("v", F.when(F.col("k").isin(list(change)), "changed").otherwise(F.col("v"))) if change else df


def slice_files(spark, spec):
    return {f"{loc}/{n}" for p in partitions(spark, spec.m_table) if p["dl_status"] == "A"
            for loc in [partition_location(spark, spec.m_table, p)] for n in _names(spark, loc) if n.startswith("part-")}


def local(path):
    return path.removeprefix("file:")


def test_repair_by_digest_reads_and_writes_differing_buckets_only(spark, run_dir, fresh_db, monkeypatch):
    from dataclasses import replace
    spec, plain = replace(SMALL, database=fresh_db), replace(SMALL, database=fresh_db + "_p")
    for s, name in ((spec, "d"), (plain, "p")):
        create_layers(spark, s, f"{run_dir}/{name}")
        upsert(spark, s, T1, arrivals=items(spark), ori_id="k")
    first = rebuild_and_repair(spark, spec, T2, snapshot=items(spark), method=repair_by_digest, ori_id="k")
    assert first.counts["buckets"] == 0 and not first.counts["kept_digests"]
    before = slice_files(spark, spec)
    changed = spark.createDataFrame([(5,), (123,)], "k bigint").select(bucket_number(["k"], 16)).collect()
    differing = {r[0] for r in changed}
    # files of the other buckets cannot even be opened meanwhile
    saved = {}
    for path in before:
        if _bucket_of(path) not in differing:
            with open(local(path), "rb") as fh:
                saved[path] = fh.read()
            with open(local(path), "wb") as fh:
                fh.write(b"not parquet" * (len(saved[path]) // 11))
    with monkeypatch.context() as m:  # the guard looks at the statistics in every file's footer
        m.setattr(loads, "_guard_batch_time", lambda *_: None)
        second = rebuild_and_repair(spark, spec, T3, snapshot=items(spark, (5, 123)), method=repair_by_digest,
                                    ori_id="k")
    for path, data in saved.items():
        with open(local(path), "wb") as fh:
            fh.write(data)
    spark.catalog.refreshTable(spec.m_table)
    assert second.counts["buckets"] == len(differing) and second.counts["kept_digests"]
    after = slice_files(spark, spec)
    assert set(saved) <= after and {_bucket_of(f) for f in after - before} == differing
    assert {_bucket_of(f) for f in before - after} == differing
    rebuild_and_repair(spark, plain, T2, snapshot=items(spark), ori_id="k")
    rebuild_and_repair(spark, plain, T3, snapshot=items(spark, (5, 123)), ori_id="k")
    assert whole(spark, spec) == whole(spark, plain)
    # the kept digests are those of the slice; another load makes them stale
    kept, fresh = slice_digests(spark, spec)
    now = leaf_digests(spark.table(spec.m_table).where("dl_status = 'A'"), spec.keys, spec.column_names, 16)
    assert fresh and sorted(map(tuple, kept.collect())) == sorted(map(tuple, now.collect()))
    upsert(spark, spec, "2022-04-28 10:11:12", arrivals=items(spark).where("k < 10"), ori_id="k")
    assert not slice_digests(spark, spec)[1]


def test_repair_by_digest_can_die_at_any_action(spark, run_dir, fresh_db, monkeypatch):
    from dataclasses import replace

    def run(k):
        spec = replace(SMALL, database=f"{fresh_db}_{k}", buckets=4)
        create_layers(spark, spec, f"{run_dir}/{k}")
        upsert(spark, spec, T1, arrivals=items(spark).where("k < 100"), ori_id="k")
        rebuild_and_repair(spark, spec, T2, snapshot=items(spark).where("k < 100"), method=repair_by_digest, ori_id="k")
        last = lambda: rebuild_and_repair(spark, spec, T3, snapshot=items(spark, (5,)).where("k < 101"),
                                          method=repair_by_digest, ori_id="k")
        with monkeypatch.context() as m:
            seen = kill_at(m, k)
            if k:
                with pytest.raises(RuntimeError):
                    last()
            else:
                last()
        if k:
            last()
            now = leaf_digests(spark.table(spec.m_table).where("dl_status = 'A'"), spec.keys, spec.column_names, 4)
            kept, _ = slice_digests(spark, spec)
            assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, now.collect()))
        return contents(spark, spec), seen["n"]

    clean, actions = run(0)
    for k in range(1, actions + 1):
        assert run(k)[0] == clean, f"killed at action {k} of {actions}"


def test_open_end_stays_open(spark):
    """A current version carries to any later point."""
    a = open_rows(spark.createDataFrame([(1, "x")], "k bigint, v string"), T1, ori_id="k")
    p = spark.createDataFrame([(1, "9998-01-01 00:00:00"), (1, OPEN_END)], "k bigint, t string")
    got = as_of_join(p, a, ["k"], "t").orderBy("t").collect()
    assert [r.v_v for r in got] == ["x", None]
