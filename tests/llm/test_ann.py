"""One-bit codes against exact search (also registered as SQL)."""

from __future__ import annotations

import duckdb
import numpy as np
from conftest import SF01, SF001
from llm_fixtures import stage  # noqa: F401
from pyspark.sql import functions as F

from histlake.llm import ann as A
from histlake.llm.queries import OP2_SQL, queries


def test_estimate_and_bound():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    q = rng.standard_normal(64)
    centre, turn = x.mean(axis=0), A.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, f, norm = A.encode(x, centre, turn)
    code = (np.unpackbits(bits, axis=1) * 2.0 - 1) / 8
    qo = q - centre
    qt = qo / np.linalg.norm(qo) @ turn
    true = ((x - centre) @ qo) / norm / np.linalg.norm(qo)
    error = (code @ qt) / f - true
    assert abs(error.mean()) < 0.01
    assert (np.abs(error) <= A.EPS * np.sqrt(1 - f * f) / f / np.sqrt(63)).mean() > 0.999


def recall(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = con.execute(OP2_SQL).fetchall()
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in queries()["op2_nearest"](spark, sf).collect()]
    assert len(got) == len(want)
    exact = {(a, c): d for a, _, c, d in want}
    for a, _, c, d in got:
        if (a, c) in exact:
            assert abs(exact[a, c] - d) < 1e-9
    return sum((a, c) in exact for a, _, c, _ in got) / len(want)


def test_recall(spark):
    assert recall(spark, SF001) >= 0.99
    assert recall(spark, SF01) >= 0.99


def test_edge_cases(spark, stage):  # noqa: F811
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, float(i % 7), float(i % 3)]) for i in range(100, 130)]
    rows = [*good, (100, [1.0, 2.0, 1.0]), (100, [1.0, 2.0, 1.0]), (200, None), (201, []), (202, [0.0, 0.0, 0.0]),
            (203, [1.0, None, 2.0]), (204, [nan, 1.0, 1.0]), (300, [inf, 1.0, 1.0]), (400, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = A.nearest(df, stage, F.col("vec_id") % 100 == 0, k=5).collect()
    ids = {r.query_id for r in got}
    assert ids == {100}
    mine = sorted((r["rank"], r.vec_id, r.score) for r in got)
    assert len({v for _, v, _ in mine}) == len(mine) == 5 and [s for *_, s in mine] == sorted(s for *_, s in mine)
    ties = [(s, v) for _, v, s in mine]
    assert ties == sorted(ties)
    assert A.nearest(df.limit(0), stage, F.col("vec_id") % 100 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in A.nearest(two, stage, F.col("vec_id") == 0).collect()] == [(1, 1.0)]


def test_ids_repeated_more_than_k_times(spark, stage):  # noqa: F811
    """60 copies of a near id, 40 vectors of another, and still all k neighbours."""
    rng = np.random.default_rng(4)
    rows = [(100, [0.1] * 8)] + [(7, [0.11] * 8)] * 60 + [(8, (0.1 + rng.random(8) / 50).tolist()) for _ in range(40)]
    rows += [(1000 + i, rng.standard_normal(8).tolist()) for i in range(2000)]
    rows += [(5001 + i, rng.standard_normal(8).tolist()) for i in range(40)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = A.nearest(df, stage, F.col("vec_id") == 100).orderBy("rank").collect()
    best = {}
    for i, v in rows:
        if i != 100:
            best[i] = min(best.get(i, 9e9), float(np.sqrt(((np.array(v) - 0.1) ** 2).sum())))
    want = sorted((d, i) for i, d in best.items())[:10]
    assert [r.vec_id for r in got] == [i for _, i in want] and [r["rank"] for r in got] == list(range(1, 11))
    assert np.allclose([r.score for r in got], [d for d, _ in want])
