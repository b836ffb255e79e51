"""The mix against its contract and a direct solution (no SQL: Newton steps)."""

from __future__ import annotations

import math
import re

import duckdb
import pytest
from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401
from conftest import SF001, SF01
from pyspark.sql import functions as F

from histlake.llm import mixing as M
from histlake.llm.queries import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(size, weights=M.WEIGHTS):
    """Resharing the excess by weight until no source is above its cap."""
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > 2 * size[s]}
        if not full:
            return target | {s: w[s] * level for s in open_}
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= full
    return target


def check(rows, docs, near):
    words = [(d, s, len(WORDS.findall(t or ""))) for d, t, s in docs]
    size = {}
    for _, s, n in words:
        size[s] = size.get(s, 0) + n
    target = brute_targets(size)
    source = {d: s for d, s, _ in words}
    n_of = {d: n for d, _, n in words}
    taken = {}
    for r in rows:
        s = source[r.doc_id]
        assert r["size"] == n_of[r.doc_id] and r.source_size == size[s]
        assert r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[s] = taken.get(s, 0) + r.taken
    for s in size:
        smallest = sorted(n for _, x, n in words if x == s and n)[:2]
        assert abs(taken[s] - target[s]) <= max([near * target[s], 2.0, *smallest])


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_keeps_its_contract(spark, sf):
    docs = duckdb.sql(f"select doc_id, text, source from '{sf}/documents.parquet'").fetchall()
    query = queries()["op1_mixing"]
    rows = query(spark, sf).collect()
    check(rows, docs, 0.02)
    assert sorted(rows) == sorted(query(spark, sf).collect())


def test_rates_solve_the_dual(spark, stage):
    """Rates found by the steps meet the targets that bisection meets."""
    cells = [(0, n, 1 + n % 3) for n in range(1, 60)] + [(1, n, 2) for n in range(5, 500, 7)]
    df = spark.createDataFrame(cells, "sid long, size long, n long")
    size = {s: sum(x * n for i, x, n in cells if i == s) for s in (0, 1)}
    docs = {s: sum(n for i, _, n in cells if i == s) for s in (0, 1)}
    goal = {0: 1.9 * size[0], 1: 0.3 * size[1]}
    targets = spark.createDataFrame([(s, str(s), docs[s], size[s], goal[s]) for s in (0, 1)],
                                    "sid long, source string, docs long, source_size long, target double")
    even = sum(goal.values()) / sum(size.values())
    for r in M.solve_rates(df, targets, stage, even).collect():
        mean = size[r.sid] / docs[r.sid]
        got = sum(x * n * min(2.0, even * math.exp(r.lam * x / mean)) for i, x, n in cells if i == r.sid)
        assert got == pytest.approx(goal[r.sid], rel=1e-5)


def test_hot_size_and_sources(spark, make_docs, stage):
    """One (source, size) holds most rows; copies, nulls and empty sources."""
    docs = ([(i, "a b c d", "hot") for i in range(3000)] + [(5000 + i, "x " * (i + 1), None) for i in range(40)]
            + [(9000, None, "void"), (9001, "", "void"), (9002, "a b", "z")])
    df = make_docs(docs)
    rows = M.mix(df, stage).collect()
    assert len(rows) == len(docs)
    check(rows, docs, 0.02)
    out = M.mixed_documents(df.withColumn("copies", F.lit("x")), stage)
    assert out.columns == [*df.columns, "copies"]
    assert out.count() == sum(r.copies for r in rows)


def test_edge_cases(spark, odd_docs, stage):
    rows = M.mix(odd_docs, stage).collect()
    assert len(rows) == odd_docs.count()
    assert M.mix(odd_docs.limit(0), stage).count() == 0
    assert M.mixed_documents(odd_docs, stage).schema == odd_docs.schema


def test_repeated_rows_meet_the_target(spark, make_docs, stage):
    """One text is a whole source; three texts are two; a row is half of a source."""
    cases = [[(1, "a b c d e f g h", "s")] * 1000,
             [(k, t, s) for s in ("x", "y") for k, t in enumerate(("a b c", "d e", "f")) for _ in range(50)],
             [(7, "w " * 9, "s")] * 500 + [(100 + i, "v " * (1 + i % 20), "s") for i in range(500)]
             + [(9000 + i, "u " * 30, None) for i in range(300)]]
    for docs in cases:
        df = make_docs(docs).repartition(6)
        rows = M.mix(df, stage).collect()
        assert len(rows) == len(docs) and all(0 <= r.copies <= 2 for r in rows)
        size, taken, shortest = {}, {}, {}
        source = {(d, len(WORDS.findall(t))): s for d, t, s in docs} if len({(d, s) for d, _, s in docs}) == len(
            {d for d, _, _ in docs}) else None
        for _, t, s in docs:
            n = len(WORDS.findall(t))
            size[s] = size.get(s, 0) + n
            shortest[s] = min(shortest.get(s, n), n)
        target = brute_targets(size)
        for r in rows:
            s = source[r.doc_id, r["size"]] if source else None
            taken[s] = taken.get(s, 0) + r.taken
        if source:
            for s in size:
                assert abs(taken[s] - target[s]) <= max(0.02 * target[s], shortest[s])
        assert abs(sum(taken.values()) - sum(target.values())) <= max(0.02 * sum(target.values()), 8)
        out = M.mixed_documents(df, stage)
        assert out.schema == df.schema and out.count() == sum(r.copies for r in rows)
        words = out.agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
        assert words == sum(r.taken for r in rows)
        again = M.mix(df, stage).select("doc_id", "copies").collect()
        assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in rows)
