"""Fingerprints and components against all pairs (SQL has no XXH64)."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import xxhash
from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401
from conftest import SF001
from pyspark.sql import functions as F

from histlake.llm import simhash as S
from histlake.llm.common import connected_components
from histlake.llm.queries import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute_print(text):
    w = WORDS.findall((text or "").translate(AZ))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, bits=3):
    """doc_id -> smallest id reachable, by all pairs of distinct fingerprints."""
    fps = sorted({f for _, f in prints})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    arr = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= bits):
            parent[find(fps[i + 1 + j])] = find(f)
    low = {}
    for d, f in prints:
        if d is not None:
            low[find(f)] = min(low.get(find(f), d), d)
    return {(d, f): low.get(find(f)) for d, f in prints}


def test_query_matches_all_pairs(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    want = brute_components([(d, brute_print(t)) for d, t in docs])
    got = queries()["op6_simhash"](spark, SF001).collect()
    assert {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in got} == want
    assert all(len(r.fingerprint) == 16 for r in got)


def test_planted_near_prints_link(spark, stage):
    """Chains, dense groups larger than a block, and far rows."""
    rng = random.Random(9)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for f in fps[:100]:
        for _ in range(4):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                g ^= 1 << b
            fps.append(g)
    dense = rng.getrandbits(64)
    fps += [dense ^ 1 << a ^ 1 << b for a in range(12) for b in range(12)]
    prints = list(enumerate(fps))
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in prints]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    edges = S.fingerprint_edges(S.distance_table(df.select("fp").distinct(), stage), block=16)
    roots = connected_components(edges, stage)
    got = df.join(roots, df.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    groups = {}
    for r in got.collect():
        groups.setdefault(r.root, set()).add(r.doc_id)
    want = {}
    for (d, _), c in brute_components(prints).items():
        want.setdefault(c, set()).add(d)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_edge_cases(spark, odd_docs, stage):
    got = S.components(odd_docs, stage).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got if r.doc_id}
    assert by[1].fp == by[2].fp == by[3].fp == 0 and by[1].component_id == by[3].component_id == 1
    kept = S.keep_one_of_each(odd_docs, stage)
    assert kept.schema == odd_docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(6) == 1 and 1 in ids and 2 not in ids and ids.count(None) == 1
    clash = odd_docs.withColumn("fp", F.lit(1)).withColumn("at", F.lit(2))
    assert S.keep_one_of_each(clash, stage).columns == clash.columns
    assert S.components(odd_docs.limit(0), stage).count() == 0


def test_distance_table_and_what_each_step_leaves(spark, stage):
    """The staged table holds true distances; its coordinates discard most pairs, never a linked one."""
    docs = duckdb.sql(f"select text from '{SF001}/documents.parquet'").fetchall()
    rng = random.Random(6)
    fps = sorted({brute_print(t) for t, in docs})
    fps += [rng.getrandbits(64) for _ in range(600)]
    fps += [f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for f in fps[::3]]
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    refs = S.pivots_of(df)
    assert len(refs) == S.PIVOTS and set(refs.tolist()) <= set(fps.tolist())
    rows = S.distance_table(df, stage).collect()
    for r in rows:
        f = np.array([r.fp], np.int64).view(np.uint64)
        got = np.array([r.d0, r.d1], np.int64).view(np.uint8)
        assert (got == np.bitwise_count(f ^ refs)).all()
    x = np.array([r.fp for r in rows], np.int64).view(np.uint64)
    table = np.array([(r.d0, r.d1) for r in rows], np.int64).view(np.uint8)
    i, j = np.triu_indices(len(x), 1)
    links = int((np.bitwise_count(x[i] ^ x[j]) <= 3).sum())
    for groups in ([(x, table)], [(x[k:k + 20], table[k:k + 20]) for k in range(0, len(x), 20)]):
        left = Counter()
        S.link_blocks(groups, 3, left)
        assert left["pairs"] == sum(len(g) * (len(g) - 1) // 2 for g, _ in groups)
        assert left["linked"] <= left["compared"] < 0.1 * left["pairs"], left
        print(left)
    left = Counter()
    S.link_blocks([(x, table)], 3, left)
    assert left["linked"] == links > 100


def test_pivots_of_few_fingerprints():
    assert (S.choose_pivots(np.zeros(0, np.uint64)) == 0).all()
    one = np.array([7], np.uint64)
    assert S.choose_pivots(one).tolist() == [7] * S.PIVOTS
