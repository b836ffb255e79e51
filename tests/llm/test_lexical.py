"""Ranked search by definition; the sharing graph against plain sums."""

from __future__ import annotations

import math
import random
import re

import numpy as np
from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401
from pyspark.sql import functions as F

from histlake.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=10):
    """[(item row, [(score, doc_id)])] best first."""
    lists = [(i, TERM.findall((t or "").translate(AZ))) for i, t in docs]
    lists = [(i, w) for i, w in lists if w]
    total = sum(len(w) for _, w in lists)
    df = {}
    for _, w in lists:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for _, text in items:
        found = []
        for i, w in lists:
            m = 10 + (90 * len(w) * len(lists)) // total
            s = sum(math.floor(1000 * math.log((2 * len(lists) + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 8 * m))
                    for t in set(TERM.findall((text or "").translate(AZ))) if t in df)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out.append([(-s, None if none else i) for s, none, i in sorted(found)[:k]])
    return out


def ranked(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.score, r.doc_id))
    return {i: [x[1:] for x in sorted(v)] for i, v in out.items()}


def test_edge_cases_by_definition(spark, odd_docs, stage):
    items = [(1, "one TWICE over over"), (2, None), (3, ""), (4, "é 日本 w1x1 w2x2"), (5, "nothing-known zzzz"),
             (None, "no id here"), (6, "text\x00over_same 12")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    docs = odd_docs.withColumn("n", F.lit(1)).withColumn("terms", F.lit("clash"))
    got = ranked(L.search(docs, table, stage))
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], items)
    assert got == {i: w for (i, _), w in zip(items, want, strict=True) if w}
    assert L.search(odd_docs.limit(0), table, stage).count() == 0
    assert L.search(odd_docs, table.limit(0), stage).count() == 0


def test_blocks_ties_and_repeats(spark, make_docs, stage):
    rng = random.Random(2)
    words = [f"t{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words[:rng.choice([5, 60])], k=rng.randint(0, 30))) for _ in range(300)]
    docs = [(rng.choice([None, n % 250]), t + rng.choice(["", " t1"])) for n, t in enumerate(texts + texts[:100])]
    items = [(n % 20, " ".join(rng.sample(words, rng.randint(1, 25)))) for n in range(30)]
    df = make_docs([(i, t, "s") for i, t in docs]).repartition(5)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = L.search(df, table, stage, k=7, block_bytes=300).collect()  # many blocks
    want = brute(docs, items, 7)
    by = {}
    for (i, _), w in zip(items, want, strict=True):
        by.setdefault(i, []).extend((n + 1, *x) for n, x in enumerate(w))
    have = {}
    for r in got:
        have.setdefault(r.item_id, []).append((r["rank"], r.score, r.doc_id))
    key = lambda x: (x[0], x[1], x[2] is None, x[2] or 0)
    assert {i: sorted(v, key=key) for i, v in have.items()} == {i: sorted(v, key=key) for i, v in by.items()}


def test_sharing_graph_keeps_every_item():
    rng = random.Random(4)
    base = [rng.sample(range(200), 12) for _ in range(6)]
    lists = [np.array(list(dict.fromkeys(rng.choice(base) + rng.choice(base) + rng.sample(range(200), 5))))
             for _ in range(80)] + [np.zeros(0, np.int64), np.array([3])]
    left, right, tops = L.share_terms(lists, 200)

    def terms(s):
        return [s] if s < 200 else terms(left[s - 200]) + terms(right[s - 200])

    for x, top in zip(lists, tops, strict=True):
        have = [t for s in top.tolist() for t in terms(s)]
        assert sorted(have) == sorted(x.tolist())
    added = len(left) + sum(max(len(t) - 1, 0) for t in tops)
    assert added < 0.6 * sum(max(len(x) - 1, 0) for x in lists)      # sums are shared
    held = np.zeros(200 + len(left), int)                            # items a node is part of
    for top in tops:
        todo = top.tolist()
        while todo:
            x = todo.pop()
            held[x] += 1
            todo += [] if x < 200 else [left[x - 200], right[x - 200]]
    assert (held[200:] >= 2).all()
    graph = L.Accumulators(200, left, right, tops)
    hits = np.array([(t, d) for t in range(200) for d in range(50) if rng.random() < 0.3])
    value = np.array([rng.randint(0, 9) for _ in hits])
    plain = np.zeros((200, 50), np.int64)
    plain[hits[:, 0], hits[:, 1]] = value
    for x, total in zip(lists, graph.batch(hits[:, 0], hits[:, 1], value, 50), strict=True):
        assert (total == plain[x].sum(axis=0)).all()
    assert graph.made == len(left)                                   # each accumulator made once
