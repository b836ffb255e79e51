"""Lattice probabilities against all segmentations, counts against Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from conftest import SF001
from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401

from histlake.llm import lattice as L
from histlake.llm.queries import piece_model, queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute_word(m, logp, w):
    @lru_cache(None)
    def rest(i):
        if i == len(w):
            return 1.0
        total = 0.0
        for j in range(i + 1, min(len(w), i + m.top) + 1):
            p = w[i:j]
            if p in m.of:
                total += math.exp(logp[m.of[p]]) * rest(j)
            elif j == i + 1:
                total += math.exp(sum(logp[m.bytes[b]] for b in p.encode())) * rest(j)
        return total
    return math.log(rest(0))


def test_forward_sums_all_segmentations():
    m = L.Lattice(piece_model())
    logp = m.start()
    assert np.exp(logp).sum() == pytest.approx(1)
    words = ["▁the", "▁erblehe", "▁日本🙂", "▁a", "▁éaux", "▁" + "ab" * 40, "▁ththe"]
    assert list(m.run(words, logp)) == pytest.approx([brute_word(m, logp, w) for w in words])


def test_expected_counts_are_the_gradient():
    """Raising a piece's weight moves the sum by its expected count."""
    m = L.Lattice(piece_model())
    logp = m.start()
    words, weight = ["▁there", "▁thing", "▁ünd"], np.array([2.0, 1.0, 3.0])
    counts = np.zeros(m.size)
    before = (m.run(words, logp, weight, counts) * weight).sum()
    for piece in ("▁the", "re", "t", "ing", "▁"):
        moved = logp.copy()
        moved[m.of[piece]] += 1e-5
        slope = ((m.run(words, moved) * weight).sum() - before) / 1e-5
        assert slope == pytest.approx(counts[m.of[piece]], abs=1e-3)


def expected_base(docs):
    train, rows = Counter(), {}
    for i, t in docs:
        ws = WORDS.findall((t or "").translate(AZ))
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        rows.setdefault(i, []).append((held, ws))
        if not held:
            train.update(ws)
            train[""] += 1
    n, v = sum(train.values()), len(train)
    out = {}
    for i, many in rows.items():
        out[i] = [(held, len(ws) + 1, sum(train[w] > 0 for w in [*ws, ""]), n,
                   sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*ws, ""])) for held, ws in many]
    return out


def test_query_counts_and_scores(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    want = expected_base(docs)
    got = queries()["op5_lattice"](spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:5] == want[r.doc_id][0][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][0][4])
        assert r.score < 0
    # better than the vocabulary's own weights on the texts held out
    m = L.Lattice(piece_model())
    text = dict(docs)
    held = [r for r in got if r.held_out]
    plain = 0.0
    for r in held:
        ws = WORDS.findall(text[r.doc_id].translate(AZ))
        plain += (m.run(["▁" + w for w in ws], m.start()).sum() + m.start()[m.end_id]) / math.log(10)
    assert sum(r.score for r in held) > plain
    # ... and near the base model there, which spells no unseen word out
    tokens = sum(r.n_tokens for r in held)
    known = sum(r.n_known for r in held)
    assert sum(r.score for r in held) > sum(r.base_score for r in held) - 5 * (tokens - known)


def test_word_edges_add_up_to_one():
    """Seen tokens' edges and the rest are the whole mass, also with odd counts."""
    for counts in ([5, 3, 1, 1, 2], [1, 1, 1], [4, 4], [1]):
        e = L.WordEdges(sum(counts), len(counts), counts.count(1), counts.count(2))
        nothing = np.full(len(counts), -np.inf)
        assert np.exp(e.join(np.array(counts), nothing)).sum() + e.rest == pytest.approx(1)
        assert 0 < e.rest < 1
    none = L.WordEdges(0, 0, 0, 0)
    assert none.join(np.array([0]), np.array([-3.0]))[0] == pytest.approx(-3.0)


def test_word_probabilities_by_all_segmentations(spark, make_docs, stage):  # noqa: F811
    """Scores equal brute force: discounted count plus the rest times the sum
    over the pieces' segmentations, by weights learned from each word once."""
    docs = [(i, "tree house tree" if i % 3 else "house alpha", "s") for i in range(30)] + [
        (i, "unseen treehouse", "s") for i in range(30, 60)]
    held = {i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 10 == 0}
    docs = [d for d in docs if d[0] < 30 or d[0] in held]
    got = {r.doc_id: r.score for r in L.score_documents(make_docs(docs), piece_model(), stage).collect()}
    c = Counter(w for i, t, _ in docs if i not in held for w in [*t.split(), ""])
    n, once, twice = sum(c.values()), sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d = min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)
    m = L.Lattice(piece_model())
    logp = m.start()
    for _ in range(L.ROUNDS):
        counts = np.zeros(m.size)
        ws = ["▁" + w for w in c if w]
        m.run(ws, logp, np.ones(len(ws)), counts)
        counts[m.end_id] = 1
        live = [i for i, _ in m.normal] + list(m.bytes.values()) + [m.end_id]
        logp = np.full(m.size, -np.inf)
        logp[live] = np.log((counts[live] + 0.1) / (counts.sum() + 0.1 * len(live)))

    def word(w):
        spelled = math.exp(logp[m.end_id] if w == "" else brute_word(m, logp, "▁" + w))
        return math.log10(max(c[w] - d, 0) / n + d * len(c) / n * spelled)
    assert any(i >= 30 for i, _, _ in docs)
    for i, t, _ in docs:
        assert got[i] == pytest.approx(sum(map(word, [*t.split(), ""])))


def test_scores_add_up_from_one_model(spark, make_docs, stage):  # noqa: F811
    """Equal words score equally, whatever block they are in."""
    docs = make_docs([(i, "alpha beta" if i % 2 else "alpha", "s") for i in range(40)])
    got = L.score_documents(docs, piece_model(), stage, block_tokens=50).collect()
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id % 2, set()).add(round(r.score, 9))
    assert len(got) == 40 and all(len(s) == 1 for s in scores.values())


def test_edge_cases(spark, odd_docs, stage):  # noqa: F811
    got = L.score_documents(odd_docs, piece_model(), stage).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = expected_base(docs)
    assert sorted((str(r.doc_id), tuple(r)[1:5]) for r in got) == sorted(
        (str(i), x[:4]) for i, many in want.items() for x in many)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert L.score_documents(odd_docs.limit(0), piece_model(), stage).count() == 0
