"""Repetition coverage against a plain count of n-grams (SQL is not given: six
n-gram lengths over whole texts are too slow there)."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest
from llm_fixtures import make_docs, odd_docs  # noqa: F401
from conftest import SF001
from pyspark.sql import functions as F

from histlake.llm import repetition as R
from histlake.llm.queries import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    ws = WORDS.findall(t or "")
    n, chars = len(ws), sum(map(len, ws))

    def inside(k, first):
        grams = [tuple(ws[i:i + k]) for i in range(n - k + 1)]
        count, seen, mask = Counter(grams), set(), [False] * n
        for i, g in enumerate(grams):
            if count[g] > 1 if first else g in seen:
                mask[i:i + k] = [True] * k
            seen.add(g)
        return mask

    rep = sum(inside(R.REPEAT_WINDOW, True))
    lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
    dup = [x for i, x in enumerate(lines) if x in lines[:i]]
    base = n < 20 or 100 * rep > 30 * n
    shares = {k: sum(len(w) for w, m in zip(ws, inside(k, False), strict=True) if m) / chars if chars else 0.0
              for k in R.NGRAM_LIMITS}
    bad = any(shares[k] > lim for k, lim in R.NGRAM_LIMITS.items())
    if lines:
        bad |= len(dup) > R.DUP_LINE_LIMIT * len(lines)
        bad |= sum(map(len, dup)) > R.DUP_LINE_CHAR_LIMIT * sum(map(len, lines))
    return (n, chars, sum((t or "").count(c) for c in R.SYMBOLS), len(dup), rep, base,
            pytest.approx(max(shares.values())), sum(map(len, dup)), not base and not bad)


def test_measures_match_a_plain_count():
    rng = random.Random(3)
    texts = ["", " ", "\n\n", "a", "a b c"]
    for _ in range(300):
        vocab = ["".join(rng.choice("ab#$é") for _ in range(3)) for _ in range(rng.choice([2, 5, 30]))]
        t = " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 90)))
        texts.append(t.replace(" ", "\n", rng.randint(0, 5)) + "\n" + t[:rng.randint(0, len(t))])
    m = R.measure(texts)
    for i, t in enumerate(texts):
        assert tuple(v[i] for v in m.values()) == brute(t)


def test_query_matches_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    got = {r[0]: tuple(r)[1:] for r in queries()["op8_repetition"](spark, SF001).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_edge_cases(spark, odd_docs):
    got = odd_docs.select("doc_id", "text", R.repetition(F.col("text")).alias("m")).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id not in (5, 8, 9):
            assert tuple(r.m) == brute(r.text)
    assert not any(r.m.kept for r in got if r.text is None or r.doc_id == 8)
    assert R.quality_filter(odd_docs).columns == odd_docs.columns
    assert R.quality_filter(odd_docs.withColumn("kept", F.lit(1)).limit(0)).count() == 0
