"""The pipeline against its stages done by brute force."""

from __future__ import annotations

import hashlib

import duckdb
import sentencepiece
from llm_fixtures import make_docs, odd_docs  # noqa: F401
from conftest import SF001
from test_linededup import brute_links, classes
from test_repetition import brute
from test_simhash import brute_components, brute_print

import corpus_pipeline as C
from histlake.llm import linededup as L
from histlake.llm.queries import piece_model


def test_run_matches_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text, source from '{SF001}/documents.parquet'").fetchall()
    docs = [d for d in docs if brute(d[1])[-1]]
    rows = [((d, k), line) for d, t, _ in docs for k, line in enumerate(t.split("\n"))]
    kept = classes(rows, brute_links([x for _, x in rows], L.TAU, L.MIN_CHARS), L.MIN_CHARS)
    cut = [(d, "\n".join(x for k, x in enumerate(t.split("\n")) if kept[d, k][2]), s) for d, t, s in docs]
    cut = [d for d in cut if d[1].split()]
    prints = {d: brute_print(t) for d, t, _ in cut}
    comp = brute_components(list(prints.items()))
    left = {d: (t, s) for d, t, s in cut if comp[d, prints[d]] == d}

    got = C.run(spark, SF001).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    words, taken = {}, {}
    for d, (t, s) in left.items():
        words[s] = words.get(s, 0) + len(t.split())
    copies = {}
    for r in got:
        t, s = left[r.doc_id]
        ids = library.encode(t, add_eos=True)
        assert (r.source, r.n_tokens) == (s, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        taken[s] = taken.get(s, 0) + len(t.split())
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    from test_mixing import brute_targets
    for s, goal in brute_targets(words).items():
        shortest = min(len(t.split()) for t, x in left.values() if x == s)
        assert abs(taken.get(s, 0) - goal) <= max(0.03 * goal, 2, shortest)


def test_stages_keep_the_columns_and_take_empty_tables(spark, odd_docs):
    for name, f in C.STAGES[:-1]:
        assert f(spark, odd_docs, SF001).columns == odd_docs.columns, name
    for name, f in C.STAGES:
        assert f(spark, odd_docs.limit(0), SF001).count() == 0, name
