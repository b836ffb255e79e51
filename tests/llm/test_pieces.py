"""Encoding and decoding against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import duckdb
import pytest
import sentencepiece
from llm_fixtures import make_docs, odd_docs  # noqa: F401
from conftest import SF001
from pyspark.sql import functions as F

from histlake.llm import pieces as P
from histlake.llm.queries import piece_model, queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def own():
    return P.PieceCodec(piece_model())


def test_random_texts(own, library):
    rng = random.Random(2)
    pool = [p.replace("▁", " ") for p in own.ids]
    texts = ["", " ", "  ", "   a", "a  b", " \n", "\n\n a", "▁a", "a▁▁ b", "\x00", "\t\tx", "日本語 テスト",
             "🙂🙂 ok", "a" * 300, "the" * 200, " " * 40, " " * 17 + "x", "<s> </s> <unk> <0x41>"]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    texts += ["".join(rng.choice("abeinrst ") for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 300), rng.randint(0x400, 0x500), rng.randint(0x3000, 0x9fff), 32]))
                      for _ in range(rng.randint(1, 30))) for _ in range(500)]
    for t in texts:
        ids = library.encode(t, add_eos=True)
        assert own.encode(t) == ids, t
        assert own.encoded(t)[1] == library.decode(ids), t


def test_words_behind_runs_of_spaces(own, library, monkeypatch):
    """Indented code and spaced text go through backtracking; only marks reach the merge."""
    rng = random.Random(4)
    words = [p.strip("▁") for p in own.ids if p.strip("▁")]
    words += ["def f(x):", "return x", "日本", "é", "\x00", "{", "}", "🙂", "Tthe", "the" * 50]
    merged = []
    merge = P.PieceCodec.merge
    monkeypatch.setattr(P.PieceCodec, "merge", lambda self, t: merged.append(t) or merge(self, t))
    own.fits.cache_clear()
    texts = ["".join(" " * rng.choice([1, 1, 2, 3, 4, 7, 8, 15, 16, 17, 18, 33, 40]) + "".join(rng.choices(words, k=rng.randint(0, 3)))
                     + rng.choice(["", "\n", "\t"]) for _ in range(rng.randint(1, 8))) for _ in range(6000)]
    with open(P.__file__) as f:
        texts.append(f.read())
    for t in texts:
        ids = library.encode(t, add_eos=True)
        assert own.encode(t) == ids, t
        assert own.encoded(t)[1] == library.decode(ids), t
    assert merged and all(set(t) == {"▁"} for t in merged if t.startswith("▁▁"))


def test_every_piece_is_what_the_merge_builds(own):
    assert own.builds == set(own.ids)


def test_query_matches_library(spark, library):
    rows = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op3_pieces"](spark, SF001).collect()}
    assert got == want


def test_edge_cases_and_round_trip(spark, odd_docs, library):
    ids = odd_docs.select("doc_id", "text", P.ids_column(F.col("text"), piece_model()).alias("ids"))
    rows = ids.select("*", P.decode_column(F.col("ids"), piece_model()).alias("back")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_eos=True)
        assert r.back == (r.text or "")
    empty = odd_docs.limit(0).select(P.encode_decode(F.col("text"), piece_model()).alias("c"))
    assert empty.count() == 0
