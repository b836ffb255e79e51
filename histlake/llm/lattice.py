"""Subword lattice likelihood (operator 5).

The pieces of an existing vocabulary get unigram probabilities, and a word's
probability is the sum over all its segmentations into pieces, computed by a
forward recursion in log space.  A text is its words and one end token, so
its log probability is a sum over words: no segmentation crosses a word,
because no piece holds a space mark behind another character.  Characters
that are no piece are spelled by their UTF-8 byte pieces.

The vocabulary's own scores (ranks) give the first weights; passes of expected
counts over the distinct training words turn them into probabilities learned
here.  Every training word is a piece besides, an edge from a word's start to
its end: it holds the word's count less a discount, and what the discounts
leave is the mass of the vocabulary's pieces.  The pieces so grow with the
corpus, and the probabilities of all strings still add up to one.

Counting.  A task turns its texts into blocks: the distinct words of a block,
numbered, with their counts, and the texts as numbers.  Word counts, scores
and the way back to the texts then move one row a block and word, not one a
token; a word in every text is one row a block.

Edge cases: a null or empty text is the end token alone; a null doc_id
belongs to the training part; repeated rows are scored each; words of any
length are scored whole; with no training text all counts are zero and the
vocabulary's own weights are used; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import WORD, Stage, py_lower_ascii
from histlake.llm.pieces import BYTE, MARK, NORMAL, read_pieces

SMOOTH = 0.1
ROUNDS = 2
#: least and largest discount of a training word's count
DISCOUNTS = (0.05, 0.95)
#: tokens of one block
BLOCK_TOKENS = 4_000_000
END = ""          # no word is empty, so the end token is written so

_WORDS = re.compile(WORD)
_P = np.uint64(0x9E3779B97F4A7C15)


def _code(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_P) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _spread(h: np.ndarray) -> np.ndarray:
    """The same codes with every bit mixed into the high ones."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Lattice:
    """Forward recursion over the pieces of a vocabulary, words in bulk."""

    def __init__(self, path: str):
        pieces = read_pieces(path)
        self.normal = [(i, p) for i, (p, _, t) in enumerate(pieces) if t == NORMAL]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.size = len(pieces)
        self.end_id = next(i for i, (p, _, _) in enumerate(pieces) if p == "</s>")
        self.top = max(len(p) for _, p in self.normal)
        self.of = {p: i for i, p in self.normal}
        codes = _spread(np.array([_code(p) for _, p in self.normal], np.uint64))
        order = np.argsort(codes)
        self.codes = codes[order]
        self.ids = np.array([i for i, _ in self.normal])[order]
        # a small direct table in front of the sorted codes answers most look-ups
        self.bits = 20
        slot = (self.codes >> np.uint64(64 - self.bits)).astype(np.int64)
        self.first = np.searchsorted(slot, np.arange((1 << self.bits) + 1))
        self.depth = int(np.diff(self.first).max())

    def start(self) -> np.ndarray:
        """Log weights from the vocabulary's order: one over the rank."""
        w = np.zeros(self.size)
        rank = np.argsort(np.argsort([i for i, _ in self.normal])) + 1
        w[[i for i, _ in self.normal]] = 1.0 / (rank + 10)
        w[list(self.bytes.values())] = 1.0 / len(self.normal)
        w[self.end_id] = 0.1 * w.sum()
        return np.log(np.where(w > 0, w / w.sum(), 1e-300))

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece id of each code, or -1."""
        h = _spread(h)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        out = np.full(len(h), -1)
        for d in range(self.depth):
            live = np.flatnonzero(at + d < stop)
            if not len(live):
                break
            k = at[live] + d
            hit = self.codes[k] == h[live]
            out[live[hit]] = self.ids[k[hit]]
        return out

    def _edges(self, words: list[str], n: int) -> list[list[tuple[int, np.ndarray]]]:
        """For words of n characters: for each end, (start, piece id or -1)."""
        cps = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
        cps = cps + np.uint64(1)
        out: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
        with np.errstate(over="ignore"):
            for i in range(n):
                h = np.zeros(len(words), np.uint64)
                for j in range(i, min(n, i + self.top)):
                    h = h * _P + cps[:, j]
                    ids = self._find(h)
                    if j == i or (ids >= 0).any():
                        out[j + 1].append((i, ids))
        return out

    def _spelled(self, words: list[str], at: int, rows: np.ndarray, logp: np.ndarray) -> np.ndarray:
        return np.array([sum(logp[self.bytes[b]] for b in words[r][at].encode()) for r in rows])

    def run(self, words: list[str], logp: np.ndarray, weight: np.ndarray | None = None,
            counts: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each marked word; with ``counts``, the expected
        pieces, ``weight`` times each, are added to them."""
        out = np.zeros(len(words))
        by_len: dict[int, list[int]] = defaultdict(list)
        for r, w in enumerate(words):
            by_len[len(w)].append(r)
        for n, which in by_len.items():
            # the table of a step has rows * n * top cells at most
            step = max(1, 2_000_000 // (n * min(n, self.top)))
            for k in range(0, len(which), step):
                rows = np.array(which[k:k + step])
                some = [words[r] for r in rows]
                edges = self._edges(some, n)
                fwd = np.full((n + 1, len(some)), -np.inf)
                fwd[0] = 0
                cost: list[list[np.ndarray]] = [[] for _ in range(n + 1)]
                for end in range(1, n + 1):
                    for i, ids in edges[end]:
                        c = np.where(ids >= 0, logp[ids], -np.inf)
                        if end - i == 1:
                            odd = np.flatnonzero(ids < 0)
                            if len(odd):
                                c[odd] = self._spelled(some, i, odd, logp)
                        cost[end].append(c)
                    fwd[end] = _logsum([fwd[i] + c for (i, _), c in zip(edges[end], cost[end], strict=True)])
                out[rows] = fwd[n]
                if counts is None:
                    continue
                back = np.full((n + 1, len(some)), -np.inf)
                back[n] = 0
                for end in range(n, 0, -1):
                    for (i, _), c in zip(edges[end], cost[end], strict=True):
                        back[i] = np.logaddexp(back[i], back[end] + c)
                w = weight[rows]
                for end in range(1, n + 1):
                    for (i, ids), c in zip(edges[end], cost[end], strict=True):
                        with np.errstate(invalid="ignore"):
                            part = w * np.exp(fwd[i] + c + back[end] - fwd[n])
                        ok = ids >= 0
                        counts += np.bincount(ids[ok], part[ok], len(counts))
                        if end - i == 1:
                            for r in np.flatnonzero(~ok):
                                for b in some[r][i].encode():
                                    counts[self.bytes[b]] += part[r]
        return out


def _logsum(parts: list[np.ndarray]) -> np.ndarray:
    x = np.stack(parts)
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


@lru_cache(2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


# ---------------------------------------------------------------- blocks
_BLOCKS = "block long, word string, number int, c long, texts binary"


def _pack(ids: list, held: list, counts: list, flat: list) -> bytes:
    have = np.array([i is not None for i in ids])
    return zlib.compress(b"".join([
        np.int64(len(ids)).tobytes(), np.array([i or 0 for i in ids], np.int64).tobytes(), have.tobytes(),
        np.array(held, bool).tobytes(), np.array(counts, np.int64).tobytes(),
        np.concatenate([np.zeros(0, np.int32), *flat]).astype(np.int32).tobytes()]), 1)


def _unpack(data: bytes):
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    at = 8
    ids = np.frombuffer(raw, np.int64, n, at)
    at += 8 * n
    have = np.frombuffer(raw, bool, n, at)
    held = np.frombuffer(raw, bool, n, at + n)
    at += 2 * n
    counts = np.frombuffer(raw, np.int64, n, at)
    return ids, have, held, counts, np.frombuffer(raw, np.int32, -1, at + 8 * n)


def _blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made = 0

        def new():
            numbers: defaultdict = defaultdict()
            numbers.default_factory = numbers.__len__
            return numbers, [], [], [], []

        def emit(numbers, ids, held, counts, flat):
            block = (part << 32) + made
            words = list(numbers)
            train = [f for f, h in zip(flat, held, strict=True) if not h]
            c = np.bincount(np.concatenate([np.zeros(0, np.int32), *train]), minlength=len(words))
            at = range(0, len(words), 100_000)
            for k in at:
                w = words[k:k + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(w), pa.int64()), pa.array(w, pa.string()),
                     pa.array(range(k, k + len(w)), pa.int32()), pa.array(c[k:k + len(w)], pa.int64()),
                     pa.nulls(len(w), pa.binary())], ["block", "word", "number", "c", "texts"])
            ends = len(ids) - sum(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([None], pa.string()), pa.array([-1], pa.int32()),
                 pa.array([ends], pa.int64()), pa.array([_pack(ids, held, counts, flat)], pa.binary())],
                ["block", "word", "number", "c", "texts"])

        state = new()
        tokens = 0
        for batch in batches:
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = _WORDS.findall(py_lower_ascii(t.as_py() or ""))
                numbers, ids, held, counts, flat = state
                ids.append(i)
                held.append(h)
                counts.append(len(words))
                flat.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                tokens += len(words) + 16
                if tokens >= limit:
                    yield from emit(*state)
                    made += 1
                    state, tokens = new(), 0
        if state[1]:
            yield from emit(*state)

    return run


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[pa.Table]:
    """Fewer, larger tables: words of one length are handled together."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


class WordEdges:
    """The training words as pieces, by absolute discounting.

    ``once`` and ``twice`` are the distinct tokens seen so often; they set the
    discount.  Without training tokens the vocabulary's pieces have all mass.
    """

    def __init__(self, total: int, distinct: int, once: int, twice: int):
        low, high = DISCOUNTS
        self.total = max(total, 1)
        self.discount = min(max(once / max(once + 2 * twice, 1), low), high)
        self.rest = self.discount * distinct / total if total else 1.0

    def join(self, c: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Log probability of words seen ``c`` times, given the sum over
        their segmentations into the vocabulary's pieces."""
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(c - self.discount, 0) / self.total)
        return np.logaddexp(whole, spelled + np.log(self.rest))


def learn(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the vocabulary's pieces: its weights, then passes
    of expected counts over all training words, each once, as the pieces are
    to spell words not seen."""
    model = Lattice(path)
    logp = model.start()
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], logp=logp) -> Iterator[pa.RecordBatch]:
            m = lattice(path)
            counts = np.zeros(m.size)
            for batch in _gathered(batches):
                w = [MARK + x for x in batch.column(0).to_pylist()]
                m.run(w, logp, np.ones(len(w)), counts)
            ids = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], ["id", "c"])

        got = (words.select("word").mapInArrow(expect, "id long, c double").groupBy("id")
               .agg(F.sum("c").alias("c")).collect())
        counts = np.full(model.size, 0.0)
        for r in got:
            counts[r.id] = r.c
        counts[model.end_id] = 1.0
        live = [i for i, _ in model.normal] + list(model.bytes.values()) + [model.end_id]
        if got:
            logp = np.full(model.size, -np.inf)
            logp[live] = np.log((counts[live] + SMOOTH) / (counts.sum() + SMOOTH * len(live)))
    return logp


def score_documents(docs: DataFrame, path: str, stage: Stage, rounds: int = ROUNDS,
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"),
                       F.col("text").cast("string").alias("text"))
    blocks = stage.put(rows.mapInArrow(_blocks(block_tokens), _BLOCKS), "blocks")
    named = blocks.where("number >= 0")
    words = stage.put(named.groupBy("word").agg(F.sum("c").alias("c")), "words")
    ends = blocks.where("number < 0").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    known = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1),
                                     F.count_if(F.col("c") == 2)).first()
    total, distinct = known[0] + ends, known[1] + (ends > 0)
    edges = WordEdges(total, distinct, known[2] + (ends == 1), known[3] + (ends == 2))
    logp = learn(words.where("c > 0"), path, rounds)
    unit = np.log(10)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = lattice(path)
        for batch in _gathered(batches):
            spelled = m.run([MARK + w for w in batch.column(0).to_pylist()], logp)
            s = edges.join(batch.column(1).to_numpy(), spelled) / unit
            done = pa.Table.from_arrays([batch.column(0), batch.column(1), pa.array(s)], ["word", "c", "lp"])
            yield from done.to_batches(max_chunksize=20_000)

    scored = stage.put(words.mapInArrow(score, "word string, c long, lp double"), "scored")
    back = named.select(F.col("block").alias("of"), "word", "number").join(scored, "word").select(
        "of", "number", "c", "lp")
    end_lp = float(edges.join(np.array([ends]), logp[[lattice(path).end_id]])[0] / unit)

    def base(c):
        return np.log10((c + SMOOTH) / (total + SMOOTH * (distinct + 1)))

    def finish(key, texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        ids, have, held, counts, flat = _unpack(texts["texts"].iloc[0])
        n = len(table)
        c, lp = np.zeros(n), np.zeros(n)
        at = table["number"].to_numpy()
        c[at] = table["c"].to_numpy()
        lp[at] = table["lp"].to_numpy()
        doc = np.repeat(np.arange(len(ids)), counts)
        add = lambda x: np.bincount(doc, x[flat], len(ids)) if len(flat) else np.zeros(len(ids))
        return pd.DataFrame({
            "doc_id": pd.array(np.where(have, ids, 0), dtype="Int64").copy() if have.all()
            else pd.array([int(i) if h else None for i, h in zip(ids, have, strict=True)], dtype="Int64"),
            "held_out": held, "n_tokens": counts + 1,
            "n_known": (add((c > 0).astype(float)) + (ends > 0)).astype(np.int64),
            "train_tokens": np.full(len(ids), total, np.int64),
            "base_score": add(base(c)) + base(ends), "score": add(lp) + end_lp})

    payload = blocks.where("number < 0").select("block", "texts")
    return payload.groupBy("block").cogroup(back.groupBy("of")).applyInPandas(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
