"""SentencePiece encoding and decoding by backtracking (operator 3).

The vocabulary merges neighbours by score, best first, leftmost first among
equals.  A sequence of pieces is that merge's result exactly when every two
neighbours are: merging the text of the two again must give the two.  So a
text is encoded from left to right with the longest piece that starts there
(Aho-Corasick gives all pieces that end at a place); a piece that is not
compatible with the one before it gives way to its next shorter prefix, and
when none is left the last piece is taken back and the place it ended at is
marked in a bitfield as failed, never to be tried again.  Compatibility is
checked by merging the two texts and remembered.

A piece never holds a space mark behind another character, and a character
that is in no longer piece merges with nothing, so a text falls apart at
these places without changing the result; words that come back are looked up.
Pieces of space marks alone merge after all others and have one score; of a
run of marks the last one therefore goes to the word behind it, which is
encoded by backtracking as if it stood alone, and only marks that are left
are merged directly.

Edge cases: a null text is encoded as the empty one, which has no pieces but
the end id; characters outside the vocabulary become their UTF-8 byte pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from histlake.llm.common import ship

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: words remembered by a Python worker before it starts anew
CACHE = 400_000


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) of a model file, in id order."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return [(p.piece, p.score, p.type) for p in model.pieces]


class _Memory(dict):
    """Results of a function, for up to ``CACHE`` arguments of ordinary length."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key: str) -> tuple[str, str]:
        got = self.compute(key)
        if len(self) >= CACHE:
            self.clear()
        if len(key) <= 64:
            self[key] = got
        return got


class PieceCodec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        pieces = read_pieces(path)
        self.piece = [p for p, _, _ in pieces]
        self.kind = [t for _, _, t in pieces]
        self.end_id = self.piece.index("</s>")
        self.byte_id = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i, (p, s, t) in enumerate(pieces):
            if t == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
                self.byte_of[i] = int(p[3:5], 16)
            elif t == NORMAL:
                self.ids[p] = i
                self.score[p] = s
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a space mark behind another character")
        runs = [p for p in self.ids if len(p) > 1 and p == MARK * len(p)]
        mixed = [p for p in self.ids if len(p) > 1 and p != MARK * len(p)]
        if any(p.startswith(MARK * 2) for p in mixed):
            raise ValueError("a piece holds several space marks and other characters")
        if runs and mixed and max(map(self.score.get, runs)) >= min(map(self.score.get, mixed)):
            raise ValueError("pieces of space marks merge before others")
        self.automaton = ahocorasick.Automaton()
        joint: set[str] = set()
        self.joint: set[tuple[str, str]] = set()
        for p in self.ids:
            if len(p) > 1:
                joint.update(p)
                self.joint.update(zip(p, p[1:], strict=False))
        # a piece that the merge itself would not build is never a token
        self.builds = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        for p in self.builds:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        # the next shorter piece that a piece starts with
        self.shorter: dict[str, str] = {}
        for p in self.builds:
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if k == 1 or p[:k] in self.builds), "")
        # white space that merges with nothing is cut off before words are looked up
        cut = "".join(c for c in "\n\t\r" if c not in joint)
        stop = re.escape(cut)
        self.split = re.compile(f"{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+" + (f"|[{stop}]" if cut else "")).findall
        self.fits = lru_cache(1 << 18)(self._fits)
        self.parts = _Memory(self._pair)
        self.words = _Memory(self._look)

    # -- the merge itself, for pairs of pieces and for runs of marks
    def merge(self, text: str) -> list[str]:
        """Neighbours are joined while their joint text is a piece: best score
        first, leftmost first among equals."""
        score = self.score
        part = list(text)
        nxt = list(range(1, len(part))) + [-1]
        prv = list(range(-1, len(part) - 1))
        heap = [(-score[a + b], i, a + b) for i, (a, b) in enumerate(zip(part, part[1:], strict=False))
                if a + b in score]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = nxt[i]
            if not part[i] or j < 0 or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, ""
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
                t = both + part[nxt[i]]
                if t in score:
                    heapq.heappush(heap, (-score[t], i, t))
            if prv[i] >= 0:
                t = part[prv[i]] + both
                if t in score:
                    heapq.heappush(heap, (-score[t], prv[i], t))
        return [p for p in part if p]

    def _fits(self, left: str, right: str) -> bool:
        return self.merge(left + right) == [left, right]

    # -- backtracking
    def tokens(self, text: str) -> list[str]:
        if text.startswith(MARK * 2):
            marks = len(text) - len(text.lstrip(MARK)) - 1
            word = self.tokens(text[marks:])
            if word[0] == MARK:                            # no piece joins the last mark to the word
                marks += 1
                del word[0]
            return self.merge(MARK * marks) + word
        builds, fits = self.builds, self.fits
        if text in builds or len(text) == 1:
            return [text]
        n = len(text)
        longest = [1] * n
        for end, length in self.automaton.iter(text):      # ends grow, so the longest is set last
            longest[end + 1 - length] = length
        shorter = self.shorter
        failed = bytearray(n + 1)
        out: list[str] = []
        at, prev = 0, ""
        t = text[:longest[0]]
        while True:
            while t and (failed[at + len(t)] or prev and not fits(prev, t)):
                t = shorter.get(t, "")
            if t:
                out.append(t)
                prev = t
                at += len(t)
                if at == n:
                    return out
                t = text[at:at + longest[at]]
            else:
                failed[at] = 1
                last = out.pop()
                at -= len(last)
                prev = out[-1] if out else ""
                t = shorter.get(last, "")

    def encode_ids(self, word: str) -> list[int]:
        out = []
        for t in self.tokens(word):
            i = self.ids.get(t)
            if i is None:
                out += [self.byte_id[b] for b in t.encode()]
            else:
                out.append(i)
        return out

    def decode_ids(self, ids: list[int]) -> str:
        """The text of pieces, marks still in it."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            if self.kind[i] != CONTROL:
                out.append(" \u2047 " if self.kind[i] == UNKNOWN else self.piece[i])
        if run:
            out.append(run.decode(errors="replace"))
        return "".join(out)

    def _pair(self, word: str) -> tuple[str, str]:
        ids = self.encode_ids(word)
        return " ".join(map(str, ids)), self.decode_ids(ids).replace(MARK, " ")

    def _look(self, word: str) -> tuple[str, str]:
        """Ids and text of a word not seen lately, put together from its parts
        between characters that no piece holds side by side."""
        joint, parts, at = self.joint, [], 0
        for i, two in enumerate(zip(word, word[1:], strict=False), 1):
            if two not in joint:
                parts.append(word[at:i])
                at = i
        if not parts:
            return self._pair(word)
        parts.append(word[at:])
        both = list(map(self.parts.__getitem__, parts))
        return " ".join([i for i, _ in both]), "".join([t for _, t in both])

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, with the end id."""
        return [int(i) for i in self.encoded(text)[0].split()]

    def encoded(self, text: str) -> tuple[str, str]:
        """The ids, joined by one space, and the decoded text."""
        end = str(self.end_id)
        if not text:
            return end, ""
        # a mark stands before the text and for every space
        parts = list(map(self.words.__getitem__, self.split(MARK + text.replace(" ", MARK))))
        return " ".join([i for i, _ in parts]) + " " + end, "".join([t for _, t in parts])[1:]


@lru_cache(2)
def codec(path: str) -> PieceCodec:
    """One codec a Python process: the tables are built once a worker."""
    return PieceCodec(path)


def encode_decode(text: Column, model: str) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256 of a text column."""
    ship()

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pa.Array) -> pa.Array:
        c = codec(model)
        n, ids, dec = [], [], []
        last: tuple[str, str, str, int] | None = None
        for t in texts:
            t = t.as_py()
            if last is None or last[0] != t:
                i, d = c.encoded(t)
                last = (t, hashlib.sha256(i.encode()).hexdigest(),
                        hashlib.sha256(d.encode()).hexdigest(), i.count(" ") + 1)
            n.append(last[3])
            ids.append(last[1])
            dec.append(last[2])
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                           pa.array(dec, pa.string())],
                                          ["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(F.coalesce(text.cast("string"), F.lit("")))


def ids_column(text: Column, model: str) -> Column:
    """The ids of a text column as an array, the end id last."""
    ship()

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        c = codec(model)
        return pa.array([c.encode(t.as_py()) for t in texts], pa.list_(pa.int32()))

    return run(F.coalesce(text.cast("string"), F.lit("")))


def decode_column(ids: Column, model: str) -> Column:
    """The texts of arrays of ids."""
    ship()

    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        c = codec(model)
        out = []
        for r in rows:
            r = r.as_py()
            s = None if r is None else c.decode_ids(r).replace(MARK, " ")
            out.append(s[1:] if s and s[0] == " " else s)
        return pa.array(out, pa.string())

    return run(ids)
