"""Near-duplicate lines by a segment-partition edit join (operator 4).

The threshold grows with the line.  Two lines of fewer words than the last
band of ``word_taus`` are linked when at most ``tau`` characters are edited;
from the first band on, lines are linked too when at most as many words are
edited (one replaced, put in or taken out each) as the band of the shorter
line allows.  Both are one join over sequences, of characters or of words.

A sequence of length ``l`` is cut into ``tau + 1`` segments of nearly equal
length; ``tau`` edits leave at least one of them untouched, so a linked
longer line holds it as a subsequence near the same place.  Only the
places that can take part in such a match are looked up: the
multi-match-aware window around a segment's place, widened by the difference
of the lengths.  Rows with equal (length, segment number, content) keys are
to be grouped.  Most keys stand alone, so tasks deal their rows out as arrays,
one a slot of keys, and a slot leaves only the rows whose keys different lines
share (a slot is a partition; its rows, 20 bytes each, are in memory, and slots
grow in number with the lines).  Of these, a key with many rows, or with long
ones, is cut into blocks and every pair of blocks is a row of its own.  In a
block, parity signatures of the characters and words (an edit flips two bits
at most) discard pairs, and a banded bit-parallel edit distance verifies the
others, each in the block of the smallest key it shares.  What leaves a block is linear in its rows: the
number of links of each, and one row that its links reach.

Exact copies are one text with many places, at every length: they are found
by grouping, not by the join.  Lines of fewer than ``min_chars`` code points
link to no different text; of these, lines without a word always stay.  A class
is everything that links reach; its first line (by doc_id, null last, then by
text hash, then line number) stays, the others are dropped.

Edge cases: a null text has no lines, an empty one has one empty line; rows
that agree in doc_id and text are repeated rows and share one decision;
tables with other columns are handled through ``doc_id`` and ``text`` only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import WORD, Stage, connected_components

TAU = 2
MIN_CHARS = 30
#: (words of the shorter line, word edits): 5% of the words, two at most
WORD_TAUS = ((20, 1), (40, 2))
#: staged keys up to this many rows (8 bytes each) are broadcast, more are joined by a shuffle
BROADCAST_ROWS = 1_000_000
#: lines whose signatures come to one slot of keys, about (a dozen rows of 20 bytes a line)
SLOT_LINES = 1 << 15
#: characters that are signed at once
SIGN_CHARS = 1 << 17
#: signature rows a task holds before they are dealt to the slots
SIGN_ROWS = 1 << 17
#: rows of one key that are compared with each other in one piece
BLOCK = 256
#: characters of one such piece, unless a single line is longer
BLOCK_CHARS = 1 << 20

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORDS = re.compile(WORD)
# mark: twice the line's characters, and one if the row is a segment
_SIG_SCHEMA = "slot int, key array<long>, id array<long>, mark array<int>"
_MEMBER_SCHEMA = "key long, id long, mark int"


def segments(length: int, tau: int) -> list[tuple[int, int]]:
    """(start, length) of the tau + 1 segments; the last ones are longer by one."""
    k = tau + 1
    base, more = divmod(length, k)
    out, at = [], 0
    for i in range(k):
        n = base + (i >= k - more)
        out.append((at, n))
        at += n
    return out


def windows(longer: int, shorter: int, tau: int) -> list[tuple[int, int, int]]:
    """(segment, start, length) of the substrings of a line of ``longer``
    characters that may equal a segment of one of ``shorter``."""
    delta = longer - shorter
    out = []
    for i, (p, n) in enumerate(segments(shorter, tau)):
        lo = max(0, p - i, p + delta - (tau - i))
        hi = min(longer - n, p + i, p + delta + (tau - i))
        out += [(i, s, n) for s in range(lo, hi + 1)]
    return out


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


@lru_cache(2)
def _few_powers(x: int) -> np.ndarray:
    return _all_powers(x, 2 * SIGN_CHARS)


def _all_powers(x: int, n: int) -> np.ndarray:
    out = np.full(n + 1, x, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers(x: int, n: int) -> np.ndarray:
    """Powers 0 to ``n`` at least; those that most calls need are kept."""
    return _few_powers(x) if n <= 2 * SIGN_CHARS else _all_powers(x, n)


@lru_cache(1)
def _scrambled() -> np.ndarray:
    with np.errstate(over="ignore"):
        return _finish(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))


def word_tau(words: np.ndarray, word_taus: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Word edits allowed by the words of the shorter line, -1 below the first band."""
    out = np.full(len(words), -1)
    for least, t in word_taus:
        out[words >= least] = t
    return out


def _sums(x: np.ndarray, inv: np.ndarray) -> np.ndarray:
    """Prefix sums of symbols, each by the power of its place: any run's hash
    takes two look-ups, and the power of its start takes the place out."""
    pre = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * inv[:len(x)], out=pre[1:])
    return pre


class _Text:
    """Lines behind each other as hashed symbols: their characters
    (``chars``, line k from ``starts[k]`` on, ``lens[k]`` of them) and their
    words (``words``, ``w_starts``, ``n_words``); ``pre`` are the sums of
    the characters, ``inv`` and ``pw`` the powers."""

    def __init__(self, lines: list[str]):
        self.lens = np.fromiter(map(len, lines), np.int64, len(lines))
        self.starts = np.cumsum(self.lens + 1) - self.lens - 1   # a line end behind each line ends its last word
        cps = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le"), np.uint32)
        self.inv, self.pw = _powers(_PINV, len(cps)), _powers(_P, len(cps))
        self.chars = _scrambled()[cps]
        self.pre = _sums(self.chars, self.inv)
        inside = np.zeros(len(cps) + 1, np.int8)
        inside[1:] = (cps != 32) & ((cps < 9) | (cps > 13))
        step = np.diff(inside)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # a word is one symbol: the hash of its characters
        self.words = _finish((self.pre[last] - self.pre[first]) * self.pw[first])
        self.w_starts = np.searchsorted(first, self.starts)
        self.n_words = np.diff(np.append(self.w_starts, len(first)))


def _segment_rows(starts: np.ndarray, lens: np.ndarray, pre: np.ndarray, pw: np.ndarray, tau_of, top: int,
                  kind: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, lines, indexed) of all segments and windows; ``tau_of`` gives
    the threshold by the shorter line's length, negative for none."""
    for delta in range(top + 1):
        other = lens - delta
        taus = tau_of(other)
        alive = taus >= delta
        k = np.maximum(taus, 0) + 1
        base, longer = other // k, k - other % k            # segments from `longer` on are longer by one
        for i in range(top + 1):
            n = base + (i >= longer)
            p = i * base + np.maximum(0, i - longer)
            lo = np.maximum(np.maximum(0, p - i), p + delta - (taus - i))
            hi = np.minimum(np.minimum(lens - n, p + i), p + delta + (taus - i))
            t = 0
            while True:
                at = np.flatnonzero(alive & (i <= taus) & (lo + t <= hi))
                if not len(at):
                    break
                s = lo[at] + t
                a = starts[at] + s
                h = _finish((pre[a + n[at]] - pre[a]) * pw[a])
                yield (_finish(h ^ ((other[at] * 64 + i) * 2 + kind).astype(np.uint64)), at,
                       (delta == 0) & (s == p[at]))
                t += 1


def signatures(lines: list[str], ids: np.ndarray, tau: int, min_chars: int,
               word_taus: tuple[tuple[int, int], ...] = WORD_TAUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, ids, marks) of the lines' index and probe rows, all lines at once."""
    with np.errstate(over="ignore"):
        text = _Text(lines)
        few = text.n_words < word_taus[-1][0] if word_taus else np.ones(len(lines), bool)
        found = list(_segment_rows(text.starts, text.lens, text.pre, text.pw,
                                   lambda n: np.where(few & (n >= min_chars), tau, -1), tau, 1))
        found += _segment_rows(text.w_starts, text.n_words, _sums(text.words, text.inv), text.pw,
                               lambda n: word_tau(n, word_taus), max((t for _, t in word_taus), default=-1), 0)
    keys, at, ind = zip((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)), *found, strict=True)
    at = np.concatenate(at)
    mark = (np.minimum(text.lens, 1 << 29)[at] * 2 + np.concatenate(ind)).astype(np.int32)
    return np.concatenate(keys).view(np.int64), ids[at], mark


def _dealt(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], slots: int) -> pa.RecordBatch:
    """Signature rows as one row a slot: the keys of a slot, their lines and marks as arrays."""
    columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
    slot = ((columns[0].view(np.uint64) >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(slot.astype(np.uint16) if slots <= 1 << 16 else slot, kind="stable")
    n = np.bincount(slot)
    held = np.flatnonzero(n)
    ends = np.append(0, np.cumsum(n[held])).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)),
                                       *[pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in columns]],
                                      ["slot", "key", "id", "mark"])


def _shared(table: pa.Table) -> pa.Table:
    """Of one slot, the rows of keys under which different lines meet, one at
    least as a segment; of repeated ones the largest mark stays."""
    key, line, mark = (table[c].combine_chunks().flatten().to_numpy() for c in ("key", "id", "mark"))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    order = order[np.union1d(np.flatnonzero(same), np.flatnonzero(same) + 1)]      # most keys stand alone
    order = order[np.lexsort((-mark[order], line[order], key[order]))]
    key, line, mark = key[order], line[order], mark[order]
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    once = new | np.append(True, line[1:] != line[:-1])[:len(key)]
    key, line, mark, new = key[once], line[once], mark[once], new[once]
    group = np.cumsum(new) - 1
    meet = (np.bincount(group) > 1) & (np.bincount(group, mark % 2) > 0)
    take = meet[group]
    return pa.table({"key": key[take], "id": line[take], "mark": mark[take]})


def within(a: Sequence[str], b: Sequence[str], tau: int) -> bool:
    """Edit distance (of characters or words) at most ``tau``.

    Equal ends are cut off.  The rest goes through the bit-parallel
    recurrence on a band: bit k of the vectors stands for row
    ``j - tau + k`` of column j, so the band slides down one row a column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > tau:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    cut = 0
    while cut < len(a) and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    a, b = a[:len(a) - cut], b[:len(b) - cut]
    m = len(a)
    if not m:
        return len(b) <= tau
    last = 2 * tau
    mask = (2 << last) - 1
    # rows of the band by character, as a mask and the column it is written for;
    # a column adds the row that enters the band, so no mask is longer than it
    where: dict[str, tuple[int, int]] = {}
    for r, c in enumerate(a[:tau]):
        where[c] = (where.get(c, (0, 0))[0] | 1 << (r + tau + 1), 0)
    up = mask >> (tau + 1) << (tau + 1)      # column 0 rises by one a row below row 0
    down = 0
    score = min(m, tau)
    for j, c in enumerate(b, 1):
        up = up >> 1 | 1 << last
        down >>= 1
        if j + tau <= m:
            x = a[j + tau - 1]
            held, at = where.get(x, (0, j))
            where[x] = (held >> (j - at) | 1 << last, j)
        held, at = where.get(c, (0, j))
        eq = held >> (j - at) & mask
        diag = ((((eq & up) + up) ^ up) | eq | down) & mask   # no cost on the diagonal
        right = down | (mask & ~(diag | up))
        back = diag & up
        if j + tau <= m:
            score += not diag >> last & 1
        else:
            k = m - j + tau
            score += (right >> k & 1) - (back >> k & 1)
        over = (right << 1 | 1) & mask
        up = (back << 1 & mask) | (mask & ~(diag | over))
        down = diag & over
    return score <= tau


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line): one row a line of each text."""
    text = F.col("text").cast("string")
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("ls"))
    return one.select("doc_id", "text_hash", F.posexplode("ls").alias("line_no", "line"))


def _has_chars(line: str, n: int) -> Column:
    """At least ``n`` code points; one takes four bytes at most, so most lines need no count."""
    octets = F.octet_length(line)
    return (octets >= n) & ((octets >= 4 * n) | (F.char_length(line) >= n))


def _hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(0x5EED), line).alias("h2")]


def _node(h1: str, h2: str) -> Column:
    return F.format_string("%016x%016x", F.col(h1), F.col(h2))


def _small(keys: DataFrame) -> DataFrame:
    """A staged one-column table, to be broadcast if its counted rows are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def edit_links(lines: DataFrame, stage: Stage, tau: int = TAU, min_chars: int = MIN_CHARS,
               word_taus: tuple[tuple[int, int], ...] = WORD_TAUS, n_lines: int | None = None) -> DataFrame:
    """What the links between different texts of ``lines(line)``, ``n_lines``
    about if they are counted already, come to, a row
    a linked text and block: (h1, h2, n_links, r1, r2), the text's two hashes,
    its links found there, and the text its part of the block is joined to.
    A pair is counted in one block only: that of the smallest key it shares."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # copies within a task are signed once; what is remembered is bounded
        seen: set[int] = set()
        texts: list[str] = []
        ids: list[int] = []
        size = 0
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for h, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if h in seen:
                    continue
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add(h)
                texts.append(line)
                ids.append(h)
                size += len(line)
                if size > SIGN_CHARS:
                    rows.append(signatures(texts, np.array(ids, np.int64), tau, min_chars, word_taus))
                    texts, ids, size = [], [], 0
                    if sum(len(r[0]) for r in rows) >= SIGN_ROWS:
                        yield _dealt(rows, slots)
                        rows = []
        if texts:
            rows.append(signatures(texts, np.array(ids, np.int64), tau, min_chars, word_taus))
        if rows:
            yield _dealt(rows, slots)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from _shared(pa.Table.from_batches(held)).to_batches()

    long = lines.where(_has_chars("line", min_chars))
    # keys are hashes, so slots of them are even; most keys stand alone and leave no row
    slots = max(1, -(-(long.count() if n_lines is None else n_lines) // SLOT_LINES))
    rows = long.select(F.xxhash64("line").alias("id"), "line").mapInArrow(sign, _SIG_SCHEMA)
    # a slot is a partition, whatever the session's number of them: none holds more than its share
    rows = rows.repartitionById(slots, "slot").mapInArrow(meet, _MEMBER_SCHEMA)
    rows = stage.put(rows, "members")
    # a line has a few dozen keys at most, so every row can tell under which others it stands
    wanted = stage.put(rows.groupBy("id").agg(
        F.collect_list(F.expr("case when mark % 2 = 1 then key end")).alias("segs"),
        F.collect_list(F.expr("case when mark % 2 = 0 then key end")).alias("wins")), "wanted")
    h1, h2 = _hashes(F.col("line"))
    text = long.withColumn("id", F.xxhash64("line")).join(_small(wanted.select("id")), "id", "left_semi")
    text = stage.put(text.select(h1, h2, "line").dropDuplicates(["h1", "h2"]), "texts")
    size = rows.groupBy("key").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("mark") / (2 * BLOCK_CHARS))).cast("int").alias("parts"))
    met = rows.join(size, "key").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int"))
    # every block meets every other once; a lone block meets itself
    met = met.withColumn("other", F.explode(F.expr(
        "case when parts = 1 then array(0) else filter(sequence(0, parts - 1), x -> x <> own) end")))
    # pairs within a block are looked at where it meets the first other one
    met = met.withColumn("home", F.expr("parts = 1 or other = if(own = 0, 1, 0)"))
    met = met.join(text.withColumnRenamed("h1", "id"), "id").join(wanted, "id")
    row = F.struct("id", "h2", (F.col("mark") % 2 == 1).alias("indexed"), "own", "home", "line",
                   *[F.filter(c, lambda k: k < F.col("key")).alias(c) for c in ("segs", "wins")])
    groups = met.groupBy("key", F.least("own", "other"), F.greatest("own", "other")).agg(F.collect_list(row).alias("g"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ends = batch.column(0).values, batch.column(0).offsets.to_numpy()
            out: list[tuple[int, int, int, int, int]] = []
            a = 0
            while a < len(ends) - 1:         # small blocks are looked at together
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + 2 * BLOCK, "right")) - 1)
                out += linked(rows.slice(ends[a], ends[b] - ends[a]), ends[a:b + 1] - ends[a], tau, word_taus)
                a = b
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(5)],
                                             ["h1", "h2", "n_links", "r1", "r2"])

    return groups.select("g").mapInArrow(verify, "h1 long, h2 long, n_links long, r1 long, r2 long")


def _parities(symbols: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64 bits a line: the parities of its symbols' counts, by hash."""
    xors = np.zeros(len(symbols) + 1, np.uint64)
    np.bitwise_xor.accumulate(np.uint64(1) << (symbols & np.uint64(63)), out=xors[1:])
    return xors[starts + n] ^ xors[starts]


def _shapes(lines: list[str]) -> list[np.ndarray]:
    """Characters and words of each line, and the parities of both; a few lines' characters are in memory."""
    out = []
    piece: list[str] = []
    size = 0
    for k, line in enumerate(lines, 1):
        piece.append(line)
        size += len(line)
        if size > SIGN_CHARS or k == len(lines):
            with np.errstate(over="ignore"):
                text = _Text(piece)
            out.append((text.lens, text.n_words, _parities(text.chars, text.starts, text.lens),
                        _parities(text.words, text.w_starts, text.n_words)))
            piece, size = [], 0
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def linked(rows: pa.StructArray, ends: np.ndarray, tau: int,
           word_taus: tuple[tuple[int, int], ...] = WORD_TAUS) -> list[tuple[int, int, int, int, int]]:
    """Links within blocks, block k being ``rows`` from ``ends[k]`` up to
    ``ends[k + 1]``: rows that share a key, an indexed one with any, and
    no smaller key in that way (``segs`` and ``wins``: the smaller keys under
    which a row is indexed, or is not).  For every linked row its hashes, its
    number of links and the hashes of the smallest row that these links reach."""
    lines = rows.field("line").to_pylist()
    ids = list(zip(*(rows.field(c).to_pylist() for c in ("id", "h2")), strict=True))
    indexed, own, home = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("indexed", "own", "home"))
    lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in map(rows.field, ("segs", "wins"))]
    n_chars, n_words, by_char, by_word = _shapes(lines)
    few = n_words < word_taus[-1][0] if word_taus else np.ones(len(lines), bool)
    # every row meets those behind it in its block
    behind = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(lines)) - 1
    i = np.repeat(np.arange(len(lines)), behind)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(behind) - behind, behind)
    meet = (indexed[i] | indexed[j]) & (home[j] | (own[i] != own[j]))
    i, j = i[meet], j[meet]
    # net insertions flip one bit each, every other edit two
    chars = few[i] & few[j] & (np.bitwise_count(by_char[i] ^ by_char[j]) <= 2 * tau - np.abs(n_chars[i] - n_chars[j]))
    may = word_tau(np.minimum(n_words[i], n_words[j]), word_taus)
    whole = np.bitwise_count(by_word[i] ^ by_word[j]) <= 2 * may - np.abs(n_words[i] - n_words[j])
    part = list(range(len(lines)))
    n_links = [0] * len(lines)
    smaller: dict[int, tuple[set[int], set[int]]] = {}
    words: dict[int, list[str]] = {}

    def top(r: int) -> int:
        while part[r] != r:
            part[r] = r = part[part[r]]
        return r

    def keys(r: int) -> tuple[set[int], set[int]]:
        if r not in smaller:
            smaller[r] = tuple(set(values[ends[r]:ends[r + 1]].tolist()) for ends, values in lists)
        return smaller[r]

    def words_of(r: int) -> list[str]:
        if r not in words:
            words[r] = _WORDS.findall(lines[r])
        return words[r]

    take = np.flatnonzero(chars | whole)
    for a, b, char, word, t in zip(*(x[take].tolist() for x in (i, j, chars, whole, may)), strict=True):
        (sa, wa), (sb, wb) = keys(a), keys(b)
        if not (sa.isdisjoint(sb) and sa.isdisjoint(wb) and wa.isdisjoint(sb)):
            continue
        if (word and within(words_of(a), words_of(b), t)) or (char and within(lines[a], lines[b], tau)):
            n_links[a] += 1
            n_links[b] += 1
            part[top(a)] = top(b)
    out = [r for r, n in enumerate(n_links) if n]
    least: dict[int, tuple[int, int]] = {}
    for r in out:
        t = top(r)
        least[t] = min(least.get(t, ids[r]), ids[r])
    return [(*ids[r], n_links[r], *least[top(r)]) for r in out]


def line_classes(docs: DataFrame, stage: Stage, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row a line: doc_id, text_hash, line_no, class_doc_id, class_line_no
    (the first line of its class), n_links (links of its text to different
    texts) and kept."""
    lines = lines_of(docs)
    h1, h2 = _hashes(F.col("line"))
    places = stage.put(lines.select("doc_id", "text_hash", "line_no", h1, h2,
                                    (_has_chars("line", min_chars) | F.col("line").rlike(WORD)).alias("long")),
                       "places")
    links = stage.put(edit_links(lines, stage, tau, min_chars, n_lines=places.where("long").count()), "links")
    degree = links.groupBy("h1", "h2").agg(F.sum("n_links").alias("n_links"))
    degree = degree.withColumn("node", _node("h1", "h2"))
    joins = links.where("h1 <> r1 or h2 <> r2").select(_node("h1", "h2").alias("a"), _node("r1", "r2").alias("b"))
    root = connected_components(joins, stage).join(degree, "node").select("h1", "h2", "root", "n_links")
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash", "line_no")
    # a very common line is one key: its places come down to one a task before they are dealt out by it
    first = (places.where("long").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(order).alias("first"))
             .join(root, ["h1", "h2"], "left")
             # a text with one place and no link is a class of its own; the others are few
             .where("n > 1 or n_links > 0").select("h1", "h2", "root", "n_links", "first"))
    first = stage.put(first, "first")
    best = first.where("root is not null").groupBy("root").agg(F.min("first").alias("c"))
    texts = first.join(best, "root").select("h1", "h2", "n_links", "c").unionByName(
        first.where("root is null").select("h1", "h2", F.lit(0).cast("long").alias("n_links"), F.col("first").alias("c")))
    out = places.join(texts.withColumn("long", F.lit(True)), ["h1", "h2", "long"], "left")
    own = (F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("text_hash") == F.col("c.text_hash"))
           & (F.col("line_no") == F.col("c.line_no")))
    return out.select(
        "doc_id", "text_hash", F.col("line_no").cast("long").alias("line_no"),
        F.when(F.col("c").isNotNull(), F.col("c.doc_id")).otherwise(F.col("doc_id")).alias("class_doc_id"),
        F.coalesce("c.line_no", "line_no").cast("long").alias("class_line_no"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("c").isNull() | own).alias("kept"))


def drop_duplicate_lines(docs: DataFrame, stage: Stage, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the lines that repeat an earlier one; a document
    left with no line that holds a word goes.  Columns stay as they are."""
    drop = (line_classes(docs, stage, tau, min_chars).where("not kept")
            .groupBy("doc_id", "text_hash").agg(F.collect_set(F.col("line_no").cast("long")).alias("drop")))
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    drop = drop.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "drop")
    both = row.join(drop, row.doc_id.eqNullSafe(drop.d) & (row.text_hash == drop.t), "left")
    # the lines are cut once and what stays is found by a hash set: linear in the lines of a text
    rest = F.expr("transform(array(split(row.text, '\n')), ls -> array_join(transform(array_except("
                  "sequence(bigint(0), bigint(size(ls) - 1)), drop), i -> ls[int(i)]), '\n'))[0]")
    both = both.withColumn("text", F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(rest))
    both = both.where(F.col("drop").isNull() | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    return both.select(*[F.col("text").cast(docs.schema["text"].dataType) if c == "text"
                         else F.col("row")[c].alias(c) for c in docs.columns])
