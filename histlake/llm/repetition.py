"""Quality rules by repetition coverage (operator 8).

Per text, the characters that lie inside repeated word n-grams (n from 5 to
10) and inside repeated lines are measured; a text is rejected when a share
is above its limit.  The n-grams of a whole batch of texts are compared by
rolling hashes in numpy: the hash of an n-gram is the hash of the (n-1)-gram
times a base plus the next word, so each length costs one vector step.

Edge cases: a null or empty text has no words, counts of 0 and fails the base
rule; windows never cross texts; texts shorter than a window have none of it;
repeated rows get equal results; other columns of the table are not touched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import SPACE, WORD, chunks, ship

_WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"

# Shares of the characters inside n-grams that came before, and of repeated
# lines and their characters.  Set so that one sentence said twice does not
# reject a short text (published limits go down to 0.10 for ten words, which does).
NGRAM_LIMITS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
DUP_LINE_LIMIT = 0.30
DUP_LINE_CHAR_LIMIT = 0.30
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ngram_coverage double, dup_line_chars long, kept boolean")


def _repeated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: the value occurs at least twice; and it occurred before."""
    n = len(hashes)
    any_, later = np.zeros(n, bool), np.zeros(n, bool)
    if n < 2:
        return any_, later
    # most n-grams are unique: a counting table drops them before the sort
    bits = max(10, int(n).bit_length() + 2)
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cand = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    if not len(cand):
        return any_, later
    order = cand[np.argsort(hashes[cand], kind="stable")]
    h = hashes[order]
    same = h[1:] == h[:-1]
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def _covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask of the words inside the n-grams that start at ``starts``."""
    edge = np.zeros(total + 1, np.int32)
    edge[:-1] += starts
    np.subtract.at(edge, np.minimum(np.flatnonzero(starts) + n, total), 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """The measures of each text, all texts of the list at once."""
    words: list[str] = []
    counts, symbols, dup_lines, dup_chars, line_n, line_chars = [], [], [], [], [], []
    for t in texts:
        ws = _WORDS.findall(t)
        words += ws
        counts.append(len(ws))
        symbols.append(sum(map(t.count, SYMBOLS)))
        seen: set[str] = set()
        dup = chars = real = all_chars = 0
        for line in t.split("\n"):
            if line.strip(SPACE):
                real += 1
                all_chars += len(line)
                if line in seen:
                    dup += 1
                    chars += len(line)
                else:
                    seen.add(line)
        dup_lines.append(dup)
        dup_chars.append(chars)
        line_n.append(real)
        line_chars.append(all_chars)
    total, n_docs = len(words), len(texts)
    n_words = np.array(counts, np.int64)
    doc = np.repeat(np.arange(n_docs), n_words)
    lens = np.fromiter(map(len, words), np.int64, total)
    word_chars = np.bincount(doc, lens, n_docs).astype(np.int64)
    one = np.fromiter(map(hash, words), np.int64, total).astype(np.uint64)
    one = (one ^ (one >> np.uint64(29))) * _MIX
    ends = np.cumsum(n_words)
    left = ends[doc] - np.arange(total)          # words of the text from here on
    salt = (doc.astype(np.uint64) + np.uint64(1)) * _MIX
    worst = np.zeros(n_docs)
    repeat_words = np.zeros(n_docs, np.int64)
    fails = np.zeros(n_docs, bool)
    rolling = one
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        for n in range(2, max(*NGRAM_LIMITS, REPEAT_WINDOW) + 1):
            if n > total:
                break
            rolling = rolling[:-1] * _BASE + one[n - 1:]
            if n not in NGRAM_LIMITS and n != REPEAT_WINDOW:
                continue
            at = np.flatnonzero(left[:total - n + 1] >= n)
            h = (rolling[at] ^ salt[at]) * _BASE
            h ^= h >> np.uint64(31)
            any_, later = _repeated(h * _MIX)
            if not any_.any():
                continue
            starts = np.zeros(total, bool)
            if n == REPEAT_WINDOW:
                starts[at[any_]] = True
                repeat_words = np.bincount(doc, _covered(starts, n, total), n_docs).astype(np.int64)
                starts[:] = False
            if n in NGRAM_LIMITS:
                starts[at[later]] = True
                inside = np.bincount(doc, lens * _covered(starts, n, total), n_docs)
                share = np.where(word_chars > 0, inside / word_chars, 0.0)
                worst = np.maximum(worst, share)
                fails |= share > NGRAM_LIMITS[n]
        dl, lc = np.array(dup_lines), np.array(line_chars)
        dc, ln = np.array(dup_chars), np.array(line_n)
        fails |= (ln > 0) & ((dl > DUP_LINE_LIMIT * ln) | (dc > DUP_LINE_CHAR_LIMIT * lc))
    base_failed = (n_words < MIN_WORDS) | (100 * repeat_words > REPEAT_PERCENT * n_words)
    return {"n_words": n_words, "word_chars": word_chars,
            "n_symbols": np.array(symbols, np.int64), "n_dup_lines": dl.astype(np.int64),
            "n_repeat_words": repeat_words, "base_failed": base_failed,
            "ngram_coverage": worst, "dup_line_chars": dc.astype(np.int64),
            "kept": ~base_failed & ~fails}


def repetition(text: Column) -> Column:
    """Struct of the measures and the verdict ``kept`` of a text column."""
    ship()
    names = [f.split()[0] for f in RESULT.split(", ")]

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        parts = [measure(c) for c in chunks(x.as_py() for x in texts)] or [measure([])]
        return pa.StructArray.from_arrays([pa.array(np.concatenate([p[k] for p in parts])) for k in names], names)

    return run(F.coalesce(text.cast("string"), F.lit("")))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows the rules keep, with all their columns."""
    return docs.where(repetition(F.col("text"))["kept"])
