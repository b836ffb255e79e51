"""Filter interaction audit by radix text tries (operator 11).

Five filters judge every document; the audit counts, per part (source) and
for all 120 orders of the filters, what each step keeps, removes and repeats.
Four filters look at the text alone (A: few words, B: few distinct words, C:
many capitals, D: a symbol); E fails a document whose text equals the text of
a smaller doc_id.  E is found on whole texts, not on hashes:

1. Each task inserts its texts into a compressed trie; an equal text ends at
   the same terminal.  The task writes one narrow row a document (its
   terminal, its part, the bits of A-D, which are computed once a terminal)
   and one row a terminal (the text and its smallest doc_id), so copies are
   reduced before anything is shuffled.
2. Texts are dealt out by ranges: all texts with one prefix.  A prefix whose
   distinct texts hold more bytes than a task's share is made longer, again
   and again, until it does not (``heavy_prefixes``); the others stay short.
3. A task inserts the whole texts of its ranges into one trie, whose terminals
   hold the smallest doc_id; a traversal returns it for every first-step
   terminal.  A document fails E when its doc_id is larger.
4. The masks are reduced to a count per part and mask (at most 32 a part);
   every figure follows from these counts.

Edge cases: a null text is the empty text; a null source is the part ``''``
and counted together with an empty one; a null doc_id is not smaller than any
and has none smaller, so it never fails E and lets none fail; rows that share
their doc_id and text do not fail each other, and a doc_id's label is good
(toxic) if any of its label rows says so; no documents give no rows.  Only
doc_id, text, source (documents) and doc_id, quality, toxic (labels) are read.
A task holds the distinct texts of its ranges: about ``RANGE_BYTES`` times
eight, or its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Stage

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = b"#$%&*|"
RANGE_BYTES = 1 << 20      # a range never holds more, unless it is one text
LEAST_RANGE = 64 << 10
HELD_BYTES = 16 << 20      # texts of a first-step trie before it is written out
FIRST_DEPTH = 4

_CAPITALS = bytes(range(65, 91))


def _common(a: bytes, s: int, b: bytes, t: int, n: int) -> int:
    """Length of the common prefix of ``a[s:s+n]`` and ``b[t:t+n]``."""
    done, step = 0, 16
    while done < n:
        step = min(step, n - done)
        if a[s + done:s + done + step] != b[t + done:t + done + step]:
            break
        done += step
        step *= 4
    else:
        return n
    while step > 1:  # the first difference lies within the next `step` bytes
        half = step // 2
        if a[s + done:s + done + half] == b[t + done:t + done + half]:
            done += half
            step -= half
        else:
            step = half
    return done


class _Node:
    __slots__ = ("edges", "terminal")

    def __init__(self):
        self.edges: dict[int, list] = {}   # first byte -> [text, start, end, node]
        self.terminal = -1


class RadixTrie:
    """Compressed trie of byte strings; edges refer to the inserted texts."""

    def __init__(self):
        self.root = _Node()
        self.n = 0

    def insert(self, text: bytes) -> int:
        """Number of the text's terminal (equal texts have one, counted from 0)."""
        node, at, end = self.root, 0, len(text)
        while at < end:
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = _Node()
                node.edges[text[at]] = [text, at, end, leaf]
                node = leaf
                break
            other, start, stop, below = edge
            size = stop - start
            same = _common(other, start, text, at, min(size, end - at))
            if same < size:
                mid = _Node()
                mid.edges[other[start + same]] = [other, start + same, stop, below]
                edge[2], edge[3] = start + same, mid
                below = mid
            node, at = below, at + same
        if node.terminal < 0:
            node.terminal = self.n
            self.n += 1
        return node.terminal

    def terminals(self) -> Iterator[int]:
        """Terminals in the order of their texts."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.terminal >= 0:
                yield node.terminal
            todo += [node.edges[b][3] for b in sorted(node.edges, reverse=True)]


def text_mask(text: bytes, points: int) -> int:
    """Bits of the filters A to D that the text fails (A is bit 0)."""
    words = text.split()  # of bytes: cuts at \x20 and \x09-\x0D only
    n = len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((n < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * n) << 1
            | (100 * capitals > MAX_CAPITAL_PERCENT * points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


_ROWS = "is_text boolean, rid long, doc_id long, part string, mask int, low long, text binary"


def _task_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, part, text -> a row a document and a row a distinct text."""
    task = TaskContext.get().partitionId()
    first = 0  # number of the trie's first terminal within the task
    trie, texts, lows, masks, held = RadixTrie(), [], [], [], 0

    def written() -> pa.RecordBatch:
        n = len(texts)
        none = pa.nulls(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([True] * n), pa.array([(task << 33) + first + k for k in range(n)], pa.int64()),
             none.cast(pa.int64()), none.cast(pa.string()), none.cast(pa.int32()),
             pa.array(lows, pa.int64()), pa.array(texts, pa.binary())],
            ["is_text", "rid", "doc_id", "part", "mask", "low", "text"])

    for batch in batches:
        ids, parts = batch.column("doc_id"), batch.column("part")
        text = batch.column("text")
        points = pc.utf8_length(text)
        for lo in range(0, len(text), 512):
            rids, bits = [], []
            for b, n, i in zip(text[lo:lo + 512].cast(pa.binary()).to_pylist(),
                               points[lo:lo + 512].to_pylist(), ids[lo:lo + 512].to_pylist(), strict=True):
                k = trie.insert(b)
                if k == len(texts):
                    texts.append(b)
                    lows.append(i)
                    masks.append(text_mask(b, n))
                    held += len(b) + 256
                else:
                    lows[k] = _least(lows[k], i)
                rids.append((task << 33) + first + k)
                bits.append(masks[k])
            n = len(rids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * n), pa.array(rids, pa.int64()), ids[lo:lo + 512], parts[lo:lo + 512],
                 pa.array(bits, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                ["is_text", "rid", "doc_id", "part", "mask", "low", "text"])
            if held > HELD_BYTES:
                yield written()
                first += len(texts)
                trie, texts, lows, masks, held = RadixTrie(), [], [], [], 0
    if texts:
        yield written()


def _range_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid, low, text -> rid and the smallest doc_id of its text.  The task
    has all rows of its ranges, so one trie holds them."""
    trie, lows, rids = RadixTrie(), [], []
    for batch in batches:
        for rid, low, text in zip(batch.column("rid").to_pylist(), batch.column("low").to_pylist(),
                                  batch.column("text").to_pylist(), strict=True):
            k = trie.insert(text)
            if k == len(lows):
                lows.append(low)
                rids.append([rid])
            else:
                lows[k] = _least(lows[k], low)
                rids[k].append(rid)
    out_rid, out_low = [], []
    for k in trie.terminals():
        out_rid += rids[k]
        out_low += [lows[k]] * len(rids[k])
        if len(out_rid) >= 1 << 16:
            yield pa.RecordBatch.from_arrays([pa.array(out_rid, pa.int64()), pa.array(out_low, pa.int64())],
                                             ["rid", "low"])
            out_rid, out_low = [], []
    yield pa.RecordBatch.from_arrays([pa.array(out_rid, pa.int64()), pa.array(out_low, pa.int64())], ["rid", "low"])


def heavy_prefixes(texts: DataFrame, limit: int, stage: Stage, depth: int = FIRST_DEPTH) -> list[tuple[int, DataFrame]]:
    """(depth, prefixes) for every depth at which some prefix is too heavy:
    it stands before more than one distinct text, which hold more than
    ``limit`` bytes together.  Depths double; three are weighed in one pass."""
    found = []
    live = texts.select("text")
    while True:
        depths = [depth, 2 * depth, 4 * depth]
        cut = F.array(*[F.struct(F.lit(d).alias("depth"), F.substring("text", 1, d).alias("prefix")) for d in depths])
        cells = live.select(F.xxhash64("text").alias("h"), F.length("text").alias("n"), F.explode(cut).alias("c"))
        heavy = (cells.groupBy("c.depth", "c.prefix", "h").agg(F.max("n").alias("n"))
                 .groupBy("depth", "prefix").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
                 .where(f"n > {int(limit)} and k > 1").select("depth", "prefix"))
        heavy = stage.put(heavy, f"heavy{depth}")
        at = {r["depth"] for r in heavy.select("depth").distinct().collect()}
        found += [(d, heavy.where(F.col("depth") == d).select("prefix")) for d in depths if d in at]
        if depths[-1] not in at:
            return found
        live = texts.select("text", F.substring("text", 1, depths[-1]).alias("prefix")).join(
            found[-1][1], "prefix", "left_semi").select("text")
        depth *= 8


def text_ranges(texts: DataFrame, limit: int, stage: Stage) -> DataFrame:
    """``texts`` with ``range``: the shortest prefix that is not too heavy."""
    deepest = F.lit(FIRST_DEPTH)
    out = texts
    # a prefix can only be heavy where its own prefixes are
    for d, heavy in heavy_prefixes(texts, limit, stage):
        cut = F.substring("text", 1, d)
        out = out.join(heavy.select(F.col("prefix").alias(f"p{d}")), cut == F.col(f"p{d}"), "left")
        deepest = F.when(F.col(f"p{d}").isNotNull(), 2 * d).otherwise(deepest)
    return out.select(*texts.columns, F.col("text").substr(F.lit(1), deepest).alias("range"))


def document_masks(docs: DataFrame, stage: Stage) -> DataFrame:
    """doc_id, part and mask (bit k: the k-th filter fails) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = stage.put(rows.mapInArrow(_task_tries, _ROWS), "tries")
    texts = rows.where("is_text").select("rid", "low", "text")
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * RANGE_BYTES)))
    limit = min(RANGE_BYTES, max(LEAST_RANGE, total // (8 * tasks)))
    ranged = text_ranges(texts, limit, stage).repartition(tasks, "range").select("rid", "low", "text")
    lows = ranged.mapInArrow(_range_tries, "rid long, low long")
    marked = rows.where("not is_text").select("rid", "doc_id", "part", "mask").join(lows, "rid")
    later = F.coalesce((F.col("doc_id") > F.col("low")), F.lit(False)).cast("int")
    return marked.select("doc_id", "part", (F.col("mask") + 16 * later).alias("mask"))


def _sum(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).cast("long")


def interaction(masks: DataFrame) -> DataFrame:
    """The audit of ``masks(part, mask, n, good, toxic)``, one row a part,
    order and step."""
    spark = masks.sparkSession
    pairs = [(f, before) for f in range(5) for before in range(32) if not before >> f & 1]
    at = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(b).alias("before")) for f, b in pairs]))
    cells = masks.select("*", at.alias("x")).select("part", "mask", "n", "good", "toxic", "x.f", "x.before",
                                                    F.expr("shiftleft(1, x.f)").alias("bit"))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    # of the 120 orders each failed filter comes first in an equal share
    share = F.when(fails, F.col("n") * F.expr("div(120, bit_count(mask))")).otherwise(F.lit(0))
    figures = cells.groupBy("part", "f", "before").agg(
        _sum(~fails & ~gone, "n").alias("kept"), _sum(fails & ~gone, "n").alias("removed"),
        _sum(fails & gone, "n").alias("redundant"), _sum(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        _sum(fails & ~gone, "good").alias("good_lost"), _sum(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(share).cast("long").alias("shapley"))
    steps = [("".join(FILTERS[f] for f in order), k + 1, f, sum(1 << g for g in order[:k]))
             for order in permutations(range(5)) for k, f in enumerate(order)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, f int, before int")  # 600 rows, always
    return figures.join(F.broadcast(steps), ["f", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")


def audit(docs: DataFrame, labels: DataFrame, stage: Stage) -> DataFrame:
    """The interaction of the five filters over ``docs``, with what they cost
    in labelled documents."""
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    masks = document_masks(docs, stage).join(said, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return interaction(stage.put(masks, "masks"))
