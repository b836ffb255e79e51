r"""Ranked lexical search of many queries over shared subexpressions (operator 12).

Every item of a query table is ranked against all documents.  A term is a
maximal run of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]``, A-Z lower-cased; a
document's score for an item is the sum over the item's distinct terms of
weight(term) * saturation(term, document), all in integers but the weight's
logarithm.

Items share terms, so their sums share partial sums.  A block's items are
written as lists of terms, the most shared first, and pairs of neighbours
that several items have are replaced by a new symbol, again and again
(``share_terms``): a grammar, that is a graph in which a node's term set is
the union of its two children's, and every item is the union of few nodes.
Over a batch of documents each node's accumulator (its documents and their
partial sums) is computed once, from its children's, kept until its last use,
and items add up the accumulators of their nodes (``Accumulators``).

Jobs per block of items (about ``BLOCK_BYTES`` of item text; one block unless
the items are many): one pass over the texts that counts the block's terms,
one over these counts for document frequencies, one for the scores, in which
a task keeps its k best documents an item, and a window over tasks' bests.
N (documents with a term) and L (terms of all documents) cover all documents.

Edge cases: null or empty texts have no terms, are not counted in N and match
nothing; an item without terms has no rows; rows that repeat a doc_id are
documents of their own, and so are rows that repeat an item_id; among equal
scores a null doc_id comes last; a term counts once an item, however often it
stands there; no items or no documents give no rows.  Only doc_id and text,
item_id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import Stage

TOP = 10
BLOCK_BYTES = 4 << 20
BATCH_DOCS = 2048
LENGTH_PERCENT = 90
SATURATION = 8

# Every byte that no term holds becomes a space, A-Z become a-z.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


# -- sharing ---------------------------------------------------------------

def share_terms(lists: list[np.ndarray], n_terms: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Children (left, right) of the symbols from ``n_terms`` on, and each
    list's symbols.  A list holds a term once at most.

    In a round every pair of neighbours is counted; a pair that at least two
    lists have is replaced wherever no pair beside it is more frequent (ties:
    by symbols), so that replaced pairs never overlap.
    """
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    lens = np.array([len(x) for x in lists])
    # lists one behind the other, lists ascending by frequency rank first
    flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
    often = np.bincount(flat, minlength=n_terms)
    owner = np.repeat(np.arange(len(lists)), lens)
    flat = flat[np.lexsort((flat, -often[flat], owner))]
    left, right, top = [], [], n_terms
    while len(flat) > 1:
        key = flat[:-1] * (1 << 31) + flat[1:]
        inside = owner[:-1] == owner[1:]
        pairs, at, n = np.unique(key[inside], return_inverse=True, return_counts=True)
        rank = np.full(len(key), -1)
        order = np.empty(len(pairs), np.int64)
        order[np.lexsort((-pairs, n))] = np.arange(len(pairs))
        rank[inside] = np.where(n[at] > 1, order[at], -1)
        before, behind = np.concatenate([[-1], rank[:-1]]), np.concatenate([rank[1:], [-1]])
        chosen = (rank >= 0) & (rank > before) & (rank > behind)
        used, at, n = np.unique(key[chosen], return_inverse=True, return_counts=True)
        chosen[np.flatnonzero(chosen)[n[at] < 2]] = False
        used = used[n > 1]
        if not len(used):
            break
        left.append(used >> 31)
        right.append(used & ((1 << 31) - 1))
        where = np.flatnonzero(chosen)
        flat[where] = top + np.searchsorted(used, key[where])
        top += len(used)
        keep = np.ones(len(flat), bool)
        keep[where + 1] = False
        flat, owner = flat[keep], owner[keep]
    cuts = np.searchsorted(owner, np.arange(1, len(lists)))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right]), np.split(flat, cuts)


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """One block's items as a grammar over the block's terms."""
    rows = rows.sort_values("item")
    found: dict[bytes, int] = {}
    lists = [np.array([found.setdefault(t, len(found)) for t in dict.fromkeys(terms_of(text.encode()))], np.int64)
             for text in rows["text"]]
    left, right, tops = share_terms(lists, len(found))
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "terms": [list(found)], "left": [left.tolist()],
                         "right": [right.tolist()], "items": [rows["item"].tolist()],
                         "tops": [[t.tolist() for t in tops]]})


_PLAN = ("block int, terms array<binary>, left array<int>, right array<int>, items array<long>, "
         "tops array<array<int>>")


class Accumulators:
    """The nodes' partial sums over one batch of documents: each is made once,
    when first asked for, and forgotten after its last use."""

    def __init__(self, n_terms: int, left: np.ndarray, right: np.ndarray, tops: list[np.ndarray]):
        self.n_terms, self.left, self.right, self.tops = n_terms, left.tolist(), right.tolist(), tops
        self.uses = np.bincount(np.concatenate([left, right, *tops]).astype(np.int64),
                                minlength=n_terms + len(left))
        self.made = 0

    def batch(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int) -> Iterator[np.ndarray]:
        """Scores of all documents, for one item after the other.  ``term``
        ascends; a pair of term and document occurs once."""
        cuts = np.searchsorted(term, np.arange(self.n_terms + 1))
        uses = self.uses.copy()
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def of(node: int) -> tuple[np.ndarray, np.ndarray]:
            if node < self.n_terms:
                return doc[cuts[node]:cuts[node + 1]], value[cuts[node]:cuts[node + 1]]
            todo = [node]
            while todo:  # children first
                x = todo[-1]
                below = [c for c in (self.left[x - self.n_terms], self.right[x - self.n_terms])
                         if c >= self.n_terms and c not in kept]
                if x in kept or not below:
                    todo.pop()
                    if x not in kept:
                        kept[x] = self._join(taken(self.left[x - self.n_terms]),
                                             taken(self.right[x - self.n_terms]), n_docs)
                        self.made += 1
                else:
                    todo += below
            return kept[node]

        def taken(node: int) -> tuple[np.ndarray, np.ndarray]:
            out = of(node) if node < self.n_terms else kept[node]
            uses[node] -= 1
            if not uses[node]:
                kept.pop(node, None)
            return out

        for top in self.tops:
            total = np.zeros(n_docs, np.int64)
            for node in top.tolist():
                of(node)
                at, v = taken(node)
                total[at] += v
            yield total

    @staticmethod
    def _join(a, b, n_docs):
        if not len(a[0]) or not len(b[0]):
            return a if len(a[0]) else b
        total = np.zeros(n_docs, np.int64)
        total[a[0]] = a[1]
        total[b[0]] += b[1]
        at = np.flatnonzero(total)
        return at, total[at]


# -- jobs ------------------------------------------------------------------

def _counter(terms):
    """Batches of doc_id, text -> doc_id, n and the block's terms with their
    numbers of occurrences, ascending by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: k for k, t in enumerate(terms.value)}
        for batch in batches:
            for lo in range(0, len(batch), BATCH_DOCS):
                part = batch.slice(lo, BATCH_DOCS)
                keep, n, lens, at, tf = [], [], [], [], []
                for k, b in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    words = terms_of(b)
                    if words:
                        hits = np.array([i for i in map(known.get, words) if i is not None], np.int64)
                        hits, times = np.unique(hits, return_counts=True)
                        keep.append(k)
                        n.append(len(words))
                        lens.append(len(hits))
                        at.append(hits)
                        tf.append(times)
                flat = [pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int32)) for x in (at, tf)]
                offsets = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                     *[pa.ListArray.from_arrays(offsets, x) for x in flat]], ["doc_id", "n", "terms", "tfs"])

    return run


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list column without nulls."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _frequencies(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_lists(batch.column("terms"))[1], minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["term", "df"])

    return run


def _ranker(plan, n_docs: int, n_all: int, k: int):
    """Batches of doc_id, n, terms, tfs -> the task's k best documents an item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        graph = Accumulators(len(p["weights"]), p["left"], p["right"], p["tops"])
        best: list[list] = [[] for _ in p["items"]]  # heaps of (score, is not null, -doc_id)
        for batch in batches:
            for lo in range(0, len(batch), BATCH_DOCS):
                part = batch.slice(lo, BATCH_DOCS)
                ids = part.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                order = np.lexsort((ids, null))  # among equal scores the first stays
                lens, term = _lists(part.column("terms"))
                tf = _lists(part.column("tfs"))[1].astype(np.int64)
                n = part.column("n").to_numpy()
                m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // n_all
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                doc = np.repeat(place, lens)
                value = p["weights"][term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * np.repeat(m, lens)))
                by = np.argsort(term, kind="stable")
                for heap, total in zip(best, graph.batch(term[by], doc[by], value[by], len(order)), strict=True):
                    at = np.flatnonzero(total > (heap[0][0] - 1 if len(heap) == k else 0))
                    at = at[np.argsort(-total[at], kind="stable")[:k]]
                    for x in at.tolist():
                        row = order[x]
                        entry = (int(total[x]), not null[row], -int(ids[row]))
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        item = np.repeat(np.arange(len(best)), [len(h) for h in best])
        rows = [e for h in best for e in h]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(p["items"], np.int64)[item]), pa.array([e[0] for e in rows], pa.int64()),
             pa.array([-e[2] if e[1] else None for e in rows], pa.int64())], ["item", "score", "doc_id"])

    return run


def search(docs: DataFrame, items: DataFrame, stage: Stage, k: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: each item's ``k`` best
    documents with a score above 0, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = stage.put(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    plans = stage.put(rows.select("item", "text", F.expr(f"cast(pmod(xxhash64(item), {blocks}) as int)").alias("block"))
                      .groupBy("block").applyInPandas(_plan, _PLAN), "plans")
    found = None
    for b in range(blocks):
        plan = plans.where(F.col("block") == b).first()  # one block: bounded by block_bytes
        if plan is None or not plan["terms"]:
            continue
        words = spark.sparkContext.broadcast([bytes(t) for t in plan["terms"]])
        counts = stage.put(texts.mapInArrow(_counter(words), "doc_id long, n long, terms array<int>, tfs array<int>"),
                           "counts")
        n_docs, n_all = counts.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        weights = np.zeros(len(plan["terms"]), np.int64)
        df = counts.select("terms").mapInArrow(_frequencies(len(weights)), "term long, df long")
        df = df.groupBy("term").agg(F.sum("df").alias("df")).select(
            "term", F.expr(f"cast(floor(1000D * ln(({n_docs}D * 2 + 2) / (2D * df + 1))) as long)").alias("w"))
        for r in df.collect():  # the block's terms only
            weights[r["term"]] = r["w"]
        known = spark.sparkContext.broadcast(
            {"weights": weights, "left": np.array(plan["left"], np.int64), "right": np.array(plan["right"], np.int64),
             "tops": [np.array(t, np.int64) for t in plan["tops"]], "items": plan["items"]})
        part = counts.mapInArrow(_ranker(known, n_docs, n_all, k), "item long, score long, doc_id long")
        by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        part = stage.put(part.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k), "best")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item long, score long, doc_id long, rank int")
    return found.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
