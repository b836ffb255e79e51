"""Near-duplicate documents by SimHash and pivot distance tables (operator 6).

A text's fingerprint has bit b set when more than half of the hashes of its
word shingles have it set.  Documents are linked when their fingerprints
differ in at most ``max_bits`` bits; a component is what links reach.

Search.  A table of distances is computed once and staged: for every distinct
fingerprint its Hamming distances to ``PIVOTS`` reference fingerprints
(pivots), a byte each.  The pivots are taken from the fingerprints
themselves, out of the ``CANDIDATES`` smallest by hash, each as far as can be
from those before it, so that they lie in different regions and distances to
them spread.  Distances bound the distance of two fingerprints from below:
``|d(x, p) - d(y, p)| <= d(x, y)``; a pair is discarded by its largest
difference of coordinates before any fingerprint is looked at, and the
survivors are verified on the fingerprints.

Distances crowd around half the bits, so they cannot split the rows into
groups; the partition uses references whose distances do: unit references,
whose distance against the zero reference tells one bit.  They are dealt into
``max_bits + 3`` groups; ``max_bits`` differing bits leave at least three
groups alike, so linked rows agree on all coordinates of one choice of three
groups, which is the shuffle key.  A key with many rows is cut into blocks by
a hash and every pair of blocks is a task of its own; a block yields one edge
a row and component, never all its pairs.

Edge cases: a text without words (null, empty) has fingerprint zero and is
linked like any other; fewer words than a shingle make one shingle; equal
fingerprints (copies, repeated rows) are one node; a null doc_id never is the
smallest unless the whole component has none, then the id is null.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import WORD, Stage, connected_components, py_lower_ascii, ship

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: reference fingerprints of the distance table, a byte each; a multiple of 8
PIVOTS = 16
#: fingerprints the pivots are chosen from (brought to the driver)
CANDIDATES = 512
BLOCK = 1024

_WORDS = re.compile(WORD)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = _WORDS.findall(py_lower_ascii(text or ""))
    if not words:
        return 0
    if len(words) <= shingle:
        h = xxhash.xxh64_intdigest(" ".join(words), SEED)
        return h - (1 << 64) if h >> 63 else h
    n = len(words) - shingle + 1
    flat = " ".join(words).encode()
    lens = np.fromiter((len(w.encode()) for w in words), np.int64, len(words)) \
        if len(flat) != sum(map(len, words)) + len(words) - 1 \
        else np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        lo, hi = starts[at:to].tolist(), ends[at + shingle - 1:to + shingle - 1].tolist()
        h = np.fromiter((digest(flat[i:j], SEED) for i, j in zip(lo, hi, strict=True)), np.uint64, to - at)
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    out = int(np.packbits(2 * bits > n, bitorder="little").view(np.int64)[0])
    return out


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    ship()

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    return run(F.coalesce(text.cast("string"), F.lit("")))


def reference_groups(max_bits: int) -> list[list[int]]:
    """The 64 unit references, dealt into ``max_bits + 3`` groups of neighbours."""
    k = max_bits + 3
    cuts = [64 * i // k for i in range(k + 1)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def choose_pivots(candidates: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """``n`` of the candidates, each the farthest from those before it; a
    candidate counts as its complement too (its distances are 64 less those)."""
    if not len(candidates):
        return np.zeros(n, np.uint64)
    out = [candidates[0]]
    near = np.full(len(candidates), 64)
    while len(out) < n:
        d = np.bitwise_count(candidates ^ out[-1]).astype(int)
        near = np.minimum(near, np.minimum(d, 64 - d))
        out.append(candidates[int(near.argmax())])
    return np.array(out, np.uint64)


def pivots_of(prints: DataFrame, n: int = PIVOTS, candidates: int = CANDIDATES) -> np.ndarray:
    """Pivots for the fingerprints ``prints(fp)``."""
    rows = prints.select("fp", F.xxhash64("fp").alias("h")).orderBy("h", "fp").limit(candidates).collect()
    return choose_pivots(np.array([r.fp for r in rows], np.int64).view(np.uint64), n)


def distances(fp: Column, refs: np.ndarray) -> Column:
    """The table's columns: distances to eight references a long, a byte each."""
    ship()
    lanes = len(refs) // 8
    names = [f"d{i}" for i in range(lanes)]

    @F.arrow_udf(", ".join(f"{x} long" for x in names))
    def run(fps: pa.Array) -> pa.Array:
        x = fps.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        d = np.bitwise_count(x[:, None] ^ refs[None, :]).astype(np.uint8).reshape(len(x), lanes, 8)
        packed = np.ascontiguousarray(d).view(np.int64)[:, :, 0]
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(packed[:, i])) for i in range(lanes)], names)

    return run(fp)


def _far(left: np.ndarray, right: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether the largest difference of two rows' coordinates is above ``max_bits``."""
    return (np.maximum(left, right) - np.minimum(left, right)).max(axis=-1) > max_bits


def _stars(x: np.ndarray, table: np.ndarray, max_bits: int, left: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, node) that join what links reach among the rows ``x``."""
    near = np.triu(np.ones((len(x), len(x)), bool), 1)
    left["pairs"] += len(x) * (len(x) - 1) // 2
    for c in table.T:      # coordinate by coordinate: no block is wider than its pairs
        near &= np.maximum(c[:, None], c) - np.minimum(c[:, None], c) <= max_bits
    i, j = np.nonzero(near)
    left["compared"] += len(i)
    ok = np.bitwise_count(x[i] ^ x[j]) <= max_bits
    left["linked"] += int(ok.sum())
    near[:] = False
    near[i[ok], j[ok]] = near[j[ok], i[ok]] = True
    root = np.full(len(x), -1)
    for s in range(len(x)):
        if root[s] >= 0 or not near[s].any():
            continue
        root[s] = s
        todo = [s]
        while len(todo):
            fresh = np.flatnonzero(near[todo].any(axis=0) & (root < 0))
            root[fresh] = s
            todo = fresh
    node = np.flatnonzero((root >= 0) & (root != np.arange(len(x))))
    return x[root[node]], x[node]


def link_blocks(groups: list[tuple[np.ndarray, np.ndarray]], max_bits: int,
                left: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all groups (fingerprints, rows of the table); small groups of
    equal size are handled together.  ``left`` counts the pairs that each step
    leaves: pairs, compared, linked."""
    left = Counter() if left is None else left
    by_size: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    a, b = [], []
    for x, table in groups:
        if len(x) > 32:
            p, q = _stars(x, table, max_bits, left)
            a.append(p)
            b.append(q)
        elif len(x) > 1:
            by_size.setdefault(len(x), []).append((x, table))
    for n, same in by_size.items():
        i, j = np.triu_indices(n, 1)
        step = max(1, (1 << 18) // len(i))      # groups at once
        for at in range(0, len(same), step):
            x = np.stack([g for g, _ in same[at:at + step]])
            table = np.stack([t for _, t in same[at:at + step]])
            g, p = np.nonzero(~_far(table[:, i], table[:, j], max_bits))
            u, v = x[g, i[p]], x[g, j[p]]
            ok = np.bitwise_count(u ^ v) <= max_bits
            left.update(pairs=len(x) * len(i), compared=len(u), linked=int(ok.sum()))
            a.append(u[ok])
            b.append(v[ok])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def distance_table(prints: DataFrame, stage: Stage, n_pivots: int = PIVOTS) -> DataFrame:
    """(fp, d0, d1, ..) of the distinct fingerprints ``prints(fp)``, staged."""
    d = distances(F.col("fp"), pivots_of(prints, n_pivots))
    return stage.put(prints.select("fp", d.alias("d")).select("fp", "d.*"), "distances")


def fingerprint_edges(table: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect the fingerprints of a distance table."""
    row = table.columns
    groups = reference_groups(max_bits)
    choices = []
    for t, keep in enumerate(combinations(range(len(groups)), 3)):
        mask = sum(1 << bit for g in keep for bit in groups[g])
        mask -= (1 << 64) if mask >> 63 else 0
        choices.append(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")))
    keyed = table.select(*row, F.explode(F.array(*choices)).alias("c")).select(*row, "c.t", "c.key")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(shared, ["t", "key"])
    parts = F.ceil(F.col("n") / block).cast("int")
    met = met.withColumn("parts", parts).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int"))
    # every block meets every other once; a lone block meets itself
    met = met.withColumn("other", F.explode(F.expr(
        "case when parts = 1 then array(0) "
        "else filter(sequence(0, parts - 1), x -> x <> own) end")))
    lists = (met.groupBy("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
             .agg(F.collect_list(F.struct(*row)).alias("rows")).select("rows"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(0)
            fps, *lanes = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in col.flatten().flatten())
            fps = fps.view(np.uint64)
            table = np.stack(lanes, axis=1).view(np.uint8)
            at = np.concatenate([[0], np.cumsum(np.diff(col.offsets.to_numpy()))])
            a, b = link_blocks([(fps[i:j], table[i:j]) for i, j in zip(at, at[1:], strict=False)], max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return lists.mapInArrow(verify, "a long, b long").distinct()


def components_of(prints: DataFrame, stage: Stage, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component, component_id) of the distinct fingerprints of
    ``prints(doc_id, fp)``: the component's own key and its smallest doc_id."""
    nodes = stage.put(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    table = distance_table(nodes.select("fp"), stage)
    roots = connected_components(fingerprint_edges(table, max_bits), stage)
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("root", "fp"))
    low = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    return stage.put(nodes.join(low, "component").select("fp", "component", "component_id"), "components")


def components(docs: DataFrame, stage: Stage, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row."""
    prints = stage.put(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   fingerprints(F.col("text"), shingle).alias("fp")), "prints")
    return prints.join(components_of(prints, stage, max_bits), "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, stage: Stage, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: the smallest doc_id (null last), then
    the smallest text hash; of wholly repeated rows one stays."""
    keyed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"),
                        fingerprints(F.col("text"), shingle).alias("fp"))
    keyed = stage.put(keyed, "rows")
    rank = F.struct(F.col("row.doc_id").isNull().alias("x"), F.col("row.doc_id").alias("d"),
                    F.xxhash64("row.text").alias("h"), "at")
    narrow = keyed.select(F.col("row.doc_id").cast("long").alias("doc_id"), "fp", rank.alias("rank"))
    found = components_of(narrow, stage, max_bits)
    best = (narrow.groupBy("fp").agg(F.min("rank").alias("rank")).join(found, "fp")
            .groupBy("component").agg(F.min("rank").alias("rank")).select("rank.at"))
    return keyed.join(best, "at", "left_semi").select("row.*")
