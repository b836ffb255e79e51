r"""N-gram Jaccard join by a blocked sparse matrix product (operator 13).

Rows of the matrix are documents, columns are word n-grams (hashed to 64
bits); the product with its transpose holds the overlaps.  Two documents
link when ``100 * overlap >= percent * union``.  Texts with one set of n-grams
are one row (a class): its key is the set's size and 64 bits over the set.

1. Incidences go out in blocks (rows of one task x a range of columns), packed
   as arrays.  A task has all of its columns: columns that one class has alone
   add nothing to any overlap and end here; for the others the number of
   classes is known, and they go back to their rows.
2. Size-derived bounds discard rows.  A link needs an overlap of
   ``ceil(percent / 100 * size)`` at least, so a class whose shared columns are
   fewer has none, and of the ``size - need + 1`` rarest columns one must be
   common (ranked by number of classes, then hash: the same order for all).
   Where those are columns of its own the class is done as well.
3. What is left is grouped: classes that have one of these rarest columns in
   common, and sizes that allow a link, belong to one group (connected
   components over the first class of each column and band of size).  Linked classes are always in
   one group.  A group goes in blocks of bounded rows and bytes, made within
   bands of size; a block meets itself, the other blocks of its band and those
   of the next band, as one task's unit each.
4. ``Overlaps`` forms a block's product: columns few rows have as pairs, the
   others as dense slices, accumulating overlaps; pairs that cannot reach their
   bound with the columns still to come are discarded in between.  A block
   returns a star a connected part, and each row's number of links.

Edge cases: null and empty texts and texts without words have no n-grams and
link with nothing; fewer words than an n-gram make one n-gram; repeated rows
are documents of one class; a null doc_id is the smallest of its component
only if all are null; no documents give no rows; only doc_id and text are read.
An n-gram's hash stands for it: two different ones of one document pair agree
with a probability of 2**-64 a pair of n-grams, and two sets of one size with
2**-64 a pair of sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Stage, connected_components, py_lower_ascii

NGRAM = 4
PERCENT = 85
SEED = 42
BLOCK_TEXT = 8 << 20       # characters of a row block
BLOCK_ROWS = 512           # classes of a product block
BLOCK_CELLS = 1 << 20      # shared columns of a product block, or one class's
FEW = 8                    # rows of a column that goes as pairs
TASK_BYTES = 24 << 20

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _WordHashes(dict):
    """Hash of a word, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def ngrams(text: str | None, words: _WordHashes, n: int = NGRAM) -> np.ndarray:
    """Sorted hashes of the text's distinct n-grams."""
    tokens = py_lower_ascii(text or "").encode().split()  # of bytes: at \x20 and \x09-\x0D
    if not tokens:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h * _ODD[2]) + _mixed(w[i:len(w) - k + 1 + i] + np.uint64(i))
    return np.unique(_mixed(h))


def need(size, percent: int = PERCENT):
    """Smallest overlap with which a set of this size can link."""
    return -(-size * percent // 100)


# -- packed blocks -----------------------------------------------------------
# A packed row: `n` classes with `counts[k]` columns each; lists lie one after the other.

_PACKED = "at int, doc_ids binary, keys binary, counts binary, cols binary, freqs binary"
_KEY = np.dtype([("size", np.uint32), ("hash", np.uint64)])  # 12 bytes
_ID = np.dtype([("null", np.bool_), ("id", np.int64)])


def _pack(at: int, keys, counts, cols, freqs=None, doc_ids=None) -> dict:
    narrow = np.uint8 if not len(counts) or counts.max() < 256 else np.uint32
    return {"at": at, "doc_ids": None if doc_ids is None else doc_ids.tobytes(), "keys": keys.tobytes(),
            "counts": counts.astype(narrow).tobytes(), "cols": cols.tobytes(),
            "freqs": None if freqs is None else freqs.astype(np.uint32).tobytes()}


def _counts(row: dict) -> np.ndarray:
    wide = len(row["counts"]) * _KEY.itemsize != len(row["keys"])
    return np.frombuffer(row["counts"], np.uint32 if wide else np.uint8).astype(np.int64)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"at": pa.int32()}
    names = ["at", "doc_ids", "keys", "counts", "cols", "freqs"]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.binary())) for c in names], names)


def _flat(parts: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _row_blocks(columns: int, n: int):
    """Batches of doc_id, text -> packed incidences by range of columns
    (``at`` >= 0) and packed documents (``at`` < 0: dealt out anyhow)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _WordHashes(), set()
        turn = 0
        ids, doc_keys, keys, sets, held = [], [], [], [], 0

        def written() -> Iterator[pa.RecordBatch]:
            nonlocal turn
            turn += 1
            docs = np.array([(i is None, i or 0) for i in ids], _ID)
            yield _batch([_pack(-1 - (turn * 7919 + docs.size) % columns, np.array(doc_keys, _KEY), np.zeros(0),
                                np.zeros(0), doc_ids=docs)])
            if not sets:
                return
            size = np.array([len(s) for s in sets])
            flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            at = ((flat >> np.uint64(32)) * np.uint64(columns) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            flat, row, at = flat[order], row[order], at[order]
            key = np.array(keys, _KEY)
            cuts = np.flatnonzero(np.diff(at)) + 1
            out = []
            for lo, hi in zip([0, *cuts], [*cuts, len(at)], strict=True):
                mine, counts = np.unique(row[lo:hi], return_counts=True)
                out.append(_pack(int(at[lo]), key[mine], counts, flat[lo:hi]))
            for lo in range(0, len(out), 64):
                yield _batch(out[lo:lo + 64])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                cols = ngrams(text, words, n)
                key = (len(cols), xxhash.xxh3_64_intdigest(cols.tobytes(), SEED) if len(cols) else 0)
                ids.append(i)
                doc_keys.append(key)
                held += len(text or "") + 64
                if len(cols) and key not in seen:  # copies in a task go out once
                    if len(seen) > 1 << 20:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    sets.append(cols)
                if held > BLOCK_TEXT:
                    yield from written()
                    ids, doc_keys, keys, sets, held = [], [], [], [], 0
        if ids:
            yield from written()

    return run


def _shared_columns(homes: int):
    """Packed incidences of whole columns -> those of columns that more than
    one class has, packed by home of the class, with the number of classes.
    Packed documents pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, cols = [], [], []
        for batch in batches:
            rows = batch.to_pylist()
            docs = [r for r in rows if r["at"] < 0]
            if docs:
                yield _batch([r | {"at": -1} for r in docs])
            for r in rows:
                if r["at"] >= 0:
                    keys.append(r["keys"])
                    counts.append(_counts(r))
                    cols.append(r["cols"])
        if not cols:
            return
        key = _flat(keys, _KEY)
        owner = np.repeat(np.arange(len(key)), np.concatenate(counts))
        col = _flat(cols, np.uint64)
        del keys, counts, cols
        order = np.argsort(col, kind="stable")
        col, owner = col[order], owner[order]
        same = col[1:] == col[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        col, owner = col[keep], owner[keep]
        # the same class from several tasks counts once
        order = np.lexsort((key["hash"][owner], key["size"][owner], col))
        col, owner = col[order], owner[order]
        twin = np.zeros(len(col), bool)
        twin[1:] = (col[1:] == col[:-1]) & (key[owner[1:]] == key[owner[:-1]])
        col, owner = col[~twin], owner[~twin]
        if not len(col):
            return
        start = np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1]]))
        freq = np.repeat(np.diff(np.concatenate([start, [len(col)]])), np.diff(np.concatenate([start, [len(col)]])))
        col, owner, freq = col[freq > 1], owner[freq > 1], freq[freq > 1]
        if not len(col):
            return
        home = (key["hash"][owner] % np.uint64(homes)).astype(np.int64)
        order = np.lexsort((key["hash"][owner], key["size"][owner], home))
        col, owner, freq, home = col[order], owner[order], freq[order], home[order]
        cuts = np.flatnonzero(np.diff(home)) + 1
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, len(home)], strict=True):
            k = key[owner[lo:hi]]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            out.append(_pack(int(home[lo]), k[first], np.diff(np.concatenate([first, [hi - lo]])), col[lo:hi],
                             freq[lo:hi]))
        for lo in range(0, len(out), 64):
            yield _batch(out[lo:lo + 64])

    return run


def _candidates(percent: int):
    """All shared columns of a home's classes -> the classes that can link,
    with their shared columns (ascending) and the rarest of them, of which a
    linked class has one too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: [] for c in ("keys", "cols", "freqs")}
        counts = [np.zeros(0, np.int64)]
        for batch in batches:
            counts += [_counts(r) for r in batch.select(["keys", "counts"]).to_pylist()]
            for c, parts in held.items():
                parts += batch.column(c).to_pylist()
        key = _flat(held["keys"], _KEY)
        owner = np.repeat(np.arange(len(key)), np.concatenate(counts))
        col, freq = _flat(held["cols"], np.uint64), _flat(held["freqs"], np.uint32)
        held.clear()
        order = np.lexsort((col, freq, key["hash"][owner], key["size"][owner]))
        col, owner = col[order], owner[order]
        k = key[owner]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        for lo in range(0, len(first), 1024):
            out = {"hash": [], "size": [], "cols": [], "rarest": []}
            for a, b in zip(first[lo:lo + 1024], [*first[lo + 1:lo + 1024], first[lo + 1024] if lo + 1024 < len(first)
                                                  else len(k)], strict=True):
                n = int(k["size"][a])
                own = n - (b - a)                    # columns no other class has: the rarest of all
                prefix = n - need(n, percent) + 1
                if own < prefix:
                    out["hash"].append(k["hash"][a])
                    out["size"].append(n)
                    out["rarest"].append(col[a:a + prefix - own].view(np.int64))
                    out["cols"].append(np.sort(col[a:b]).tobytes())
            if out["size"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(out["hash"], np.uint64).view(np.int64)), pa.array(out["size"], pa.int64()),
                     pa.array(out["cols"], pa.binary()), pa.array(out["rarest"], pa.list_(pa.int64()))],
                    ["hash", "size", "cols", "rarest"])

    return run


# -- the product -------------------------------------------------------------

class Overlaps:
    """Overlaps of the rows of one block, accumulated over slices of columns.
    ``sizes`` are the rows' whole sizes, ``sets`` their shared columns; with
    ``side`` only pairs across the two sides count."""

    def __init__(self, sizes: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None,
                 percent: int = PERCENT):
        n = len(sizes)
        self.overlap = np.zeros((n, n), np.int64)
        # 100 * I >= p * (a + b - I)
        self.bound = -(-percent * (sizes[:, None] + sizes) // (100 + percent))
        low = np.minimum(sizes[:, None], sizes)
        self.alive = np.triu(self.bound <= low, 1)
        if side is not None:
            self.alive &= side[:, None] != side
        self.left = np.array([len(s) for s in sets])
        self._discard()
        self._multiply(sets)

    def _discard(self) -> None:
        """Pairs that cannot reach their bound with the columns to come go."""
        self.alive &= self.overlap + np.minimum(self.left[:, None], self.left) >= self.bound

    def _multiply(self, sets: list[np.ndarray]) -> None:
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
        row = np.repeat(np.arange(len(sets)), self.left)
        order = np.argsort(flat, kind="stable")
        flat, row = flat[order], row[order]
        start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([start, [len(flat)]]))
        for c in range(2, FEW + 1):  # few rows: their pairs
            at = start[times == c]
            for i in range(c):
                for j in range(i + 1, c):  # rows of a column ascend
                    np.add.at(self.overlap, (row[at + i], row[at + j]), 1)
        few = np.repeat(times <= FEW, times)
        self.left = self.left - np.bincount(row[few], minlength=len(sets))
        self._discard()
        row = row[~few]
        col = np.repeat(np.arange((times > FEW).sum()), times[times > FEW])
        for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 1024):
            a, b = np.searchsorted(col, [lo, lo + 1024])
            rows = np.flatnonzero(self.alive.any(axis=0) | self.alive.any(axis=1))
            if not len(rows):
                return
            place = np.full(len(sets), -1)
            place[rows] = np.arange(len(rows))
            dense = np.zeros((len(rows), min(1024, int(col[-1]) + 1 - lo)), np.float32)
            ok = place[row[a:b]] >= 0
            dense[place[row[a:b]][ok], col[a:b][ok] - lo] = 1
            self.overlap[np.ix_(rows, rows)] += (dense @ dense.T).astype(np.int64)
            self.left = self.left - np.bincount(row[a:b], minlength=len(sets))
            self._discard()

    def links(self) -> np.ndarray:
        """Symmetric matrix of the linked rows."""
        linked = self.alive & (self.overlap >= self.bound)
        return linked | linked.T


def _stars(linked: np.ndarray) -> np.ndarray:
    """For each row the first row it is connected with."""
    root = np.full(len(linked), -1)
    for s in range(len(linked)):
        if root[s] < 0:
            root[s] = s
            todo = np.array([s])
            while len(todo):
                todo = np.flatnonzero(linked[todo].any(axis=0) & (root < 0))
                root[todo] = s
    return root


def _products(percent: int):
    """Rows (unit, side, id, times, size, cols) sorted by unit -> id, root and
    links of every row that has links in its unit."""
    def one(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        ids, times, sizes = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 4))
        side = np.array([r[1] for r in rows])
        linked = Overlaps(sizes, [np.frombuffer(r[5], np.uint64) for r in rows],
                          side if (side > 0).any() else None, percent).links()
        at = np.flatnonzero(linked.any(axis=1))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(ids[_stars(linked)[at]]), pa.array((linked[at] * times).sum(axis=1))],
                ["id", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("unit", "side", "id", "times", "size", "cols")],
                         strict=True):
                if r[0] != unit:
                    yield from one(rows)
                    unit, rows = r[0], []
                rows.append(r)
        yield from one(rows)

    return run


def _units(rows: DataFrame, band, shuffle: int) -> DataFrame:
    """``rows`` (group, id, times, size, cols) dealt to blocks and each block to
    the units in which it meets others: (unit, side, id, times, size, cols).

    A group of few rows and columns is one block; others are cut by band of
    size, and a band of many by hash.  Pairs of neighbouring bands meet once.
    """
    cells = F.length("cols") / 8
    whole = rows.groupBy("group").agg(F.count("*").alias("n"), F.sum(cells).alias("c"))
    fits = (F.col("n") <= BLOCK_ROWS) & (F.col("c") <= BLOCK_CELLS)
    rows = rows.join(whole.select("group", fits.alias("small")), "group")
    small = rows.where("small").select(F.struct("group", F.lit(-1).alias("b"), F.lit(0).alias("i"),
                                                F.lit(0).alias("b2"), F.lit(0).alias("j")).alias("unit"),
                                       F.lit(0).alias("side"), "id", "times", "size", "cols")
    large = rows.where("not small").withColumn("band", band)
    parts = large.groupBy("group", "band").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(cells) / BLOCK_CELLS)).cast("int").alias("parts"))
    near = (parts.join(parts.select("group", (F.col("band") - 1).alias("band"), F.col("parts").alias("up")),
                       ["group", "band"], "left")
            .join(parts.select("group", (F.col("band") + 1).alias("band"), F.col("parts").alias("down")),
                  ["group", "band"], "left").na.fill(0, ["up", "down"]))
    large = large.join(near, ["group", "band"]).withColumn(
        "own", F.expr("cast(pmod(xxhash64(id), parts) as int)"))
    met = F.expr("""concat(
        transform(sequence(0, parts - 1), x -> struct(band as b, least(own, x) as i, band as b2, greatest(own, x) as j,
                                                      cast(own > x as int) as side)),
        if(up > 0, transform(sequence(0, up - 1), x -> struct(band as b, own as i, band + 1 as b2, x as j, 0 as side)),
           array()),
        if(down > 0, transform(sequence(0, down - 1), x -> struct(band - 1 as b, x as i, band as b2, own as j,
                                                                  1 as side)), array()))""")
    large = large.select("group", F.explode(met).alias("m"), "id", "times", "size", "cols").select(
        F.struct("group", "m.b", "m.i", "m.b2", "m.j").alias("unit"), "m.side", "id", "times", "size", "cols")
    return small.union(large).repartition(shuffle, "unit").sortWithinPartitions("unit")


# -- jobs --------------------------------------------------------------------

def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed documents -> doc_id, size, hash."""
    for batch in batches:
        for r in batch.select(["doc_ids", "keys"]).to_pylist():
            ids, keys = np.frombuffer(r["doc_ids"], _ID), np.frombuffer(r["keys"], _KEY)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids["id"].copy(), mask=ids["null"]), pa.array(keys["size"].astype(np.int64)),
                 pa.array(keys["hash"].copy().view(np.int64))], ["doc_id", "size", "hash"])


def _neighbours(able: DataFrame, stage: Stage) -> DataFrame:
    """Edges (a, b) that connect the classes ``able(id, band, rarest)`` with a
    rare column in common and sizes in one band or in bands side by side: each
    class with the first of its column and band, and these across bands."""
    keyed = able.select("id", F.explode("rarest").alias("col"), "band")
    first = stage.put(keyed.groupBy("col", "band").agg(F.min("id").alias("first")), "first")
    own = keyed.join(first, ["col", "band"]).where("id <> first").select(F.col("id").alias("a"),
                                                                         F.col("first").alias("b"))
    up = first.select("col", (F.col("band") - 1).alias("band"), F.col("first").alias("b"))
    across = first.join(up, ["col", "band"]).where("first <> b").select(F.col("first").alias("a"), "b")
    return own.union(across).distinct()


def components(docs: DataFrame, stage: Stage, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)
    and n_links (documents it links with, copies included) of every row."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(shuffle, -(-2 * total // TASK_BYTES))  # packed incidences: about twice the text

    out = texts.mapInArrow(_row_blocks(tasks, n), _PACKED)
    out = out.repartition(tasks, "at").mapInArrow(_shared_columns(tasks), _PACKED)
    out = stage.put(out, "columns")
    rows = stage.put(out.where("at < 0").mapInArrow(_documents, "doc_id long, size long, hash long"), "rows")
    classes = rows.where("size > 0").groupBy("size", "hash").agg(F.min("doc_id").alias("first"),
                                                                 F.count("*").alias("times"))
    able = out.where("at >= 0").repartition(tasks, "at").mapInArrow(
        _candidates(percent), "hash long, size long, cols binary, rarest array<long>")
    able = stage.put(able.withColumn("id", F.monotonically_increasing_id()), "able")

    width = math.log(100 / percent) if percent < 100 else 1e-9
    band = F.floor(F.log(F.col("size")) / F.lit(width)).cast("int")
    roots = connected_components(_neighbours(able.select("id", band.alias("band"), "rarest"), stage), stage).select(
        F.col("node").alias("id"), F.col("root").alias("group"))
    times = able.select("id", "size", "hash").join(classes, ["size", "hash"]).select(
        "id", "size", "hash", "first", "times")
    times = stage.put(times, "classes")
    cells = able.select("id", "size", "cols").join(roots, "id").join(times.select("id", "times"), "id")
    found = stage.put(_units(stage.put(cells, "cells"), band, tasks).mapInArrow(
        _products(percent), "id long, root long, links long"), "links")

    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), stage).select(
        F.col("node").alias("id"), "root")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = times.join(parts, "id").join(counts, "id")
    low = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = linked.join(low, "root").select("size", "hash", "component_id", "links")
    known = classes.join(linked, ["size", "hash"], "left").select(
        "size", "hash", F.coalesce("component_id", "first").alias("component_id"),
        (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    some = rows.where("size > 0").join(known, ["size", "hash"])
    none = rows.where("size = 0").withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
    cols = ["doc_id", F.col("size").alias("n_shingles"), "component_id", "n_links"]
    return some.select(cols).union(none.select(cols))
