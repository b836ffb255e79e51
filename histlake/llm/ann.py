"""Approximate nearest neighbours by randomly rotated one-bit codes (operator 2).

Vectors are centred on the mean, normalised and turned by a random rotation;
one bit a dimension says on which side of zero the turned component lies.
With the correction scalar ``<code, vector>`` kept beside the bits, the code
gives an unbiased estimate of the inner product with any query, and its error
is below ``eps * sqrt((1 - f^2) / f^2) / sqrt(dim - 1)`` with high
probability.  A vector is reranked on its original components when its lower
bound of the distance does not exceed the distance of the k-th best so far,
so what the estimate leaves open is settled exactly.

The queries are a stated set and go through all rows in blocks: a block of
queries of bounded size is broadcast, every task scans its codes and keeps
its ``k`` best a query, and the best of all tasks follow by one aggregation.

Edge cases: vectors that are null, empty, zero or hold a null or a value that
is not finite take no part, as query or candidate; only vectors of equal
length are compared; ties go to the smaller id; rows that repeat an id count
once, at their smallest distance; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import Stage

K = 10
EPS = 4.0
#: bytes of query components broadcast at once
QUERY_BLOCK_BYTES = 4 << 20
SEED = 42


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & ok & F.exists(vector, lambda x: x != 0)


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, correction scalar and norm of each row."""
    o = x - centre
    norm = np.sqrt((o * o).sum(axis=1))
    o = (o / np.where(norm > 0, norm, 1)[:, None]) @ turn
    bits = o >= 0
    scalar = np.abs(o).sum(axis=1) / np.sqrt(x.shape[1])     # <code, vector>, the code being +-1 / sqrt(dim)
    return np.packbits(bits, axis=1), scalar, norm


def search_block(q_id: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, bits: np.ndarray,
                 scalar: np.ndarray, norm: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int,
                 eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, distance) of each query's k best candidates."""
    dim = x.shape[1]
    qo = q - centre
    qn = np.sqrt((qo * qo).sum(axis=1))
    qt = (qo / np.where(qn > 0, qn, 1)[:, None]) @ turn
    code = (np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    f = np.maximum(scalar, 1e-12)
    estimate = (qt.astype(np.float32) @ code.T) / f.astype(np.float32)
    bound = eps * np.sqrt(np.maximum(1 - f * f, 0)) / f / np.sqrt(max(dim - 1, 1)) + 1e-6
    repeats = len(np.unique(ids)) < len(ids)
    at_q, at_x, dist = [], [], []
    for i in range(len(q)):
        both = 2 * qn[i] * norm
        base = norm * norm + qn[i] * qn[i]
        low = base - both * np.minimum(estimate[i] + bound, 1.0)
        low[ids == q_id[i]] = np.inf
        if repeats:  # the limit takes k different ids
            by = np.argsort(low, kind="stable")
            first = by[np.sort(np.unique(ids[by], return_index=True)[1])[:k]]
        else:
            first = np.argpartition(low, min(k, len(low)) - 1)[:k]
        some = len(first)
        d = x[first] - q[i]
        worst = np.max((d * d).sum(axis=1), where=ids[first] != q_id[i], initial=0.0)
        if some < k or np.isinf(low[first]).any():
            worst = np.inf
        cand = np.flatnonzero((low <= worst * (1 + 1e-9) + 1e-12) & (ids != q_id[i]))
        d = x[cand] - q[i]
        d = np.sqrt((d * d).sum(axis=1))
        order = np.lexsort((ids[cand], d))
        _, once = np.unique(ids[cand][order], return_index=True)   # a repeated id counts once
        best = order[np.sort(once)[:k]]
        at_q.append(np.full(len(best), i))
        at_x.append(cand[best])
        dist.append(d[best])
    empty = np.zeros(0, np.int64)
    return (np.concatenate([empty, *at_q]), np.concatenate([empty, *at_x]),
            np.concatenate([np.zeros(0), *dist]))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, stage: Stage, is_query: Column, k: int = K, eps: float = EPS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of every query row of
    ``vectors(vec_id, embedding)``."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    # the distinct lengths are few; each has its own centre, rotation and scan
    dims = [r.dim for r in rows.select("dim").distinct().collect()]
    found = None
    for dim in sorted(dims):
        same = rows.where(F.col("dim") == dim)
        centre = np.array(same.agg(*[F.avg(F.element_at("v", i + 1)) for i in range(dim)]).first(), np.float64)
        codes = stage.put(same.select("vec_id", "v").mapInArrow(_encoder(dim, centre), _CODES), f"codes{dim}")
        asked = stage.put(same.where("q").select("vec_id", "v").dropDuplicates(["vec_id", "v"]), f"queries{dim}")
        size = max(1, QUERY_BLOCK_BYTES // (8 * dim))
        blocks = -(-asked.count() // size)
        for b in range(blocks):
            part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
            got = part.toArrow()
            q_id = got.column("vec_id").to_numpy()
            q = _matrix(got.column("v").combine_chunks(), dim) if len(q_id) else np.zeros((0, dim))
            best = codes.mapInArrow(_scanner(dim, centre, q_id, q, k, eps),
                                    "query_id long, vec_id long, score double")
            best = stage.put(_top(best, k), f"found{dim}")
            found = best if found is None else found.union(best)
    if found is None:
        return stage.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return _top(found, k)


_CODES = "vec_id long, v array<double>, bits binary, scalar double, norm double"


def _top(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _encoder(dim: int, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim)
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            bits, scalar, norm = encode(x, centre, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([b.tobytes() for b in bits], pa.binary()),
                 pa.array(scalar), pa.array(norm)], ["vec_id", "v", "bits", "scalar", "norm"])
    return run


def _scanner(dim: int, centre: np.ndarray, q_id: np.ndarray, q: np.ndarray, k: int, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                ids = b.column(0).to_numpy()
                x = _matrix(b.column(1), dim)
                bits = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
                # the queries of one step bound the size of the table of estimates
                for lo in range(0, len(q_id), 1024):
                    i, j, d = search_block(q_id[lo:lo + 1024], q[lo:lo + 1024], ids, x, bits, b.column(3).to_numpy(),
                                           b.column(4).to_numpy(), centre, turn, k, eps)
                    yield pa.RecordBatch.from_arrays([pa.array(q_id[lo:lo + 1024][i]), pa.array(ids[j]), pa.array(d)],
                                                     ["query_id", "vec_id", "score"])
    return run
