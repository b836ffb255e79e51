"""Digests of a table by bucket of the key, as a tree (P4 without reading what is equal).

A digest is the number of rows and two sums of 64-bit hashes of (key,
content): it does not depend on the order of rows, and sums of disjoint sets
add up, so a parent's digest is the sum of its children's.  Leaves are the
buckets of the main table (Spark's own bucket number), so a leaf that differs
names the files to read.  Two tables are compared from the root down; below a
node that agrees nothing is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import row_checksum

FANOUT = 16
_SUMS = ("n", "s1", "s2")


def bucket_number(keys: Sequence[str], buckets: int) -> Column:
    """The bucket Spark writes a row to in a table bucketed by ``keys``."""
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def leaf_digests(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int) -> DataFrame:
    """(leaf, n, s1, s2) of the rows; partial sums per task, ``buckets`` rows out."""
    ck = row_checksum(cols)
    hashed = rows.select(bucket_number(keys, buckets).alias("leaf"), F.xxhash64(*keys, ck).alias("h1"),
                         F.xxhash64(F.lit("second"), *keys, ck).alias("h2"))
    wide = "decimal(20,0)"
    return hashed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h1").cast(wide)).alias("s1"),
                                      F.sum(F.col("h2").cast(wide)).alias("s2"))


def digest_tree(leaves: DataFrame, buckets: int) -> DataFrame:
    """(level, node, n, s1, s2): level 0 are the leaves, the highest the root."""
    level, width = 0, buckets
    nodes = leaves.select(F.lit(0).alias("level"), F.col("leaf").alias("node"), *_SUMS)
    tree = nodes
    while width > 1:
        level, width = level + 1, -(-width // FANOUT)
        nodes = nodes.groupBy(F.floor(F.col("node") / FANOUT).cast("int").alias("node")).agg(
            *[F.sum(c).cast(nodes.schema[c].dataType).alias(c) for c in _SUMS]).select(
            F.lit(level).alias("level"), "node", *_SUMS)
        tree = tree.unionByName(nodes)
    return tree


def differing_leaves(a: DataFrame, b: DataFrame) -> list[int]:
    """Leaves whose digests differ between two trees over the same buckets.
    From the root down: a level's nodes are compared only below differing ones.
    What comes to the driver is at most a number per bucket."""
    top = max((r["m"] for t in (a, b) for r in [t.agg(F.max("level").alias("m")).first()] if r["m"] is not None),
              default=-1)
    below: list[int] | None = None
    for level in range(top, -1, -1):
        x, y = ([t.where(F.col("level") == level), t.where(F.col("level") == level).where(
            F.floor(F.col("node") / FANOUT).cast("int").isin(below))][below is not None] for t in (a, b))
        y = y.select(F.col("node").alias("node_b"), *[F.col(c).alias(c + "_b") for c in _SUMS])
        same = F.lit(True)
        for c in _SUMS:
            same = same & F.col(c).eqNullSafe(F.col(c + "_b"))
        unlike = x.join(y, F.col("node") == F.col("node_b"), "full_outer").where(~same)
        below = sorted(r[0] for r in unlike.select(F.coalesce("node", "node_b")).collect())
        if not below:
            return []
    return below or []
