"""Shared helpers: reading tables, staging results, grouping linked nodes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.session import new_run_dir

# A word is a run of anything but these six white-space characters.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Sends this package to the executors, once an application: their Python
    workers import the functions that columns and batches go through."""
    sc = (spark or SparkSession.active()).sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="histlake-ship-"), "histlake_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(d, name)
                    z.write(full, os.path.join("histlake", os.path.relpath(full, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


class Stage:
    """One run's folder under ``spark.checkpoint.dir``.

    ``put`` writes a frame as Parquet and reads it back: later steps start
    from files every executor can reach, so a lost executor costs a task
    retry and generated ids stay what they were.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = new_run_dir(spark, label)
        self._n = 0

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def lower_ascii(col):
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def py_lower_ascii(text: str) -> str:
    """The same in Python: bytes know no other letters than A-Z."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def chunks(texts: Iterable[str | None], chars: int = 1 << 21) -> Iterator[list[str]]:
    """Lists of whole texts (null becomes empty) of about ``chars`` characters:
    what is in memory is bounded by this or by the longest single text."""
    out: list[str] = []
    n = 0
    for t in texts:
        t = t or ""
        out.append(t)
        n += len(t) + 64
        if n >= chars:
            yield out
            out, n = [], 0
    if out:
        yield out


def connected_components(edges: DataFrame, stage: Stage, max_rounds: int = 60) -> DataFrame:
    """Alternating large-star / small-star rounds over ``edges(a, b)``.

    Returns ``(node, root)`` for every node of an edge; the root is the
    smallest node reachable.  Every round is a groupBy with a partial minimum
    and a join whose hot side AQE may split, and is staged as a table, so no
    component is gathered in one task or on the driver.
    """
    def pairs(df):
        return df.where("a <> b").distinct()

    cur = stage.put(pairs(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))),
                    "edges")
    seen = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = pairs(both.join(low, both.a == low.k).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")))
        cur = stage.put(large, "large")
        low = cur.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        joined = cur.join(low, cur.a == low.k)
        small = pairs(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("k").alias("a"), F.col("m").alias("b"))))
        cur = stage.put(small, "small")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    # settled: every node points at its root
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
