"""Which partitions hold a key: a Bloom filter and a key range per partition.

The filter is blocked: a key's hash chooses one block of 32,768 bits and a few
bits in it, so it is a table (part, block, bits) that grows with the
partition, is built by one aggregation and probed by a join on the block.  A
miss is certain; a false hit (a few in a thousand) only costs a read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768      # bits of one Spark bitmap
BITS_A_KEY = 12
HASHES = 6


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_A_KEY // BLOCK_BITS))


def _block(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), *keys), blocks).cast("int")


def _bits(keys: Sequence[str]) -> list[Column]:
    """Places of a key's bits in its block: two hashes give them all."""
    a, b = F.xxhash64(F.lit("first"), *keys), F.xxhash64(F.lit("second"), *keys)
    return [F.pmod(F.shiftright(a, 1) + F.lit(i) * F.shiftright(b, 8), F.lit(BLOCK_BITS)).cast("int")
            for i in range(HASHES)]


def build_filter(rows: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """(block, bits) of the keys of ``rows``; bits are set per task first."""
    marked = rows.select(_block(keys, F.lit(blocks)).alias("block"), F.explode(F.array(*_bits(keys))).alias("bit"))
    return marked.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))


def key_range(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: smallest and largest value of each key column, and the rows."""
    return rows.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{name}_{i}") for i, k in enumerate(keys)
                                                    for name, f in (("lo", F.min), ("hi", F.max))])


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.hex(bits).substr(2 * F.floor(place / 8).cast("int") + 1, F.lit(2))
    mask = F.get(F.array(*[F.lit(1 << i) for i in range(8)]), F.pmod(place, F.lit(8)))
    return F.conv(byte, 16, 10).cast("int").bitwiseAND(mask) != 0


def hit_parts(filters: DataFrame, ranges: DataFrame, arriving: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``part`` of every filter that may hold a key of ``arriving`` (distinct
    keys).  ``filters(part, block, bits)``, ``ranges(part, blocks, lo_i, hi_i)``:
    one row a day partition, so at most 31.  A key looks up one block of each
    partition whose range it is in; partitions answer with one row a task."""
    types = {c: ranges.schema[c].dataType for c in ranges.columns}
    asked = []
    for r in ranges.collect():
        inside = F.lit(True)
        for i, k in enumerate(keys):
            inside = inside & F.col(k).between(*[F.lit(r[f"{b}_{i}"]).cast(types[f"{b}_{i}"]) for b in ("lo", "hi")])
        block = _block(keys, F.lit(r["blocks"]))
        asked.append(F.when(inside, F.struct(F.lit(r["part"]).alias("part"), block.alias("block"))))
    probes = F.filter(F.array(*asked), lambda x: x.isNotNull())
    looked = arriving.select(F.explode(probes).alias("p"), F.array(*_bits(keys)).alias("places")).select("p.*", "places")
    found = looked.join(filters, ["part", "block"])
    every = F.forall("places", lambda p: _is_set(F.col("bits"), p))
    return found.where(every).select("part").distinct()
