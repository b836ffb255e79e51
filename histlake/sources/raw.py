"""The raw layer ``f``: tab-delimited text, typed on read.

Everything is read as text first and then converted with ``try_cast``, so a
value that does not parse becomes null instead of failing the load or
silently shifting columns; :func:`conform_losses` counts those values per
column in one aggregation pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

# Fixed values of the raw text format: tab-separated, \N for null, no quoting.
RAW_SEP = "\t"
RAW_NULL = "\\N"
# Escapes of the escaped form: character after the backslash, and what it stands
# for; the backslash itself comes first.
RAW_ESCAPES = (("\\", "\\"), ("t", "\t"), ("n", "\n"), ("r", "\r"))


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def _escaped(c: Column) -> Column:
    for mark, text in RAW_ESCAPES:
        c = F.replace(c, F.lit(text), F.lit("\\" + mark))
    return c


def _unescaped(c: Column) -> Column:
    """Pairs of backslashes stand between the parts, so what is left in a part
    are escapes of the other characters."""
    def part(p: Column) -> Column:
        for mark, text in RAW_ESCAPES[1:]:
            p = F.replace(p, F.lit("\\" + mark), F.lit(text))
        return p

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


def parse_lines(lines: DataFrame, columns: Sequence[str], escaped: bool = False) -> DataFrame:
    """Text columns of raw lines (column ``value``), in the declared order.

    ``\\N`` is null and an empty field stays the empty text; fields a short
    line lacks are null.  The one reader of batch loads and streams.
    """
    parts = F.split("value", RAW_SEP, -1)
    out = []
    for i, c in enumerate(columns):
        f = F.get(parts, F.lit(i))
        out.append(F.when(f != RAW_NULL, _unescaped(f) if escaped else f).alias(c))
    return lines.select(*out)


def read_raw(spark: SparkSession, path: str, columns: Sequence[str], escaped: bool = False) -> DataFrame:
    """All columns of the raw text as strings, in the declared order.
    ``escaped`` undoes the escapes of :func:`write_raw`."""
    return parse_lines(spark.read.option("lineSep", "\n").text(path), columns, escaped)


class RawSplit(NamedTuple):
    good: DataFrame       # the text columns of lines with the declared number of fields
    rejected: DataFrame   # file, position, reason, fields, line


def split_raw(spark: SparkSession, path: str, columns: Sequence[str], escaped: bool = False) -> RawSplit:
    """Lines that have the declared number of fields, and the others, each with
    its file, byte position, reason and number of fields.

    The position is that of the line's first byte in the (decompressed) file:
    the bytes of the file's blocks before, as Spark split it, and of the lines
    before it in its block.  Only files and blocks with rejected lines are
    measured: clean ones are read once.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"),   # ascends within a block
        F.size(F.split("value", RAW_SEP, -1)).alias("fields"))
    bad = F.col("fields") != len(columns)
    size = F.octet_length("value") + 1
    blocks = lines.where(bad).select("file", "block").distinct()
    files = blocks.select("file").distinct()
    totals = lines.join(files, "file", "left_semi").groupBy("file", "block").agg(F.sum(size).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    starts = totals.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("file", "block").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    measured = lines.join(blocks, ["file", "block"], "left_semi").select(
        "file", "block", "fields", F.when(bad, F.col("value")).alias("line"),   # good lines go by their size only
        F.coalesce(F.sum(size).over(inside), F.lit(0)).alias("offset"))
    rejected = measured.where(bad).join(starts, ["file", "block"]).select(
        "file", (F.col("start") + F.col("offset")).alias("position"),
        F.when(F.col("fields") < len(columns), "missing fields").otherwise("surplus fields").alias("reason"),
        "fields", "line")
    return RawSplit(parse_lines(lines.where(~bad), columns, escaped), rejected)


def write_raw(df: DataFrame, path: str, mode: str = "overwrite", escaped: bool = False) -> None:
    """Write rows in the raw text format (the inverse of :func:`read_raw`).

    With ``escaped`` tabs, line ends and backslashes in values are written as
    ``\\t``, ``\\n``, ``\\r`` and ``\\\\``, which :func:`read_raw` undoes; without
    it a value that holds a tab or newline, or is the text ``\\N``, fails the
    write: it would come back as something else.
    """
    def field(c: str) -> Column:
        text = F.col(c).cast("string")
        if escaped:
            text = _escaped(text)
        else:
            odd = text.contains(RAW_SEP) | text.contains("\n") | (text == RAW_NULL)
            text = F.when(odd, F.raise_error(F.lit(f"column {c}: the raw format cannot hold a value"))).otherwise(text)
        return F.coalesce(text, F.lit(RAW_NULL))

    df.select(F.concat_ws(RAW_SEP, *[field(c) for c in df.columns]).alias("value")).write.mode(mode).option(
        "lineSep", "\n").text(path)


def _targets(schema: StructType | Sequence[tuple[str, DataType]]) -> list[tuple[str, DataType]]:
    if isinstance(schema, StructType):
        return [(f.name, f.dataType) for f in schema.fields]
    return list(schema)


def conform(raw: DataFrame, schema: StructType | Sequence[tuple[str, DataType]]) -> DataFrame:
    """Typed rows: each text column converted to its target type, null if unparsable."""
    out = []
    for name, dtype in _targets(schema):
        c = F.col(name)
        out.append((c if isinstance(dtype, StringType) else c.try_cast(dtype)).alias(name))
    return raw.select(*out)


def conform_losses(raw: DataFrame, schema: StructType | Sequence[tuple[str, DataType]]) -> DataFrame:
    """Per column: how many present values the conversion turned into null.

    One global aggregation (partial sums per task, one row out), then an
    unpivot to ``(column_name, lost)``.
    """
    sums = []
    names = []
    for name, dtype in _targets(schema):
        c = F.col(name)
        typed = c if isinstance(dtype, StringType) else c.try_cast(dtype)
        lost = F.when(c.isNotNull() & typed.isNull(), 1).otherwise(0)
        sums.append(F.sum(lost).cast("bigint").alias(name))
        names.append(name)
    wide = raw.agg(*sums)
    return wide.unpivot([], names, "column_name", "lost")
