"""Table specifications (M1).

A column sheet -- one row per source column with ``col_name``,
``col_type``, ``col_constraint`` -- is normalised by DataFrame expressions
(:func:`normalize_spec`) and then turned into a :class:`TableSpec`, the
small driver-side description every load takes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampNTZType)

# Source type rules, applied to the lower-cased type text.
# First matching rule of this list:
#   'number' exactly          -> int
#   contains 'number(p)'      -> bigint when p > 10, else int
#   contains 'varchar2'       -> 'varchar2' replaced by 'varchar'
#   contains 'date'           -> timestamp
#   contains 'clob'           -> 'clob' replaced by 'varchar(5000)'
#   contains 'integer'        -> 'integer' replaced by 'double'
# Then each of these, in order, on the result:
#   contains a match of [varchar\(][0-9][\)]  -> varchar(10)
#   contains 'nvarchar'       -> 'nvarchar' replaced by 'varchar'
#   contains 'rowid'          -> 'rowid' replaced by 'varchar(10)'
#   contains 'narchar'        -> 'narchar' replaced by 'varchar'
# Constraint words: '主键' marks a primary-key column, '非空' a not-null one.
SHORT_VARCHAR_PATTERN = r"[varchar\(][0-9][\)]"
KEY_WORD = "主键"
NOT_NULL_WORD = "非空"
NUMBER_BIGINT_ABOVE = 10


def table_name(source: str) -> str:
    """Table names: lower case, ``.`` and ``-`` become ``_``."""
    return re.sub(r"[.\-]", "_", source).lower()


def mapped_type(col_type: Column) -> Column:
    """The type rules above as one Column expression; null when unparsable."""
    t = F.lower(F.trim(col_type))
    pos = F.instr(t, "number(")
    # the text between 'number(' and the last character, read as an integer
    precision = t.substr(pos + 7, F.length(t) - pos - 7)
    first = (F.when(t == "number", F.lit("int"))
              .when(pos > 0, F.when(precision.try_cast("int").isNull(), F.lit(None).cast("string"))
                              .when(precision.try_cast("int") > NUMBER_BIGINT_ABOVE, F.lit("bigint"))
                              .otherwise(F.lit("int")))
              .when(t.contains("varchar2"), F.replace(t, F.lit("varchar2"), F.lit("varchar")))
              .when(t.contains("date"), F.lit("timestamp"))
              .when(t.contains("clob"), F.replace(t, F.lit("clob"), F.lit("varchar(5000)")))
              .when(t.contains("integer"), F.replace(t, F.lit("integer"), F.lit("double")))
              .otherwise(t))
    s1 = F.when(first.rlike(SHORT_VARCHAR_PATTERN), F.lit("varchar(10)")).otherwise(first)
    s2 = F.replace(s1, F.lit("nvarchar"), F.lit("varchar"))
    s3 = F.replace(s2, F.lit("rowid"), F.lit("varchar(10)"))
    return F.replace(s3, F.lit("narchar"), F.lit("varchar"))


def normalize_spec(spec: DataFrame, table: str | None = None) -> DataFrame:
    """M1 over a spec *table* (any number of tables' columns at once).

    Input columns: ``col_name``, ``col_type``, ``col_constraint`` and either a
    ``tbl_name`` column or the ``table`` argument; an optional ``col_pos``
    gives the column order (else the input order).  Rows without a column
    name are skipped.  Output: ``tbl_name, col_pos, col_name, src_type,
    col_type, is_key, is_required, type_error``.  An unparsable type (such as
    ``number(10,2)``) yields a null ``col_type`` and a ``type_error`` text
    instead of stopping the run.
    """
    df = spec
    if "tbl_name" not in df.columns:
        if table is None:
            raise ValueError("spec has no tbl_name column; pass table=")
        df = df.withColumn("tbl_name", F.lit(table))
    if "col_pos" not in df.columns:
        df = df.withColumn("col_pos", F.monotonically_increasing_id())
    df = df.filter(F.col("col_name").isNotNull())
    tname = F.regexp_replace(F.lower(F.col("tbl_name")), r"[.\-]", "_")
    cons = F.coalesce(F.col("col_constraint").cast("string"), F.lit(""))
    is_key = F.instr(cons, KEY_WORD) > 0
    mt = mapped_type(F.col("col_type").cast("string"))
    return df.select(
        tname.alias("tbl_name"), F.col("col_pos").cast("bigint").alias("col_pos"),
        F.lower(F.trim(F.col("col_name").cast("string"))).alias("col_name"),
        F.col("col_type").cast("string").alias("src_type"),
        mt.alias("col_type"),
        is_key.alias("is_key"),
        (is_key | (F.instr(cons, NOT_NULL_WORD) > 0)).alias("is_required"),
        F.when(mt.isNull(), F.concat(F.lit("unparsable type: "), F.col("col_type")))
         .alias("type_error"))


def spark_type(type_text: str) -> DataType:
    """Spark type of a mapped type text.

    ``varchar(n)``/``char(n)`` are plain strings (no length check on write:
    an over-long value is kept, not rejected); ``timestamp`` is wall-clock
    ``timestamp_ntz`` like the Hive columns it stands for.  Every type
    without a rule of its own is read by Spark's type parser.
    """
    t = type_text.strip().lower()
    if t == "timestamp":
        return TimestampNTZType()
    if t.startswith(("varchar", "char", "string", "nvarchar")):
        return StringType()
    try:
        return DataType.fromDDL(t)
    except Exception as exc:
        raise ValueError(f"no Spark type for {type_text!r}") from exc


@dataclass(frozen=True)
class TableSpec:
    """One source table: columns (name, mapped type text), keys, required columns."""

    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    database: str = "default"
    prefixes: tuple[str, str, str] = ("f_", "ff_", "m_")
    extra_filter: str | None = None
    location: str | None = None
    buckets: int | None = None
    meta: dict = field(default_factory=dict, compare=False)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, spark_type(t), True) for c, t in self.columns])

    @property
    def required_all(self) -> list[str]:
        return [*self.keys, *[c for c in self.required if c not in self.keys]]

    def _qual(self, prefix: str) -> str:
        return f"{self.database}.{prefix}{self.name}"

    @property
    def f_table(self) -> str:
        return self._qual(self.prefixes[0])

    @property
    def ff_table(self) -> str:
        return self._qual(self.prefixes[1])

    @property
    def m_table(self) -> str:
        return self._qual(self.prefixes[2])

    def with_(self, **changes) -> TableSpec:
        from dataclasses import replace
        return replace(self, **changes)

    @classmethod
    def from_schema(cls, name: str, schema: StructType, keys: Sequence[str],
                    required: Sequence[str] = (), **kw) -> TableSpec:
        """A spec straight from a DataFrame schema (no sheet involved)."""
        cols = tuple((f.name, f.dataType.simpleString().replace("timestamp_ntz", "timestamp"))
                     for f in schema.fields)
        return cls(name=table_name(name), columns=cols, keys=tuple(keys),
                   required=tuple(required), **kw)

    @classmethod
    def from_normalized(cls, normalized: DataFrame, table: str, **kw) -> TableSpec:
        """Collect one table's rows of :func:`normalize_spec` (metadata-sized).

        Raises for unparsable types and for a table without a primary key:
        every load that matches versions needs one.
        """
        rows = (normalized.filter(F.col("tbl_name") == table_name(table))
                .orderBy("col_pos").collect())
        if not rows:
            raise ValueError(f"no columns for table {table!r}")
        bad = [r.col_name for r in rows if r.col_type is None]
        if bad:
            raise ValueError(f"{table}: unparsable column types for {bad}")
        keys = tuple(r.col_name for r in rows if r.is_key)
        if not keys:
            raise ValueError(f"{table}: no primary-key column")
        required = tuple(r.col_name for r in rows if r.is_required and not r.is_key)
        return cls(name=table_name(table), columns=tuple((r.col_name, r.col_type) for r in rows),
                   keys=keys, required=required, **kw)
