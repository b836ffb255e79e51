"""The column and table catalogue of the three layers (M2).

Every sheet row is repeated once per layer table with ``explode`` over the
three layer names (no join), and its descriptive fields are tidied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spec import table_name

# Fixed values written into the catalogue rows.
DATA_SOURCE = "Hive"
COLUMN_FIELDS = ("col_desc", "comments", "sample_data", "sec_lvl_id")
TABLE_FIELDS = ("data_category", "themes", "owner_sys", "owner", "tbl_desc", "data_frequency",
                "sec_lvl_id", "comments", "data_source", "tbl_std_lvl")


def _blank_to_empty(c: Column) -> Column:
    """Trimmed text, or '' when null or blank."""
    t = F.trim(c.cast("string"))
    return F.when(c.isNull() | (t == ""), F.lit("")).otherwise(t)


def _layer_names(table: Column, prefixes: Sequence[str]) -> Column:
    return F.array(*[F.concat(F.lit(p), table) for p in prefixes])


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def catalog_rows(spec: DataFrame, schema_name: str = "default",
                 prefixes: Sequence[str] = ("f_", "ff_", "m_"), table: str | None = None) -> DataFrame:
    """Column catalogue: each sheet column x each layer table.

    ``col_constraint`` is wrapped as ``['..']`` unless it already holds a
    ``[``; blank descriptive fields become ''; ``col_type`` is not carried.
    """
    df = spec.filter(F.col("col_name").isNotNull())
    tname = (F.regexp_replace(F.lower(F.col("tbl_name")), r"[.\-]", "_")
             if "tbl_name" in df.columns else F.lit(table_name(table or "")))
    cons = _optional(df, "col_constraint").cast("string")
    wrapped = (F.when(cons.isNull() | (F.trim(cons) == ""), F.lit(""))
                .when(cons.contains("["), cons)
                .otherwise(F.concat(F.lit("['"), cons, F.lit("']"))))
    return df.select(
        F.lit(DATA_SOURCE).alias("data_source"),
        F.lit(schema_name).alias("schema_name"),
        F.explode(_layer_names(tname, prefixes)).alias("tbl_name"),
        F.lower(F.trim(F.col("col_name").cast("string"))).alias("col_name"),
        *[_blank_to_empty(_optional(df, c)).alias(c) for c in COLUMN_FIELDS],
        wrapped.alias("col_constraint"))


def table_rows(tables: DataFrame, schema_name: str = "default",
               prefixes: Sequence[str] = ("f_", "ff_", "m_"), table: str | None = None) -> DataFrame:
    """Table catalogue: each table-sheet row x each layer table."""
    tname = (F.regexp_replace(F.lower(F.col("tbl_name")), r"[.\-]", "_")
             if "tbl_name" in tables.columns else F.lit(table_name(table or "")))
    return tables.select(
        F.lit(schema_name).alias("schema_name"),
        F.explode(_layer_names(tname, prefixes)).alias("tbl_name"),
        *[_optional(tables, c).cast("string").alias(c) for c in TABLE_FIELDS])
