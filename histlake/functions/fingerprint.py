"""Row fingerprints (X9) and check keys.

``strict=True`` (default) separates fields and marks nulls, so
``(a, null, b)`` and ``(a, b, null)`` or ``('ab', 'c')`` and ``('a', 'bc')``
get different checksums.  ``strict=False`` is the compatible form: plain
``md5(concat_ws('', cols))``, where nulls vanish and fields run together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the strict form: unit separator between fields, record
# separator standing in for null.
FIELD_SEP = "\x1f"
NULL_MARK = "\x1e"

TECH_COLUMNS = ("dl_id", "dl_loaded_dt", "dl_start_dt", "dl_end_dt", "dl_status", "day")


def _as_text(c: str) -> Column:
    return F.col(c).cast("string")


def row_checksum(cols: Sequence[str], strict: bool = True) -> Column:
    """md5 of the business columns, as 32 hex characters."""
    if not cols:
        raise ValueError("row_checksum needs at least one column")
    if strict:
        parts = [F.coalesce(_as_text(c), F.lit(NULL_MARK)) for c in cols]
        return F.md5(F.concat_ws(FIELD_SEP, *parts))
    return F.md5(F.concat_ws("", *[_as_text(c) for c in cols]))


def check_key(keys: Sequence[str], checksum: Column | str, strict: bool = True) -> Column:
    """Key columns followed by the checksum, as one string."""
    ck = F.col(checksum) if isinstance(checksum, str) else checksum
    if strict:
        parts = [F.coalesce(_as_text(k), F.lit(NULL_MARK)) for k in keys]
        return F.concat_ws(FIELD_SEP, *parts, ck)
    return F.concat_ws("", *[_as_text(k) for k in keys], ck)


def business_columns(df_or_cols, extra_tech: Sequence[str] = ()) -> list[str]:
    """F8: every column except the technical ones."""
    cols = df_or_cols.columns if hasattr(df_or_cols, "columns") else list(df_or_cols)
    drop = set(TECH_COLUMNS) | set(extra_tech)
    return [c for c in cols if c not in drop]
