"""Repair of a table whose columns changed between loads.

A current version is compared by the columns it was opened with: one from
before a column was added has no value there, and would otherwise be closed and
reopened for that alone.  It stays until its own columns differ; what replaces
it then has all columns.  A value of a widened type is compared as the old
type's text where it fits that type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import FIELD_SEP, NULL_MARK, business_columns
from ..functions.slots import slot_of, ts_lit
from .match import CHECKSUM, _on, flag_matches, key_set
from .scd2 import _stamp_closed_where
from .stamps import clean_required, open_rows

# One version of a table's columns: batch time it holds from (None: always), and
# its (name, Spark type) pairs.
ColumnVersion = tuple[str | None, Sequence[tuple[str, str]]]


def version_checksum(columns: Sequence[tuple[str, str]], types: dict[str, str]) -> Column:
    """Strict checksum over ``columns`` of rows whose types are now ``types``."""
    parts = []
    for name, old in columns:
        c = F.col(name)
        text = c.cast("string")
        if types[name] != old:
            narrow = c.try_cast(old)
            text = F.when(narrow.cast(types[name]).eqNullSafe(c), narrow.cast("string")).otherwise(text)
        parts.append(F.coalesce(text, F.lit(NULL_MARK)))
    return F.md5(F.concat_ws(FIELD_SEP, *parts))


def evolved_repair_rows(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], batch_ts,
                        versions: Sequence[ColumnVersion], required: Sequence[str] = (),
                        extra: str | Column | None = None, slot: int | None = None,
                        ori_id: Column | str | None = None) -> DataFrame:
    """``repair_rows`` with every current version compared by the columns of the
    version of the table in which it was opened (by its start time)."""
    slot = slot if slot is not None else slot_of(batch_ts, "month")
    cols = business_columns(snapshot)
    req = [*keys, *[c for c in required if c not in keys]]
    types = {f.name: f.dataType.simpleString() for f in snapshot.schema.fields}
    sums = [version_checksum(columns, types) for _, columns in versions]
    number, ck = F.lit(0), sums[0]
    for i, (since, _) in enumerate(versions):
        if since is not None:
            after = F.col("dl_start_dt") >= ts_lit(since)
            number, ck = F.when(after, F.lit(i)).otherwise(number), F.when(after, sums[i]).otherwise(ck)
    a = current.withColumns({"_v": number, CHECKSUM: ck})
    every = F.explode(F.array(*[F.struct(F.lit(i).alias("_v"), s.alias(CHECKSUM)) for i, s in enumerate(sums)]))
    wanted = snapshot.select(*keys, every.alias("_x")).select(*keys, "_x._v", f"_x.{CHECKSUM}")
    flagged = flag_matches(a, wanted, keys, ["_v", CHECKSUM], flag="_hit")
    kept_or_closed = _stamp_closed_where(flagged, cols, batch_ts, slot, ~F.col("_hit"))
    fresh = snapshot
    for i, s in enumerate(sums):
        have = key_set(a.where(F.col("_v") == i), keys, [CHECKSUM])
        n = fresh.withColumn(CHECKSUM, s)
        fresh = n.join(have, _on(keys, [CHECKSUM], n, have, False), "left_anti").drop(CHECKSUM)
    opened = open_rows(clean_required(fresh, req, extra), batch_ts, slot=slot, ori_id=ori_id)
    return kept_or_closed.unionByName(opened)
