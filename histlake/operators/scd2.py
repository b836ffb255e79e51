"""The versioning algebra of the main table, as pure DataFrame transforms.

Notation: ``A`` current versions, ``N`` arrivals, ``H(x)`` x closed at the
batch time, ``open(x)`` x stamped as new current versions.

* :func:`upsert_rows` (P2/P3): ``(A - keys(N)) + H(A & keys(N)) + open(clean(N))``
  -- every arriving key closes its current version, changed or not.
* :func:`repair_rows` (P4/P5): N is a full snapshot, matched on key + content:
  ``(A & N) + H(A - N) + open(clean(N - A))``.
* :func:`snapshot_rows` (P1): ``history - P slot + P(A) + open(clean(N))``.

The first two return the rows that replace the current slice (status ``A``)
plus the rows closed by this batch (status ``H``); the table layer writes the
two parts to their partitions.  In the upsert, kept and closed rows come out
of ONE left join against the distinct arrival keys, stamped by a ``when``; the
repair is ONE full outer join against the snapshot reduced per (key,
checksum), read through one projection.  Either way the current slice is read
once and, on a table bucketed by the key, not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import business_columns
from ..functions.ids import surrogate_id_at
from ..functions.slots import batch_lit, open_end_lit, slot_of
from .dedup import latest_per_key
from .hotkeys import is_hot, place_by_key
from .match import CHECKSUM, _on, flag_matches, key_set, with_checksum
from .stamps import (STATUS_CURRENT, STATUS_SNAPSHOT, STATUS_SUPERSEDED, clean_required,
                     close_rows, close_values, m_columns, open_rows)

_HIT = "_hit"
COPIES_CHUNK = 4096     # copies of one row that one row of the reduced snapshot opens at most


def _stamp_closed_where(flagged: DataFrame, cols: Sequence[str], batch_ts, slot: int,
                        close_when: Column) -> DataFrame:
    """Close the flagged current versions in place, keep the others."""
    vals = close_values(batch_ts, STATUS_SUPERSEDED, slot)
    out = []
    for c in m_columns(cols):
        if c in vals:
            out.append(F.when(close_when, vals[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return flagged.select(*out)


def upsert_rows(current: DataFrame, arrivals: DataFrame, keys: Sequence[str], batch_ts,
                required: Sequence[str] = (), extra: str | Column | None = None,
                slot: int | None = None, ori_id: Column | str | None = None,
                broadcast_keys: bool = False, opened_partitions: int | None = None,
                hot: Mapping[int, int] | None = None) -> DataFrame:
    """P2/P3 rows: new current slice plus the versions closed by this batch
    (:func:`upsert_parts` in one).
    """
    kept_or_closed, opened = upsert_parts(current, arrivals, keys, batch_ts, required, extra, slot, ori_id,
                                          broadcast_keys, opened_partitions, hot)
    return kept_or_closed.unionByName(opened)


def upsert_parts(current: DataFrame, arrivals: DataFrame, keys: Sequence[str], batch_ts,
                 required: Sequence[str] = (), extra: str | Column | None = None,
                 slot: int | None = None, ori_id: Column | str | None = None,
                 broadcast_keys: bool = False, opened_partitions: int | None = None,
                 hot: Mapping[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """P2/P3 rows: the current versions, kept or closed by this batch, and the
    versions it opens.

    Arrivals are cleaned first (keys and ``required`` non-null, ``extra``
    predicate), and only cleaned arrivals close versions.  Null keys never
    match.  Several arrivals with one key all open (as the original does);
    use :func:`histlake.operators.dedup.latest_per_key` first to avoid that.
    ``opened_partitions`` spreads the opened rows by key over that many
    partitions (the bucket count of a bucketed target: one bucket per task);
    the keys in ``hot`` (:func:`.hotkeys.hot_keys`) over several each.
    """
    if not keys:
        raise ValueError("upsert needs a primary key")
    slot = slot if slot is not None else slot_of(batch_ts, "month")
    cols = business_columns(arrivals)
    clean = clean_required(arrivals, [*keys, *[c for c in required if c not in keys]], extra)
    flagged = flag_matches(current, clean, keys, broadcast=broadcast_keys, flag=_HIT)
    kept_or_closed = _stamp_closed_where(flagged, cols, batch_ts, slot, F.col(_HIT))
    opened = open_rows(clean, batch_ts, slot=slot, ori_id=ori_id)
    if opened_partitions:
        opened = place_by_key(opened, keys, opened_partitions, hot or {}, ["dl_id"])
    return kept_or_closed, opened


def repair_rows(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], batch_ts,
                required: Sequence[str] = (), extra: str | Column | None = None,
                slot: int | None = None, ori_id: Column | str | None = None,
                strict: bool = True, clean_first: bool = False,
                method: str = "outer", buckets: int | None = None,
                hot: Mapping[int, int] | None = None, parts: int | None = None) -> DataFrame:
    """P4/P5 rows: diff of the current versions against a full snapshot.

    Unchanged versions stay untouched (same ``dl_id``); changed and vanished
    ones close; changed and new snapshot rows open.  By default cleaning
    comes after the diff, as in the original: a rejected replacement still
    closes its old version.  ``clean_first=True`` cleans before the diff.

    ``method='outer'`` (default with strict checksums) reads each side once:
    the snapshot is reduced to one row per (key, checksum) -- rows sharing
    a strict checksum are identical, so one representative and a copy count
    lose nothing, and the reduction is a partial aggregation, so repeated
    rows collapse before the shuffle -- then one full outer join with the
    current versions (both sides unique per join key: no fan-out) yields
    kept, closed and opened rows; copies re-open via ``explode``.
    ``buckets`` (of a main table bucketed by the key) places the snapshot by
    key once, which serves its reduction and the join.  The keys in ``hot``
    (:func:`.hotkeys.hot_keys` for ``parts`` tasks) are a branch of their own:
    joined by key and checksum across all tasks, their copies opened in
    chunks that are dealt over the tasks of the key.
    ``method='two_joins'`` (always used with ``strict=False``, whose
    checksum can be shared by different rows) flags the current versions
    with one left join and finds new rows with an anti join.
    """
    if not keys:
        raise ValueError("repair needs a primary key")
    slot = slot if slot is not None else slot_of(batch_ts, "month")
    cols = business_columns(snapshot)
    req = [*keys, *[c for c in required if c not in keys]]
    snap = clean_required(snapshot, req, extra) if clean_first else snapshot
    a = with_checksum(current, cols, strict)
    n = with_checksum(snap, cols, strict)
    if method == "outer" and strict:
        return _repair_outer(a, n, keys, cols, req, extra, batch_ts, slot, ori_id, buckets, hot or {},
                             parts or buckets or 1)
    else:
        # Plain key equality: the current slice never holds null keys (cleaning
        # rejects them before anything opens), and a null-safe comparison would
        # turn the join keys into expressions that no longer line up with a
        # table bucketed by the key.
        flagged = flag_matches(a, n, keys, [CHECKSUM], null_safe=False, flag=_HIT)
        kept_or_closed = _stamp_closed_where(flagged, cols, batch_ts, slot, ~F.col(_HIT))
        ak = key_set(a, keys, [CHECKSUM])
        fresh = n.join(ak, _on(keys, [CHECKSUM], n, ak, False), "left_anti").drop(CHECKSUM)
    opened = open_rows(clean_required(fresh, req, extra), batch_ts, slot=slot, ori_id=ori_id)
    return kept_or_closed.unionByName(opened)


def _merged(a: DataFrame, reduced: DataFrame, keys: Sequence[str], cols: Sequence[str], ok) -> DataFrame:
    """One full outer join, one projection: every output row comes from the
    same joined row, so the optimizer cannot split the join into two."""
    cond = a[CHECKSUM] == reduced["_r_ck"]
    for k in keys:
        cond = cond & (a[k] == reduced["_r_" + k])
    j = a.withColumn("_a", F.lit(True)).join(reduced, cond, "full_outer")
    new_row = F.col("_a").isNull()                    # only in the snapshot: to open

    def side(c: str) -> Column:
        n_col = F.col("_r_" + c) if c in keys else F.col("_n_" + c)
        return F.when(new_row, n_col).otherwise(a[c])

    merged = j.select(
        new_row.alias("_new"), (~new_row & F.col("_copies").isNull()).alias("_gone"),     # gone: to close
        F.when(new_row, F.col("_copies")).otherwise(F.lit(1)).cast("bigint").alias("_copies"),
        F.coalesce(a[CHECKSUM], reduced["_r_ck"]).alias("_ck"), *[side(c).alias(c) for c in cols],
        *[a[c].alias("_a_" + c) for c in ("dl_id", "dl_loaded_dt", "dl_start_dt", "dl_end_dt",
                                          "dl_status", "day")])
    # cleaning applies to opened rows only
    return merged if ok is None else merged.filter(~F.col("_new") | ok)


def _repair_outer(a: DataFrame, n: DataFrame, keys: Sequence[str], cols: Sequence[str],
                  req: Sequence[str], extra, batch_ts, slot: int, ori_id, buckets: int | None,
                  hot: Mapping[int, int], parts: int) -> DataFrame:
    from ..functions.ids import surrogate_id
    from .stamps import required_predicate
    ok = required_predicate(req, extra)
    others = [c for c in cols if c not in keys]

    def reduce(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(*[F.col(k).alias("_r_" + k) for k in keys], F.col(CHECKSUM).alias("_r_ck"))
                    .agg(*[F.first(c).alias("_n_" + c) for c in others],
                         F.count(F.lit(1)).alias("_copies")))

    def opened(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))

    cold_a, cold_n = (a.filter(~is_hot(keys, hot)), n.filter(~is_hot(keys, hot))) if hot else (a, n)
    if buckets:
        cold_n = cold_n.repartition(buckets, *keys)
    rows = opened(_merged(cold_a, reduce(cold_n), keys, cols, ok))
    if hot:
        spread = a.filter(is_hot(keys, hot)).repartition(*keys, CHECKSUM)
        mixed = _merged(spread, reduce(n.filter(is_hot(keys, hot))), keys, cols, ok)
        # a repeated row is one row here: its copies leave it in chunks, each dealt on its own
        last = F.ceil(F.col("_copies") / COPIES_CHUNK).cast("int")
        mixed = mixed.withColumn("_chunk", F.explode(F.sequence(F.lit(1), last))).withColumn(
            "_copies", F.least(F.lit(COPIES_CHUNK), F.col("_copies") - (F.col("_chunk") - 1) * COPIES_CHUNK))
        mixed = place_by_key(mixed, keys, parts, hot, ["_ck", "_chunk"])
        rows = rows.unionByName(opened(mixed.drop("_chunk")))
    new_row, gone = F.col("_new"), F.col("_gone")
    t = batch_lit(batch_ts)
    closing = close_values(batch_ts, STATUS_SUPERSEDED, slot)
    # row numbers are given above the union, where no two tasks share them
    return rows.select(
        F.when(new_row, surrogate_id(batch_ts, ori_id)).otherwise(F.col("_a_dl_id")).alias("dl_id"),
        *cols,
        F.when(new_row | gone, t).otherwise(F.col("_a_dl_loaded_dt")).alias("dl_loaded_dt"),
        F.when(new_row, t).otherwise(F.col("_a_dl_start_dt")).alias("dl_start_dt"),
        F.when(new_row, open_end_lit()).when(gone, closing["dl_end_dt"])
         .otherwise(F.col("_a_dl_end_dt")).alias("dl_end_dt"),
        F.when(new_row, F.lit(STATUS_CURRENT)).when(gone, closing["dl_status"])
         .otherwise(F.col("_a_dl_status")).alias("dl_status"),
        F.when(new_row | gone, F.lit(slot).cast("int")).otherwise(F.col("_a_day")).alias("day"))


def snapshot_rows(m: DataFrame, snapshot: DataFrame, keys: Sequence[str], batch_ts,
                  required: Sequence[str] = (), extra: str | Column | None = None,
                  slot: int | None = None, ori_id: Column | str | None = None) -> DataFrame:
    """P1 rows: the whole main table after a full-snapshot load.

    The snapshot slot (ISO weekday) rotates: ``P`` rows already in today's
    slot are dropped, today's current versions become ``P`` rows there, and
    the cleaned snapshot becomes the current slice.  Other history passes
    through unchanged.
    """
    slot = slot if slot is not None else slot_of(batch_ts, "week")
    req = [*keys, *[c for c in required if c not in keys]]
    status, day = F.col("dl_status"), F.col("day")
    history = m.filter((status != STATUS_CURRENT)
                       & ~((status == STATUS_SNAPSHOT) & (day == slot)))
    backup = close_rows(m.filter(status == STATUS_CURRENT), batch_ts, STATUS_SNAPSHOT, slot)
    opened = open_rows(clean_required(snapshot, req, extra), batch_ts, slot=slot, ori_id=ori_id)
    return history.unionByName(backup).unionByName(opened)


def backfill_rows(current: DataFrame | None, batches: DataFrame, keys: Sequence[str],
                  batch_col: str, order_cols: Sequence[str], required: Sequence[str] = (),
                  extra: str | Column | None = None,
                  ori_id: Column | str | None = None) -> DataFrame:
    """P2 applied to a whole sequence of batches, as one job.

    ``batches`` holds arrivals of many loads; ``batch_col`` (wall-clock
    timestamp) says which load each row belongs to.  The result equals
    running :func:`upsert_rows` batch after batch with the newest arrival
    per key kept in each batch (``order_cols`` newest first): every batch a
    key arrives in opens a version; it closes at the key's next batch.

    Plan: newest row per (key, batch) -- a partial WindowGroupLimit before
    the shuffle -- then ``lead`` over each key's batches, a window that
    holds at most one row per batch, so a key that holds a third of the
    arrivals is still one small group.  ``current`` (may be ``None``) is the
    current slice before the first batch: versions whose key arrives are
    closed at that key's first batch, via one join against a per-key minimum
    (partial aggregation).  Returns the current slice plus every closed
    version, as the sequence of upserts would leave them.
    """
    if not keys:
        raise ValueError("backfill needs a primary key")
    cols = [c for c in business_columns(batches) if c != batch_col]
    req = [*keys, *[c for c in required if c not in keys]]
    clean = clean_required(batches, req, extra)
    newest = latest_per_key(clean, [*keys, batch_col], list(order_cols))
    w = Window.partitionBy(*keys).orderBy(batch_col)
    nxt = F.lead(batch_col).over(w)
    b = F.col(batch_col).cast("timestamp_ntz")
    versions = newest.select(
        *cols, b.alias("_batch"), nxt.cast("timestamp_ntz").alias("_next"),
        surrogate_id_at(b, ori_id).alias("dl_id"))
    closed = F.col("_next").isNotNull()
    out = versions.select(
        "dl_id", *cols,
        F.coalesce("_next", "_batch").alias("dl_loaded_dt"),
        F.col("_batch").alias("dl_start_dt"),
        F.when(closed, F.col("_next")).otherwise(open_end_lit()).alias("dl_end_dt"),
        F.when(closed, F.lit(STATUS_SUPERSEDED)).otherwise(F.lit(STATUS_CURRENT)).alias("dl_status"),
        F.dayofmonth(F.coalesce("_next", "_batch")).cast("int").alias("day"))
    if current is None:
        return out
    first = (newest.groupBy(*keys).agg(F.min(batch_col).cast("timestamp_ntz").alias("_first"))
             .select(*[F.col(k).alias("_r_" + k) for k in keys], "_first"))
    on = [current[k] == first["_r_" + k] for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = current.join(first, cond, "left_outer")
    hit = F.col("_first").isNotNull()
    prior = joined.select(
        "dl_id", *cols,
        F.when(hit, F.col("_first")).otherwise(F.col("dl_loaded_dt")).alias("dl_loaded_dt"),
        "dl_start_dt",
        F.when(hit, F.col("_first")).otherwise(F.col("dl_end_dt")).alias("dl_end_dt"),
        F.when(hit, F.lit(STATUS_SUPERSEDED)).otherwise(F.col("dl_status")).alias("dl_status"),
        F.when(hit, F.dayofmonth("_first").cast("int")).otherwise(F.col("day")).alias("day"))
    return prior.unionByName(out)
