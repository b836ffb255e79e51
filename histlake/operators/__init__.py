"""DataFrame -> DataFrame operators: stamps, matching, de-duplication, SCD2."""

from .asof import as_of_join
from .dedup import drop_exact_duplicates, latest_batch, latest_per_key, loaded_since_midnight
from .digest import differing_leaves, digest_tree, leaf_digests
from .history import as_of, expire_rows, expired
from .hotkeys import hot_keys, place_by_key
from .intervals import coalesce_versions
from .late import late_facts, late_rows
from .match import (CHECKSUM, SnapshotDiff, change_report, flag_matches, key_set, matched,
                    snapshot_diff, unmatched, with_checksum)
from .scd2 import backfill_rows, repair_rows, snapshot_rows, upsert_rows
from .sizing import key_stats
from .stamps import (STATUS_CURRENT, STATUS_SNAPSHOT, STATUS_SUPERSEDED, STATUS_TEMPORARY,
                     clean_required, close_rows, close_values, current, ff_columns, m_columns,
                     open_rows, required_predicate, stamp_load)

__all__ = [
    "CHECKSUM", "STATUS_CURRENT", "STATUS_SNAPSHOT", "STATUS_SUPERSEDED", "STATUS_TEMPORARY",
    "SnapshotDiff", "as_of", "as_of_join", "backfill_rows", "change_report", "clean_required", "close_rows",
    "close_values", "coalesce_versions", "current", "differing_leaves", "digest_tree", "drop_exact_duplicates", "expire_rows", "expired", "ff_columns",
    "flag_matches", "hot_keys", "key_set", "key_stats", "late_facts", "late_rows", "latest_batch",
    "latest_per_key", "leaf_digests", "loaded_since_midnight", "m_columns", "matched", "open_rows",
    "place_by_key", "repair_rows", "required_predicate", "snapshot_diff", "snapshot_rows", "stamp_load",
    "unmatched", "upsert_rows", "with_checksum",
]
