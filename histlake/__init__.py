"""histlake: versioned lake loading (raw -> ODS -> SCD2 main table) on Spark."""

from .functions import (batch_minutes, batch_text, business_columns, check_key, day_slot,
                        row_checksum, slot_of, surrogate_id)
from .operators import (as_of, backfill_rows, change_report, clean_required, close_rows, current,
                        drop_exact_duplicates, expire_rows, latest_batch, latest_per_key,
                        matched, open_rows, repair_rows, snapshot_diff, snapshot_rows,
                        stamp_load, unmatched, upsert_rows)
from .plans import (TableSpec, backfill, catalog_rows, normalize_spec, ods_dedup, rebuild_and_repair,
                    repair, retain, run_all, snapshot_load, table_rows, upsert)
from .session import build_session, checkpoint_root, new_run_dir
from .sources import (append_by_name, conform, conform_losses, create_layers, read_raw,
                      stage)

__all__ = [
    "TableSpec", "append_by_name", "as_of", "backfill", "backfill_rows", "batch_minutes", "batch_text", "build_session",
    "business_columns", "catalog_rows", "change_report", "check_key", "checkpoint_root",
    "clean_required", "close_rows", "conform", "conform_losses", "create_layers", "current",
    "day_slot", "drop_exact_duplicates", "expire_rows", "latest_batch", "latest_per_key",
    "matched", "new_run_dir", "normalize_spec", "ods_dedup", "open_rows", "read_raw",
    "rebuild_and_repair", "repair", "repair_rows", "retain", "row_checksum",
    "run_all", "slot_of", "snapshot_diff", "snapshot_load", "snapshot_rows", "stage",
    "stamp_load", "surrogate_id", "table_rows", "unmatched", "upsert", "upsert_rows",
]
