"""Column-level functions: batch time and slots, surrogate ids, fingerprints."""

from .fingerprint import TECH_COLUMNS, business_columns, check_key, row_checksum
from .ids import batch_minutes, surrogate_id
from .slots import (OPEN_END, batch_datetime, batch_lit, batch_text, day_slot,
                    format_ts, midnight_text, open_end_lit, slot_of, ts_lit)

__all__ = [
    "OPEN_END", "TECH_COLUMNS", "batch_datetime", "batch_lit", "batch_minutes",
    "batch_text", "business_columns", "check_key", "day_slot", "format_ts",
    "midnight_text", "open_end_lit", "row_checksum", "slot_of", "surrogate_id",
    "ts_lit",
]
