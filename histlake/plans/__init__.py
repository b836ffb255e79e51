"""Table specifications, the catalogue, and the loads over catalog tables."""

from .spec import TableSpec, mapped_type, normalize_spec, spark_type, table_name
from .catalog import catalog_rows, table_rows
from .compaction import compact
from .dedup_days import ods_dedup_days
from .digests import repair_by_digest
from .evolution import column_versions, evolve
from .late import upsert_late
from .loads import (LOADS, LoadResult, backfill, ods_dedup, read_source, rebuild_and_repair, repair,
                    retain, run_all, snapshot_load, upsert)

__all__ = [
    "LOADS", "LoadResult", "TableSpec", "backfill", "catalog_rows", "column_versions", "compact", "evolve",
    "mapped_type", "normalize_spec", "ods_dedup", "ods_dedup_days", "read_source", "rebuild_and_repair", "repair", "repair_by_digest", "retain", "run_all",
    "snapshot_load", "spark_type", "table_name", "table_rows", "upsert", "upsert_late",
]
