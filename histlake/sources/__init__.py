"""Sources and sinks: the raw text layer and the parquet catalog tables."""

from .raw import conform, conform_losses, read_raw, split_raw, text_schema, write_raw
from .tables import (aligned, append_by_name, create_layers, drop_layers, drop_partitions,
                     partitions, rotate_slot, stage)

__all__ = [
    "aligned", "append_by_name", "conform", "conform_losses", "create_layers", "drop_layers",
    "drop_partitions", "partitions", "read_raw", "rotate_slot", "split_raw", "stage", "text_schema", "write_raw",
]
