from harborlake.sinks.paths import delete, is_complete, scratch_path
from harborlake.sinks.writers import (
    balanced,
    land,
    overwrite_partitions,
    overwrite_table,
    preview,
    save_table,
    write_delimited,
)

__all__ = [
    "balanced",
    "delete",
    "is_complete",
    "land",
    "overwrite_partitions",
    "overwrite_table",
    "preview",
    "save_table",
    "scratch_path",
    "write_delimited",
]
