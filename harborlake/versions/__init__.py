from harborlake.versions.table import (
    Version,
    VersionConflict,
    Void,
    commit,
    compact,
    expire,
    history,
    is_versioned,
    latest,
    new_batch,
    read_batches,
    read_version,
    write_batch,
    write_version,
)

__all__ = [
    "Version",
    "VersionConflict",
    "Void",
    "commit",
    "compact",
    "expire",
    "history",
    "is_versioned",
    "latest",
    "new_batch",
    "read_batches",
    "read_version",
    "write_batch",
    "write_version",
]
