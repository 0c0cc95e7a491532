"""Writers."""

from shelfstream.sinks.files import write_snapshot_files
from shelfstream.sinks.messages import publish, to_envelope
from shelfstream.sinks.tables import (
    create_database,
    drop_database,
    save_dataset,
    save_view,
    use_database,
)

__all__ = [
    "create_database",
    "drop_database",
    "publish",
    "save_dataset",
    "save_view",
    "to_envelope",
    "use_database",
    "write_snapshot_files",
]
