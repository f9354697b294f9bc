from lamina.sources.files import (
    BATCH_FOLDER,
    read_csv,
    read_table,
    write_batch,
    write_csv,
    write_files,
    write_table,
)
from lamina.sources.shared import fresh_path, held, remove_path, shared_folder, stored
from lamina.sources.versions import current_path, remove_old_versions, versions

__all__ = [
    "BATCH_FOLDER",
    "current_path",
    "fresh_path",
    "held",
    "read_csv",
    "read_table",
    "remove_old_versions",
    "remove_path",
    "shared_folder",
    "stored",
    "versions",
    "write_batch",
    "write_csv",
    "write_files",
    "write_table",
]
