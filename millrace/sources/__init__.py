from millrace.sources.tables import (
    FORMATS,
    StagedTable,
    land_raw,
    new_folder,
    read_table,
    shared_folder,
    write_table,
)

__all__ = [
    "FORMATS",
    "StagedTable",
    "land_raw",
    "new_folder",
    "read_table",
    "shared_folder",
    "write_table",
]
