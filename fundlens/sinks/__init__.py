"""Table sinks."""

from fundlens.sinks.tables import (
    ensure_database,
    list_tables,
    persisted,
    save_raw_tables,
    save_table,
    verify_content,
    verify_table,
)

__all__ = [
    "ensure_database",
    "list_tables",
    "persisted",
    "save_raw_tables",
    "save_table",
    "verify_content",
    "verify_table",
]
