"""Inputs: CSV datasets, catalog tables, and stand-ins over the driver tables."""

from fundlens.sources.catalog import load_tables
from fundlens.sources.csv import (
    LoadResult,
    apply_schema,
    drop_tag_row,
    load_datasets,
    read_csv_dataset,
    write_csv,
)

__all__ = [
    "LoadResult",
    "apply_schema",
    "drop_tag_row",
    "load_datasets",
    "load_tables",
    "read_csv_dataset",
    "write_csv",
]
