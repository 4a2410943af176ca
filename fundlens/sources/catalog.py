"""Catalog tables as inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from fundlens.sources.csv import LoadResult


def load_tables(spark: SparkSession, tables: Mapping[str, str]) -> LoadResult:
    """``spark.table`` for each name → table; a missing table is reported, not raised."""
    result = LoadResult()
    for name, table in tables.items():
        try:
            result.frames[name] = spark.table(table)
        except Exception as exc:  # noqa: BLE001 - reported per table
            result.failures[name] = f"{type(exc).__name__}: {exc}".splitlines()[0]
    return result
