"""Catalog sinks: databases and overwrite-with-schema tables.

Writes go through Spark's commit protocol, so a failed or retried task never
leaves partial files in the table, and an overwrite goes to a version folder of
its own that the catalog entry moves to once it is checked
(``fundlens.sinks.versions``), so a failed job never costs the old table.
Tables are parquet by default; pass ``fmt="delta"`` when the session has Delta
installed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fundlens.session import run_concurrently
from fundlens.sinks.versions import (
    ContentDigest,
    content_digest,
    delete_folder,
    digest_columns,
    next_version,
    prune_versions,
    read_marker,
    write_marker,
)


def quote_ident(name: str) -> str:
    """Back-quote each part of a (possibly qualified) identifier."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; ``location`` pins its folder (shared storage)."""
    sql = f"CREATE DATABASE IF NOT EXISTS {quote_ident(name)}"
    if location:
        sql += " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(sql)


class TableCheckFailed(RuntimeError):
    """What was written does not read back as it was written; the table was left as it was."""


def table_root(spark: SparkSession, name: str, path: str | None = None) -> str:
    """The folder of a table's versions: ``path``, or one beside the database's managed tables."""
    if path:
        return path.rstrip("/")
    database, _, table = name.rpartition(".")
    where = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{where.rstrip('/')}/{table}.versions"


def _table_type(spark: SparkSession, name: str) -> tuple[str, str, str] | None:
    """(type, provider, location) of a catalog table, None where there is none."""
    if not spark.catalog.tableExists(name):
        return None
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(name)}").collect()}  # one row per column
    return told.get("Type", ""), told.get("Provider", "").lower(), told.get("Location", "")


def _recover(spark: SparkSession, name: str) -> None:
    """Undo a replacement that a lost driver left half done."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__previous"):
        spark.sql(f"ALTER TABLE {quote_ident(name + '__previous')} RENAME TO {quote_ident(name)}")


def _point_catalog(spark: SparkSession, name: str, folder: str, schema: StructType, fmt: str, partition_by: Sequence[str]) -> None:
    """Make ``name`` the table in ``folder``.

    Where only the location changes this is one catalog call.  A new schema or
    layout is registered under another name first, then the names are changed;
    on failure the old table gets its name back.
    """
    where = folder.replace("\\", "\\\\").replace("'", "\\'")
    known = _table_type(spark, name)
    if known and known[:2] == ("EXTERNAL", fmt) and not partition_by:
        old = spark.table(name).schema
        plain = not any(c.isPartition for c in spark.catalog.listColumns(name))
        if plain and [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in schema]:
            spark.sql(f"ALTER TABLE {quote_ident(name)} SET LOCATION '{where}'")
            spark.catalog.refreshTable(name)
            return
    fresh = f"{name}__next" if known else name
    if known:
        spark.sql(f"DROP TABLE IF EXISTS {quote_ident(fresh)}")
    columns = ", ".join("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in schema)
    layout = f" PARTITIONED BY ({', '.join(quote_ident(c) for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quote_ident(fresh)} ({columns}) USING {fmt}{layout} LOCATION '{where}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {quote_ident(fresh)}")
    if not known:
        return
    previous = f"{name}__previous"
    spark.sql(f"DROP TABLE IF EXISTS {quote_ident(previous)}")
    spark.sql(f"ALTER TABLE {quote_ident(name)} RENAME TO {quote_ident(previous)}")
    try:
        spark.sql(f"ALTER TABLE {quote_ident(fresh)} RENAME TO {quote_ident(name)}")
    except Exception:
        _recover(spark, name)
        raise
    spark.sql(f"DROP TABLE {quote_ident(previous)}")


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: Sequence[str] | None = None,
    check: str | None = "count",
    keep: int = 1,
) -> ContentDigest | None:
    """Write ``df`` as table ``name``, replacing data and schema on overwrite; returns the digest of its rows.

    An overwrite never touches the old table until the new one is whole: the
    rows go to a new version folder below ``path`` (default: beside the
    database's tables), are read back and compared with what was observed
    during the write (``check``: ``"count"`` of rows, ``"content"`` of all
    values, None), and only then does the catalog entry move.  A write that
    fails at any point leaves the old table readable, ``df`` may read the table
    it replaces, and ``keep`` earlier versions stay for readers that have begun.
    ``partition_by`` lays files out by those columns for partition pruning.

    Other modes (``append``, ``ignore``, ``errorifexists``) and ``fmt="delta"``,
    which replaces atomically itself, go straight to ``saveAsTable`` and return None.
    """
    if mode != "overwrite" or fmt == "delta":
        w = df.write.format(fmt).mode(mode)
        w = w.option("overwriteSchema", "true") if mode == "overwrite" else w
        w = w.option("path", path) if path else w
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
        return None
    if check not in ("count", "content", None):
        raise ValueError(f"unknown check {check!r}; use 'count', 'content' or None")
    spark, partition_by = df.sparkSession, list(partition_by or [])
    _recover(spark, name)
    root = table_root(spark, name, path)
    folder = next_version(spark, root)
    seen = Observation()
    written = df.observe(seen, *digest_columns(df)).write.format(fmt).mode("errorifexists")
    try:
        (written.partitionBy(*partition_by) if partition_by else written).save(folder)
        digest = ContentDigest.of(seen.get)
        stored = spark.read.format(fmt).schema(df.schema).load(folder)
        if check == "content":
            found = content_digest(stored)
        else:
            found = digest if check is None else replace(digest, rows=stored.count())
        if found != digest:
            raise TableCheckFailed(f"{name}: wrote {digest}, read back {found}")
        write_marker(spark, folder, digest)
        _point_catalog(spark, name, folder, stored.select(*df.columns).schema, fmt, partition_by)
    except Exception:
        delete_folder(spark, folder)
        raise
    prune_versions(spark, root, folder, keep)
    return digest


def save_raw_tables(
    dfs: Mapping[str, DataFrame],
    database: str,
    prefix: str = "raw_",
    fmt: str = "parquet",
    location: str | None = None,
) -> dict[str, str | None]:
    """Save each dataset as ``<database>.<prefix><name>``; failures are isolated.

    Returns name → None on success or the error text.  With ``location``
    each table is written below that folder.  The writes run as concurrent
    Spark jobs: a multi-line CSV source is one task per file, so writing the
    datasets one after another would leave most of the cluster idle.
    """
    if not dfs:
        return {}

    def write(name: str, df: DataFrame) -> str | None:
        table = f"{database}.{prefix}{name}"
        path = f"{location.rstrip('/')}/{prefix}{name}" if location else None
        try:
            save_table(df, table, fmt=fmt, path=path)
            return None
        except Exception as exc:  # noqa: BLE001 - reported per table
            return f"{type(exc).__name__}: {exc}".splitlines()[0]

    spark = next(iter(dfs.values())).sparkSession
    tasks = {name: (lambda n=name, d=df: write(n, d)) for name, df in dfs.items()}
    return run_concurrently(spark, tasks, resolve_checkpoint=False)


def verify_table(spark: SparkSession, name: str) -> DataFrame:
    """One row for a table read back: name, row count, column count and schema (one job)."""
    t = spark.table(name)
    return t.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(t.columns)).cast("bigint").alias("column_count"),
        F.lit(t.schema.simpleString()).alias("schema"),
    )


def verify_content(spark: SparkSession, name: str) -> DataFrame:
    """One row: the table's digest recomputed from its files, the one it was written with, and whether they agree.

    A changed, lost or doubled row shows, whatever the order of the files.
    ``matches`` is null for a table that :func:`save_table` did not write.
    """
    known = _table_type(spark, name)
    if known is None:
        raise ValueError(f"no table {name}")
    expected = read_marker(spark, known[2])
    found = content_digest(spark.table(name))
    rows = [(name, found.rows, str(found), expected and expected.rows, expected and str(expected), expected and found == expected)]
    schema = "table_name string, row_count long, digest string, written_rows long, written_digest string, matches boolean"
    return spark.createDataFrame(rows, schema)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables in ``database``."""
    return spark.sql(f"SHOW TABLES IN {quote_ident(database)}").select(
        F.col("namespace").alias("database"), "tableName", "isTemporary"
    )


@contextmanager
def persisted(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep ``df`` cached for the block (e.g. a write followed by counts); always released."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
