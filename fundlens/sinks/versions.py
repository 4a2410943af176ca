"""Version folders of a table and the content digest that vouches for each.

A table's root folder holds one folder per version, ``v000012-1f6c...``.  A
version counts only once its marker file is there, which is written last and
holds the digest of its rows: readers and the catalog never see a version that
a failed job left behind.

The digest is order-independent: the number of rows, the sum and the xor of a
64-bit hash per row.  It is observed while the rows are written (no second job)
and can be recomputed from the stored table at any time.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from fundlens.functions.columns import qcol

# Starts with "_", so that readers of the folder skip it.
MARKER = "_VERIFIED"
VERSION = re.compile(r"v(\d{6,})-[0-9a-f]{8}$")
# A row hash is summed in three parts of at most 22 bits: exact for up to 2^41 rows.
PART_BITS = 21
PART_MASK = (1 << PART_BITS) - 1


@dataclass(frozen=True)
class ContentDigest:
    rows: int
    total: int
    mix: int

    @classmethod
    def of(cls, metrics: dict) -> ContentDigest:
        """From the values of :func:`digest_columns` (null for an empty table)."""
        parts = [metrics[f"part{i}"] or 0 for i in range(3)]
        total = sum(p << (PART_BITS * i) for i, p in enumerate(parts)) % 2**64
        return cls(metrics["rows"] or 0, total, (metrics["mix"] or 0) % 2**64)

    @classmethod
    def parse(cls, text: str) -> ContentDigest:
        rows, total, mix = text.strip().split(":")
        return cls(int(rows), int(total, 16), int(mix, 16))

    def __str__(self) -> str:
        return f"{self.rows}:{self.total:016x}:{self.mix:016x}"


def _hashable(name: str, kind: DataType) -> Column:
    """A value whose hash tells nulls apart at any depth; nested values are spelled out."""
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        return F.to_json(F.struct(qcol(name)), {"ignoreNullFields": "false"})
    return qcol(name)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row: names, values and which of them are null; the order of the columns does not matter."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    nulls = F.concat(F.lit(""), *[F.when(qcol(f.name).isNull(), "0").otherwise("1") for f in fields])
    names = F.lit("\x1f".join(f.name for f in fields))
    return F.xxhash64(names, nulls, *[_hashable(f.name, f.dataType) for f in fields])


def digest_columns(df: DataFrame) -> list[Column]:
    """Aggregates of a content digest, for ``agg`` or ``observe``."""
    h = row_hash(df)
    parts = [h.bitwiseAND(PART_MASK), F.shiftright(h, PART_BITS).bitwiseAND(PART_MASK), F.shiftright(h, 2 * PART_BITS)]
    return [F.count(F.lit(1)).alias("rows"), *[F.sum(p).alias(f"part{i}") for i, p in enumerate(parts)], F.bit_xor(h).alias("mix")]


def content_digest(df: DataFrame) -> ContentDigest:
    """Digest of a table's rows, one aggregate pass."""
    return ContentDigest.of(df.agg(*digest_columns(df)).first().asDict())  # one row


# ----------------------------------------------------------------- folders


def _fs(spark: SparkSession, path: str):
    """(file system, path object) of the cluster's storage."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def write_marker(spark: SparkSession, folder: str, digest: ContentDigest) -> None:
    """The version counts from now on; fails where it was marked before."""
    fs, where = _fs(spark, f"{folder}/{MARKER}")
    out = fs.create(where, False)
    try:
        out.write(bytearray(str(digest).encode()))
    finally:
        out.close()


def read_marker(spark: SparkSession, folder: str) -> ContentDigest | None:
    """The digest that a version was written with, None where there is none."""
    fs, where = _fs(spark, f"{folder.rstrip('/')}/{MARKER}")
    if not fs.exists(where):
        return None
    source = fs.open(where)
    try:
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return ContentDigest.parse(raw)


def versions(spark: SparkSession, root: str, marked: bool = True) -> list[str]:
    """Version folders below ``root``, oldest first; those without a marker only with ``marked=False``."""
    fs, where = _fs(spark, root)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    found = sorted((int(m.group(1)), n) for n in names if (m := VERSION.match(n)))
    paths = [f"{root.rstrip('/')}/{n}" for _, n in found]
    return [p for p in paths if not marked or fs.exists(_fs(spark, f"{p}/{MARKER}")[1])]


def current_version(spark: SparkSession, root: str) -> str | None:
    """The newest marked version below ``root``."""
    known = versions(spark, root)
    return known[-1] if known else None


def next_version(spark: SparkSession, root: str) -> str:
    """A new folder name after all others, failed ones included; concurrent writers get different names."""
    known = versions(spark, root, marked=False)
    number = int(VERSION.match(known[-1].rsplit("/", 1)[1]).group(1)) + 1 if known else 1
    return f"{root.rstrip('/')}/v{number:06d}-{uuid.uuid4().hex[:8]}"


def prune_versions(spark: SparkSession, root: str, current: str, keep: int) -> None:
    """Delete all but ``keep`` of the marked versions before ``current``; unmarked ones may be another writer's."""
    known = versions(spark, root)
    older = known[: known.index(current)] if current in known else []
    for path in older[: max(0, len(older) - keep)]:
        delete_folder(spark, path)


__all__ = [
    "ContentDigest",
    "content_digest",
    "current_version",
    "digest_columns",
    "next_version",
    "prune_versions",
    "read_marker",
    "row_hash",
    "versions",
    "write_marker",
]
