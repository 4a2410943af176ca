"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """``df`` written as a parquet table in the shared folder and read back (lineage cut).

    ``tasks``, from a known size, bounds the tasks and files of the last stage:
    a few rows need not go through every shuffle partition.
    """
    path = scratch_path(df.sparkSession, name)
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids fall into fold 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % modulus, F.lit(1))


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    return fold(id_col, modulus) == remainder


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (its own type) and the text as a string, under fixed names."""
    return docs.select(qcol(id_col).alias("id"), qcol(text_col).cast("string").alias("text"))


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def blocks_for(total_bytes: int, block_bytes: int, at_least: int) -> int:
    """How many blocks hold ``total_bytes`` at about ``block_bytes`` each."""
    return max(at_least, math.ceil(total_bytes / block_bytes))


def slices(batch, column: int, max_bytes: int = 1 << 20):
    """Consecutive parts of an Arrow batch with about ``max_bytes`` of text each (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    sums = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = sums[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sums, before + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
