"""Profiles kept as mergeable state: a table that grows is never profiled from the start again.

Per load partition and column the state holds a row count, a null count and an
HLL sketch of the distinct values.  Updating reads only partitions the state
does not know; merging adds the counts and unites the sketches
(``hll_union_agg``), which costs the size of the state, not of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, FractionalType, IntegralType, MapType, StringType, StructType

from fundlens.functions.columns import qcol
from fundlens.sinks.versions import ContentDigest, VERSION, delete_folder, next_version, versions, write_marker

# log2 of a sketch's registers: 2^14 give a standard error of 0.8 %.
SKETCH_BITS = 14
# Up to this many new partitions are named in the scan's partition filter; more become a semi join.
NAMED_PARTITIONS = 1000

STATE_SCHEMA = "dataset string, part string, column_name string, batch long, row_count long, null_count long, distinct_sketch binary"


def _sketchable(name: str, kind: DataType) -> Column:
    """A value of a type that sketches take, equal for equal values."""
    c = qcol(name)
    if isinstance(kind, IntegralType):
        return c.cast("bigint")
    if isinstance(kind, (StringType, BinaryType)):
        return c
    if isinstance(kind, FractionalType):
        return (c + F.lit(0).cast(kind)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c), {"ignoreNullFields": "false"}))
    return c.cast("string")


def part_key(partition_by: Sequence[str]) -> Column:
    """A load partition as text."""
    return F.to_json(F.struct(*[qcol(c) for c in partition_by]), {"ignoreNullFields": "false"})


def partition_profiles(
    df: DataFrame, dataset: str, partition_by: Sequence[str], batch: int = 1, columns: Sequence[str] | None = None
) -> DataFrame:
    """State rows of ``df``: per load partition and column the row count, null count and sketch, from one pass.

    Partial aggregates are merged map-side, so a partition that holds most rows costs no more than another.
    """
    cols = [c for c in (columns or df.columns) if c not in partition_by]
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for i, c in enumerate(cols):
        value = _sketchable(c, types[c])
        aggs += [F.count(F.when(qcol(c).isNull(), 1)).alias(f"n{i}"), F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias(f"s{i}")]
    per_part = df.groupBy(part_key(partition_by).alias("part")).agg(*aggs)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"), F.col(f"s{i}").alias("distinct_sketch"))
            for i, c in enumerate(cols)
        ]
    )
    long = per_part.select("part", "row_count", F.inline(entries))
    return long.select(
        F.lit(dataset).alias("dataset"),
        "part",
        "column_name",
        F.lit(batch).cast("long").alias("batch"),
        "row_count",
        "null_count",
        "distinct_sketch",
    )


def merged_profile(state: DataFrame) -> DataFrame:
    """(dataset, column_name, row_count, null_count, null_pct, distinct_estimate) of a state.

    Of a partition profiled more than once the latest batch counts.
    """
    latest = state.groupBy("dataset", "part", "column_name").agg(
        F.max_by(F.struct("row_count", "null_count", "distinct_sketch"), "batch").alias("s")
    )
    united = latest.groupBy("dataset", "column_name").agg(
        F.sum("s.row_count").alias("row_count"),
        F.sum("s.null_count").alias("null_count"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("s.distinct_sketch")), F.lit(0)).alias("distinct_estimate"),
    )
    pct = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count") * 100).otherwise(F.lit(0.0))
    return united.select("dataset", "column_name", "row_count", "null_count", pct.alias("null_pct"), "distinct_estimate")


class ProfileState:
    """The stored state below ``path``, one folder per update; a failed update leaves nothing behind.

    ``partition_by`` names the columns of a load that is complete once it is
    there, best the ones the table is laid out by: known partitions are then
    pruned from the scan.  A partition that changed after all is named in
    ``refresh``.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        folders = versions(self.spark, self.path)
        if not folders:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(*folders)

    def profile(self) -> DataFrame:
        return merged_profile(self.rows())

    def update(
        self,
        df: DataFrame,
        dataset: str,
        partition_by: Sequence[str],
        columns: Sequence[str] | None = None,
        refresh: Sequence[tuple] = (),
    ) -> int:
        """Profile the partitions of ``df`` that the state lacks; returns how many they are."""
        partition_by = list(partition_by)
        fresh = self.unknown(df, dataset, partition_by, refresh)
        new = fresh.limit(NAMED_PARTITIONS + 1).toArrow().to_pylist()
        if not new:
            return 0
        if len(new) <= NAMED_PARTITIONS:
            todo, count = df.filter(_any_of(partition_by, [tuple(r.values()) for r in new])), len(new)
        else:
            same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(fresh[c]) for c in partition_by])
            todo, count = df.join(fresh, same, "left_semi"), fresh.count()
        folder = next_version(self.spark, self.path)
        batch = int(VERSION.match(folder.rsplit("/", 1)[1]).group(1))
        try:
            partition_profiles(todo, dataset, partition_by, batch, columns).write.parquet(folder)
            write_marker(self.spark, folder, ContentDigest(count, 0, 0))
        except Exception:
            delete_folder(self.spark, folder)
            raise
        return count

    def unknown(self, df: DataFrame, dataset: str, partition_by: Sequence[str], refresh: Sequence[tuple] = ()) -> DataFrame:
        """The load partitions of ``df`` that the state does not hold, and those to refresh."""
        known = self.rows().filter(F.col("dataset") == dataset).select("part").distinct()
        there = df.select(*[qcol(c) for c in partition_by]).distinct().withColumn("part", part_key(partition_by))
        fresh = there.join(known, "part", "left_anti")
        if refresh:
            fresh = fresh.unionByName(there.filter(_any_of(partition_by, list(refresh)))).distinct()
        return fresh.select(*[qcol(c) for c in partition_by])


def _any_of(columns: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether ``columns`` hold one of ``values``, in a form that prunes partitions."""
    if len(columns) == 1:
        given = [v[0] for v in values if v[0] is not None]
        found = qcol(columns[0]).isin(given) if given else F.lit(False)
        return found | qcol(columns[0]).isNull() if len(given) < len(values) else found
    each = [reduce(lambda a, b: a & b, [qcol(c).eqNullSafe(F.lit(x)) for c, x in zip(columns, v)]) for v in values]
    return reduce(lambda a, b: a | b, each)


__all__ = ["ProfileState", "merged_profile", "partition_profiles"]
