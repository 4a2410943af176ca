"""Left outer equi-joins of the base table with pre-aggregated inputs.

The right sides are aggregates keyed on the join keys, so each base row
matches at most once and the base row count is preserved.  Null keys never
match, so such base rows keep nulls (filled later).

Broadcast policy: a right side is broadcast only after its size was checked
(:func:`broadcast_if_small`: materialize it to the shared checkpoint folder,
observe its row count in the same job, hint a broadcast under the bound).  Above the bound the join
is a shuffle join whose hot keys are dealt over several tasks (:func:`skew_join`):
they are found beforehand, their base rows salted and their one row of the right
side replicated.  Leaving the choice to AQE alone is not enough: AQE converts a sort-merge join only after
the aggregate stage finished, and by then the big side's shuffle may already
have run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.operators.aggregate import NEEDS_MEASURES
from fundlens.operators.standardize import with_columns_if_missing
from fundlens.session import run_concurrently

# Default bound for broadcasting a pre-aggregated side: rows of a few short
# keys and four numbers, so about 50 MB at most.
BROADCAST_MAX_ROWS = 500_000
# And of its values' bytes, whatever the rows.
BROADCAST_MAX_BYTES = 64 << 20

NEEDS_JOIN_KEYS = ("country_code", "cluster_code")


def materialize(df: DataFrame, as_table: bool = False) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and cut its lineage.

    Default: a reliable ``checkpoint()`` (never a local one), right for small
    tables.  ``as_table=True`` writes a parquet table there instead and reads
    it back: compressed and columnar (about a tenth of the checkpoint's size
    for the feature base), splittable, and with file statistics for the
    planner; the choice for large intermediates.  Either survives the loss of
    the executors that computed it.
    """
    from fundlens.session import checkpoint_root, scratch_path

    spark = df.sparkSession
    checkpoint_root(spark)
    if not as_table:
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "table")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: the length of text and binary, 8 for a number, 8 per element of an array."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), qcol(f.name)
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + 8
    return total


def broadcast_if_small(
    df: DataFrame, max_rows: int | None = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """``df`` materialized and, if it has at most ``max_rows`` rows and ``max_bytes`` bytes, hinted for broadcast.

    ``max_rows=None`` returns ``df`` unchanged and lazy (Spark and AQE pick
    the join).  Meant for derived tables whose size is not known in advance
    but usually small, such as per-group totals.
    """
    if max_rows is None:
        return df
    mat, small = size_checked(df, max_rows, max_bytes)
    return F.broadcast(mat) if small else mat


def size_checked(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """``df`` materialized, and whether it is within the bounds."""
    # rows and bytes are observed while the checkpoint job runs: no second job
    size = Observation()
    seen = df.observe(size, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes"))
    mat = materialize(seen)
    return mat, size.get["rows"] <= max_rows and (size.get["bytes"] or 0) <= max_bytes


@dataclass(frozen=True)
class SizedSide:
    """A materialized right side: broadcast if ``small``, else joined by :func:`skew_join`."""

    frame: DataFrame
    small: bool

    @classmethod
    def of(cls, df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> SizedSide:
        return cls(*size_checked(df, max_rows))


# Keys with fewer rows are never worth dealing out.
HOT_MIN_ROWS = 1000


def hot_keys(base: DataFrame, keys: Sequence[str], tasks: int | None = None, min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """(keys, salts) of the keys that hold more than a task's share of ``base``, null keys included.

    The share is 1 / ``tasks`` of all rows (default: the shuffle partitions), so
    there are fewer hot keys than tasks, whatever the table, and their salts add
    up to less than twice the tasks.  One pass over the key columns; partial
    counts are merged map-side.
    """
    tasks = tasks or int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = materialize(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), as_table=True)
    total = counted.agg(F.sum("rows").alias("total")).first().total or 0  # one row
    share = max(min_rows, total // tasks)
    return counted.filter(F.col("rows") > share).select(*keys, F.ceil(F.col("rows") / share).cast("int").alias("salts"))


def skew_join(base: DataFrame, right: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """base ⟕ right on ``keys`` by a shuffle that no hot key unbalances; the columns of a using-join.

    ``right`` may have several rows a key.  Base rows of a hot key are dealt over
    its salts by a hash of the whole row (a rerun deals alike), the key's right
    rows are repeated once per salt, all other rows have salt 0.  Null keys
    match nothing but are dealt out too.  Only the list of hot keys, fewer than
    ``tasks`` rows, is broadcast; the base is read once more for the counts.
    """
    found = materialize(hot_keys(base, keys, tasks))
    if found.isEmpty():
        return base.join(right, on=list(keys), how="left")
    hot = F.broadcast(found).select(*[F.col(k).alias(f"__hot{i}") for i, k in enumerate(keys)], F.col("salts").alias("__salts"))

    def with_salts(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(hot[f"__hot{i}"]) for i, k in enumerate(keys)])
        return df.join(hot, same, "left").drop(*[f"__hot{i}" for i in range(len(keys))])

    whole = F.xxhash64(*[qcol(c) for c in base.columns])
    salt = F.coalesce(F.pmod(whole, F.col("__salts")), F.lit(0)).cast("int")
    left = with_salts(base).withColumn("__salt", salt).drop("__salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))
    spread = with_salts(right).withColumn("__salt", copies).drop("__salts")
    return left.join(spread, [*keys, "__salt"], "left").drop("__salt")


def broadcast_all_if_small(
    frames: Mapping[str, DataFrame | None], max_rows: int | None = BROADCAST_MAX_ROWS
) -> dict[str, DataFrame | None]:
    """:func:`broadcast_if_small` for independent tables, run as concurrent Spark jobs."""
    present = {k: v for k, v in frames.items() if v is not None}
    out: dict[str, DataFrame | None] = {k: None for k in frames}
    if not present:
        return out
    spark = next(iter(present.values())).sparkSession
    tasks = {k: (lambda d=v: broadcast_if_small(d, max_rows)) for k, v in present.items()}
    out.update(run_concurrently(spark, tasks))
    return out


POPULATION_JOIN_KEYS = ("country_code", "year")


def _join_side(base: DataFrame, side: DataFrame | SizedSide | None, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    if side is None:
        return with_columns_if_missing(base, measures)
    frame = side.frame if isinstance(side, SizedSide) else side
    right = frame.select(*keys, *measures)
    if isinstance(side, SizedSide):
        if not side.small:
            return skew_join(base, right, keys)
        right = F.broadcast(right)
    return base.join(right, on=list(keys), how="left")


def join_needs(base: DataFrame, needs_agg: DataFrame | SizedSide | None) -> DataFrame:
    """base ⟕ needs on (country_code, cluster_code); absent needs give null measures.

    A :class:`SizedSide` is broadcast or joined around hot keys by its size.
    """
    return _join_side(base, needs_agg, NEEDS_JOIN_KEYS, NEEDS_MEASURES)


def join_population(base: DataFrame, population_agg: DataFrame | SizedSide | None) -> DataFrame:
    """base ⟕ population on (country_code, year); absent input gives null population."""
    return _join_side(base, population_agg, POPULATION_JOIN_KEYS, ("population",))
