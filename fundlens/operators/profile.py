"""Profiles: schema, shape, nulls, cardinality, numeric ranges, key columns.

Every profile returns a DataFrame in long form (one row per dataset and
column) and is a single Spark job where the data allows: all null counts of
a table come from one aggregate, all numeric statistics from another.
Nothing is collected to the driver; the only driver-side inputs are schema
metadata (column names and types).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    FractionalType,
    IntegralType,
    LongType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from fundlens.functions.columns import qcol
from fundlens.functions.exact import UnitMoments, WideMean


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _pct(part, whole):
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


# ------------------------------------------------------------------ schema


SCHEMA_PROFILE = StructType(
    [
        StructField("dataset", StringType(), False),
        StructField("ordinal", LongType(), False),
        StructField("column_name", StringType(), False),
        StructField("data_type", StringType(), False),
        StructField("nullable", BooleanType(), False),
    ]
)


def profile_schema(spark: SparkSession, dfs: Mapping[str, DataFrame]) -> DataFrame:
    """Column names and types per dataset (metadata only, no scan)."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in dfs.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, SCHEMA_PROFILE)


def profile_shape(dfs: Mapping[str, DataFrame]) -> DataFrame:
    """Row count, column count and column list per dataset, in one job."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"),
            F.col("row_count"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            F.lit(", ".join(df.columns)).alias("columns"),
        )
        for name, df in dfs.items()
    ]
    return union_all(frames)


# ------------------------------------------------------------------- nulls


def null_counts(df: DataFrame, dataset: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, with the row count and null percentage.

    One aggregate pass computes every column's count; the single result row
    is turned into one row per column with ``inline``.  NaN is a value, not
    a null.
    """
    cols = list(columns) if columns is not None else list(df.columns)
    aliases = [f"n{i}" for i in range(len(cols))]
    agg = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(F.when(qcol(c).isNull(), 1)).alias(a) for c, a in zip(cols, aliases)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(a).alias("null_count"))
            for c, a in zip(cols, aliases)
        ]
    )
    long = agg.select(F.lit(dataset).alias("dataset"), F.col("row_count"), F.inline(pairs))
    return long.select(
        "dataset",
        "column_name",
        "null_count",
        "row_count",
        _pct(F.col("null_count"), F.col("row_count")).alias("null_pct"),
    )


def null_ranking(profile: DataFrame) -> DataFrame:
    """Columns that have nulls, most nulls first (name breaks ties)."""
    return profile.filter(F.col("null_count") > 0).orderBy(
        F.col("dataset"), F.col("null_count").desc(), F.col("column_name")
    )


def null_total(profile: DataFrame) -> DataFrame:
    """Sum of nulls over all columns, per dataset."""
    return profile.groupBy("dataset").agg(F.sum("null_count").alias("total_nulls"))


# ------------------------------------------------------------- cardinality


def _distinct_supported(field: StructField) -> bool:
    return not isinstance(field.dataType, MapType)


def _distinct_batch(df: DataFrame, cols: Sequence[str], approx: bool, rsd: float) -> DataFrame:
    """(column_name, distinct_count) for ``cols`` from one aggregate."""
    aliases = [f"d{i}" for i in range(len(cols))]
    if approx:
        aggs = [F.approx_count_distinct(qcol(c), rsd).alias(a) for c, a in zip(cols, aliases)]
    else:
        aggs = [F.count_distinct(qcol(c)).alias(a) for c, a in zip(cols, aliases)]
    if len(cols) == 1:
        return df.agg(*aggs).select(F.lit(cols[0]).alias("column_name"), F.col("d0").alias("distinct_count"))
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(a).alias("distinct_count"))
            for c, a in zip(cols, aliases)
        ]
    )
    return df.agg(*aggs).select(F.inline(pairs))


def distinct_counts(
    df: DataFrame,
    dataset: str,
    columns: Sequence[str] | None = None,
    approx: bool = False,
    rsd: float = 0.05,
    single_pass: bool = False,
    batch_size: int = 1,
) -> DataFrame:
    """Distinct non-null values per column.

    Exact (default): small aggregates over batches of columns, combined with
    ``union`` into one job.  With one column per batch (the default) each
    branch reads only its own column from a columnar source and de-duplicates
    map-side before its shuffle, avoiding the row-multiplying ``Expand`` of
    many ``countDistinct`` in one aggregate; a larger ``batch_size`` bounds
    the number of scans and the plan size of very wide tables.  ``single_pass=True`` puts every column in one
    aggregate, which computes an expensive derived DataFrame only once.
    ``approx=True`` uses HyperLogLog++ sketches in a single pass (relative
    error ``rsd``), the choice for very wide or very large tables.  Columns of
    a type without equality (maps) get a null count.
    """
    fields = {f.name: f for f in df.schema.fields}
    cols = list(columns) if columns is not None else list(df.columns)
    ok = [c for c in cols if _distinct_supported(fields[c])]
    if approx or single_pass:
        size = max(len(ok), 1)
    else:
        size = batch_size
    parts = [_distinct_batch(df, ok[i : i + size], approx, rsd) for i in range(0, len(ok), size)]
    bad = [c for c in cols if c not in ok]
    if bad:
        parts.append(
            df.sparkSession.createDataFrame(
                [(c, None) for c in bad], "column_name string, distinct_count bigint"
            )
        )
    out = union_all(parts)
    return out.select(F.lit(dataset).alias("dataset"), "column_name", "distinct_count")


def top_cardinality(profile: DataFrame, n: int = 15) -> DataFrame:
    """Of each dataset the ``n`` columns with most distinct values (unknown counts sort as 0).

    Ties go to the smaller column name.  The window runs over the profile, one row per column.
    """
    by_count = Window.partitionBy("dataset").orderBy(F.coalesce("distinct_count", F.lit(0)).desc(), "column_name")
    ranked = profile.withColumn("__rank", F.row_number().over(by_count))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")


def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the sample is deterministic (top-n sort)."""
    if order_by:
        return df.orderBy(*[qcol(c) for c in order_by]).limit(n)
    return df.limit(n)


# ----------------------------------------------------------------- numeric


def numeric_columns(df: DataFrame, max_columns: int | None = None) -> list[str]:
    """Names of the numeric columns (any ``NumericType``); only the first ``max_columns`` if asked."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return names if max_columns is None else names[:max_columns]


def numeric_stats(
    df: DataFrame,
    dataset: str,
    columns: Sequence[str] | None = None,
    stddev: bool = True,
    exact_scale: int | None = None,
) -> DataFrame:
    """min, max, avg and sample stddev per numeric column, in one pass.

    With ``exact_scale=k`` avg and stddev come from exact integer sums of the
    values and their squares in units of 10**-k (integer columns: of 1), so
    they do not depend on the order of the rows; values round half up to a unit
    and must be below 9e18 units.  Without a stddev, avg is exact to 10**-12
    for any magnitude (:class:`fundlens.functions.exact.WideMean`).  The
    default, plain double sums, is faster; its last bits depend on the order.

    Values are reported as double; ``exact_min`` and ``exact_max`` spell the
    extremes of integer and decimal columns, which a double may not hold (null
    for floating columns).  An all-null column yields nulls rather than
    disappearing; without a numeric column there are no rows.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, averages, deviations = [], [], []
    for i, c in enumerate(cols):
        v = qcol(c).cast("double")
        aggs += [F.min(qcol(c)).alias(f"mn{i}"), F.max(qcol(c)).alias(f"mx{i}")]
        if exact_scale is None:
            aggs.append(F.avg(v).alias(f"av{i}"))
            if stddev:
                aggs.append(F.stddev_samp(v).alias(f"sd{i}"))
            averages.append(F.col(f"av{i}"))
            deviations.append(F.col(f"sd{i}"))
        elif stddev:
            moments = UnitMoments(qcol(c), 0 if isinstance(types[c], IntegralType) else exact_scale, f"m{i}")
            aggs += moments.aggregates()
            averages.append(moments.average())
            deviations.append(moments.stddev())
        else:
            mean = WideMean(qcol(c), f"m{i}")
            aggs += mean.aggregates()
            averages.append(mean.average())
    if not cols:
        empty = "dataset string, column_name string, min double, max double, exact_min string, exact_max string, avg double"
        return df.sparkSession.createDataFrame([], empty + (", stddev double" if stddev else ""))
    agg = df.agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        spell = lambda x, floating=isinstance(types[c], FractionalType) and not isinstance(types[c], DecimalType): (
            F.lit(None).cast("string") if floating else F.col(x).cast("string")
        )
        fields = [
            F.lit(c).alias("column_name"),
            F.col(f"mn{i}").cast("double").alias("min"),
            F.col(f"mx{i}").cast("double").alias("max"),
            spell(f"mn{i}").alias("exact_min"),
            spell(f"mx{i}").alias("exact_max"),
            averages[i].alias("avg"),
        ]
        if stddev:
            fields.append(deviations[i].alias("stddev"))
        structs.append(F.struct(*fields))
    return agg.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*structs)))


# The feature groups reported by the feature statistics.
FEATURE_STAT_GROUPS = {
    "project": (
        "beneficiary_to_funding_ratio",
        "need_to_requirements_ratio",
        "targeting_coverage_rate",
        "funding_gap_pct",
        "funding_coverage_rate",
        "cost_per_beneficiary",
    ),
    "population": (
        "cost_per_capita",
        "requirement_per_capita",
        "funding_coverage_pct",
        "requirement_coverage_pct",
    ),
    "sector": (
        "project_funding_share_of_sector_pct",
        "project_requirement_share_of_sector_pct",
        "sector_funding_efficiency_pct",
        "project_funding_status_vs_sector_avg",
    ),
}


def feature_stats(
    features: DataFrame, groups: Mapping[str, Sequence[str]] = FEATURE_STAT_GROUPS, exact: bool = False
) -> DataFrame:
    """min, max and avg of the feature columns, with their group, in one pass.

    ``exact=True`` makes avg independent of the order of the rows (see :func:`numeric_stats`).
    """
    group_of = {c: g for g, cols in groups.items() for c in cols}
    stats = numeric_stats(features, "features", list(group_of), stddev=False, exact_scale=0 if exact else None)
    mapping = F.create_map(*[x for c, g in group_of.items() for x in (F.lit(c), F.lit(g))])
    return stats.select(
        mapping[F.col("column_name")].alias("feature_group"),
        F.col("column_name").alias("feature"),
        "min",
        "max",
        "avg",
    )


# -------------------------------------------------------------------- keys


def _value_counts(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(c, one slot per data type, occurrences): each column's distinct values with their rows, from one scan.

    Every row gives one entry per column, de-duplicated map-side before the one
    shuffle, so a value that a third of all rows hold costs one entry per task.
    The slot of a column's type holds its value and keeps its order; nulls are
    an entry of their own.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = list(dict.fromkeys(types[c].simpleString() for c in columns))
    slots = [f"v{j}" for j in range(len(kinds))]
    entries = [
        F.struct(
            F.lit(i).alias("c"),
            *[(qcol(c) if types[c].simpleString() == k else F.lit(None)).cast(k).alias(v) for k, v in zip(kinds, slots)],
        )
        for i, c in enumerate(columns)
    ]
    counted = df.select(F.inline(F.array(*entries))).groupBy("c", *slots).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted, slots


def _with_names(columns: Sequence[str], found: DataFrame) -> DataFrame:
    """``found`` (by ``c``) beside every column's name, also of a table without rows."""
    names = found.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column_name string")
    return names.join(found, "c", "left")


def _held(slots: Sequence[str]):
    """Whether an entry is a value, not the null entry."""
    held = F.col(slots[0]).isNotNull()
    for v in slots[1:]:
        held = held | F.col(v).isNotNull()
    return held


def _key_counts(counted: DataFrame, slots: Sequence[str]) -> DataFrame:
    held = _held(slots)
    return counted.groupBy("c").agg(
        F.sum("occurrences").alias("row_count"),
        F.sum(F.when(~held, F.col("occurrences")).otherwise(0)).alias("null_count"),
        F.count(F.when(held, 1)).alias("distinct_count"),
    )


def _smallest(counted: DataFrame, slots: Sequence[str], n: int) -> DataFrame:
    """(c, sample_rank, sample_value, occurrences) of each column's ``n`` smallest values.

    Each task passes on at most ``n`` entries a column (a group limit below the
    shuffle).  The null entry is ranked last and taken off afterwards: a filter
    before would be pushed below the shuffle, which then served the counts no more.
    """
    text = F.coalesce(*[F.col(v).cast("string") for v in slots])
    first = Window.partitionBy("c").orderBy(F.when(_held(slots), 0).otherwise(1), *slots)
    ranked = counted.withColumn("sample_rank", F.row_number().over(first)).filter(F.col("sample_rank") <= n)
    return ranked.filter(_held(slots)).select("c", "sample_rank", text.alias("sample_value"), "occurrences")


def key_profile(
    df: DataFrame, dataset: str, columns: str | Sequence[str], batch_size: int | None = None
) -> DataFrame:
    """Null count, null % and exact distinct non-null count of key columns, from one scan.

    ``batch_size`` splits many columns into several scans if asked.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    if batch_size and len(cols) > batch_size:
        return union_all(
            [key_profile(df, dataset, cols[i : i + batch_size], batch_size) for i in range(0, len(cols), batch_size)]
        )
    found = _with_names(cols, _key_counts(*_value_counts(df, cols)))
    counts = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("null_count", "row_count", "distinct_count")}
    long = found.select(F.lit(dataset).alias("dataset"), "column_name", *counts.values())
    return long.select(
        "dataset",
        "column_name",
        "null_count",
        "row_count",
        _pct(F.col("null_count"), F.col("row_count")).alias("null_pct"),
        "distinct_count",
    )


def key_samples(df: DataFrame, dataset: str, columns: str | Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` smallest distinct non-null values of each column, as text, ranked, from one scan."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    found = _with_names(cols, _smallest(*_value_counts(df, cols), n)).filter(F.col("sample_rank").isNotNull())
    return found.orderBy("c", "sample_rank").select(F.lit(dataset).alias("dataset"), "column_name", "sample_rank", "sample_value")


def key_report(df: DataFrame, dataset: str, columns: str | Sequence[str], n: int = 5) -> DataFrame:
    """:func:`key_profile` with ``samples`` beside the counts: the ``n`` smallest values and how many rows hold each.

    Counts and samples share one scan and one shuffle of the distinct values
    (Spark reuses the exchange for both).
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    counted, slots = _value_counts(df, cols)
    ranked = _smallest(counted, slots, n)
    entry = F.struct("sample_rank", F.struct(F.col("sample_value").alias("value"), "occurrences").alias("s"))
    samples = ranked.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["s"]).alias("samples"))
    found = _with_names(cols, _key_counts(counted, slots)).join(samples, "c", "left")
    rows = F.coalesce("row_count", F.lit(0))
    nulls = F.coalesce("null_count", F.lit(0))
    return found.select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        nulls.alias("null_count"),
        rows.alias("row_count"),
        _pct(nulls, rows).alias("null_pct"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        F.coalesce("samples", F.array().cast("array<struct<value:string,occurrences:bigint>>")).alias("samples"),
    )


def configured_columns(
    dfs: Mapping[str, DataFrame], config: Mapping[str, Sequence[str]]
) -> list[tuple[str, str]]:
    """(dataset, column) pairs of ``config`` that exist; absent ones are skipped."""
    return [
        (name, c)
        for name, cols in config.items()
        if name in dfs
        for c in cols
        if c in dfs[name].columns
    ]


def _by_dataset(pairs: Sequence[tuple[str, str]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for d, c in pairs:
        out.setdefault(d, []).append(c)
    return out


def key_profiles(dfs: Mapping[str, DataFrame], config: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """:func:`key_profile` for every configured column present, one scan per dataset."""
    present = _by_dataset(configured_columns(dfs, config))
    return union_all([key_profile(dfs[d], d, cols) for d, cols in present.items()]) if present else None


def key_samples_all(
    dfs: Mapping[str, DataFrame],
    config: Mapping[str, Sequence[str]],
    n: int = 5,
    materialize_inputs: bool = False,
) -> DataFrame | None:
    """:func:`key_samples` for every configured column present, one scan per dataset.

    ``materialize_inputs`` has no effect any more: an input is computed once anyway.
    """
    present = _by_dataset(configured_columns(dfs, config))
    return union_all([key_samples(dfs[d], d, cols, n) for d, cols in present.items()]) if present else None


def key_reports(dfs: Mapping[str, DataFrame], config: Mapping[str, Sequence[str]], n: int = 5) -> DataFrame | None:
    """:func:`key_report` for every configured column present, one scan per dataset."""
    present = _by_dataset(configured_columns(dfs, config))
    return union_all([key_report(dfs[d], d, cols, n) for d, cols in present.items()]) if present else None


# Name fragments that mark candidate join keys, per key kind.
JOIN_KEY_TERMS = {
    "country": ("country", "countrycode", "code", "iso3", "iso2"),
    "cluster": ("cluster", "sector", "cluster_name", "sector_name", "clustercode", "clusterid"),
    "year": ("year", "date_year", "year_start", "year_end"),
    "appeal_id": ("appeal", "appeal_id", "appeal_code", "plan_id", "activity_id"),
    "funding": ("funding", "amount", "value"),
}


def join_key_candidates(
    spark: SparkSession,
    dfs: Mapping[str, DataFrame],
    terms: Mapping[str, Sequence[str]] = JOIN_KEY_TERMS,
) -> DataFrame:
    """(dataset, lower-cased column, key kind) for names containing a kind's term.

    Column names are metadata; they are matched by a Spark expression over a
    DataFrame of names (no join).  One name may match several kinds.
    """
    names = spark.createDataFrame(
        [(d, c) for d, df in dfs.items() for c in df.columns],
        "dataset string, column_name string",
    )
    kinds = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.array(*[F.lit(t) for t in ts]).alias("terms"))
            for k, ts in terms.items()
        ]
    )
    lowered = names.select("dataset", F.lower(F.col("column_name")).alias("lname"))
    hits = F.filter(
        kinds, lambda s: F.exists(s["terms"], lambda t: F.col("lname").contains(t))
    )
    return lowered.select(
        "dataset",
        F.col("lname").alias("column_name"),
        F.explode(F.transform(hits, lambda s: s["kind"])).alias("key_kind"),
    ).distinct()
