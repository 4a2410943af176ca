"""Registered queries: one lazy DataFrame per inventory item, over whole tables.

Each entry of :data:`QUERIES` takes ``(spark, sf_dir)`` and returns a
DataFrame built from the library's operators over the stand-ins of
``fundlens.sources.standins`` (or the driver tables themselves).
:data:`ORACLE_SQL` holds, per name, an independently written DuckDB
statement with the same result.  Money sums use ``exact_scale=2``
and reported averages and standard deviations come from exact integer sums,
so results do not depend on partitioning and match bit for bit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.multivalue import explode_multi
from fundlens.operators import profile as P
from fundlens.operators.aggregate import (
    flows_by_destination,
    needs_by_country_cluster,
    population_by_country_year,
)
from fundlens.operators.features import (
    BASE_COLUMNS,
    POPULATION_FEATURES,
    PROJECT_FEATURES,
    SECTOR_RATIOS,
    SECTOR_TOTALS,
    add_population_features,
    add_project_features,
    fill_measures,
)
from fundlens.operators.join import (
    SizedSide,
    broadcast_all_if_small,
    join_needs,
    join_population,
    materialize,
)
from fundlens.operators.profile_state import ProfileState
from fundlens.operators.quality import (
    QUALITY_KEY_COLUMNS,
    nulls_after_fill,
    StageCounts,
    quality_report,
)
from fundlens.operators.standardize import (
    FieldSpec,
    null_rows,
    standardize,
    standardize_needs,
    standardize_plans,
    standardize_population,
    standardize_requirements,
)
from fundlens.plans.features import feature_stages
from fundlens.plans import oracle as O
from fundlens.plans.oracle import EXACT, money_sql, with_standins
from fundlens.sources import standins
from fundlens.plans.workflows import ingest
from fundlens.sources.catalog import load_tables
from fundlens.sources.csv import load_datasets, read_csv_dataset, write_csv
from fundlens.sinks.tables import (
    ensure_database,
    list_tables,
    persisted,
    save_raw_tables,
    save_table,
    verify_content,
    verify_table,
)
from fundlens.sinks.versions import current_version, write_marker
from fundlens.session import run_concurrently, scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Column lists of the stand-ins, as their definitions name them.
REQUIREMENTS_RAW_COLUMNS = (
    "countryCode clusterCode cluster year id name code startDate endDate "
    "requirements funding percentFunded"
).split()
NEEDS_RAW_COLUMNS = ["country_iso3", "Cluster", "population", "In Need", "targeted", "affected", "reached"]

# Key columns whose values are profiled, per stand-in dataset.
KEY_PROFILE_CONFIG = {
    "requirements": ["countryCode", "clusterCode", "year"],
    "needs": ["country_iso3", "Cluster"],
    "population": ["ISO3", "Reference_year"],
    "plans": ["locations"],
    "flows": ["destLocations"],
}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def q(ident: str) -> str:
    """Double-quoted SQL identifier."""
    return '"' + ident.replace('"', '""') + '"'


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: standins.read_table(spark, sf_dir, t) for t in DRIVER_TABLES}


def _stages(spark: SparkSession, sf_dir: str, strategy: str = "aggregate", **kw):
    return feature_stages(
        standardize_requirements(standins.requirements_raw(spark, sf_dir)),
        standardize_needs(standins.needs_raw(spark, sf_dir)),
        standardize_population(standins.population_raw(spark, sf_dir)),
        sector_strategy=strategy,
        exact_scale=EXACT,
        **kw,
    )


def _small_sides(spark: SparkSession, sf_dir: str, *sides: str) -> dict:
    """The named per-group tables (needs, population), checked and broadcast in concurrent jobs."""
    build = {
        "needs": lambda: needs_by_country_cluster(needs_standardized(spark, sf_dir), EXACT),
        "population": lambda: population_by_country_year(population_standardized(spark, sf_dir), EXACT),
    }
    return broadcast_all_if_small({k: build[k]() for k in sides})


def _filled(spark: SparkSession, sf_dir: str, *sides: str) -> DataFrame:
    """Base ⟕ the named sides, filled; an unnamed side is absent (its measures are 0)."""
    small = _small_sides(spark, sf_dir, *sides)
    base = requirements_standardized(spark, sf_dir)
    return fill_measures(join_population(join_needs(base, small.get("needs")), small.get("population")))


# ----------------------------------------------------------- standardizers


@register("requirements_standardized", with_standins("SELECT * FROM requirements_std"))
def requirements_standardized(spark, sf_dir):
    return standardize_requirements(standins.requirements_raw(spark, sf_dir))


@register("plans_standardized", with_standins("SELECT * FROM plans_std"))
def plans_standardized(spark, sf_dir):
    return standardize_plans(standins.plans_raw(spark, sf_dir))


@register("needs_standardized", with_standins("SELECT * FROM needs_std"))
def needs_standardized(spark, sf_dir):
    return standardize_needs(standins.needs_raw(spark, sf_dir))


@register("population_standardized", with_standins("SELECT * FROM population_std"))
def population_standardized(spark, sf_dir):
    return standardize_population(standins.population_raw(spark, sf_dir))


# ------------------------------------------------------------ aggregations


@register("population_by_country_year", with_standins("SELECT * FROM population_agg"))
def q_population_by_country_year(spark, sf_dir):
    return population_by_country_year(population_standardized(spark, sf_dir), EXACT)


@register(
    "population_with_name",
    with_standins(
        f"""
SELECT country_code, year, {money_sql('population')} AS population, min(country) AS country_name
FROM population_std GROUP BY country_code, year"""
    ),
)
def q_population_with_name(spark, sf_dir):
    return population_by_country_year(population_standardized(spark, sf_dir), EXACT, with_name=True)


@register("needs_by_country_cluster", with_standins("SELECT * FROM needs_agg"))
def q_needs_by_country_cluster(spark, sf_dir):
    return needs_by_country_cluster(needs_standardized(spark, sf_dir), EXACT)


# ------------------------------------------------------------------- joins


@register("join_needs", with_standins("SELECT * FROM after_needs"))
def q_join_needs(spark, sf_dir):
    return join_needs(requirements_standardized(spark, sf_dir), _small_sides(spark, sf_dir, "needs")["needs"])


@register("join_needs_shuffled", with_standins("SELECT * FROM after_needs"))
def q_join_needs_shuffled(spark, sf_dir):
    """The same join with no side broadcast: hot keys of the base are found, salted and replicated, the rest shuffles."""
    base = materialize(requirements_standardized(spark, sf_dir), as_table=True)  # read for the counts and for the join
    side = SizedSide.of(needs_by_country_cluster(needs_standardized(spark, sf_dir), EXACT), max_rows=0)
    return join_needs(base, side)


@register("join_population", with_standins("SELECT * FROM after_population"))
def q_join_population(spark, sf_dir):
    small = _small_sides(spark, sf_dir, "needs", "population")
    base = requirements_standardized(spark, sf_dir)
    return join_population(join_needs(base, small["needs"]), small["population"])


@register(
    "join_missing_input",
    with_standins(
        """
SELECT country_code, year, cluster_code, cluster_name, appeal_id, appeal_name, appeal_code,
       startDate, endDate, total_requirements_usd,
       coalesce(total_funding_usd, CAST(0 AS DOUBLE)) AS total_funding_usd,
       coalesce(funding_percent, CAST(0 AS DOUBLE)) AS funding_percent,
       CAST(0 AS DOUBLE) AS targeted, CAST(0 AS DOUBLE) AS inneed,
       CAST(0 AS DOUBLE) AS affected, CAST(0 AS DOUBLE) AS reached,
       CAST(0 AS DOUBLE) AS population
FROM requirements_std"""
    ),
)
def q_join_missing_input(spark, sf_dir):
    """Needs and population absent: measures are added as nulls and filled."""
    base = requirements_standardized(spark, sf_dir)
    return fill_measures(join_population(join_needs(base, None), None))


@register("filled_measures", with_standins("SELECT * FROM filled"))
def q_filled_measures(spark, sf_dir):
    return _filled(spark, sf_dir, "needs", "population").select(*BASE_COLUMNS)


# ---------------------------------------------------------------- features

_FEATURE_KEYS = ("appeal_id", "country_code", "year", "cluster_code")


@register(
    "features_project",
    with_standins(f"SELECT {', '.join(O.KEYS + O.PROJECT)} FROM project_features"),
)
def q_features_project(spark, sf_dir):
    filled = _filled(spark, sf_dir, "needs")
    return add_project_features(filled).select(*_FEATURE_KEYS, *PROJECT_FEATURES)


@register(
    "features_population",
    with_standins(
        f"SELECT {', '.join(O.KEYS + O.POPULATION)} FROM population_features"
    ),
)
def q_features_population(spark, sf_dir):
    filled = _filled(spark, sf_dir, "population")
    return add_population_features(filled).select(*_FEATURE_KEYS, *POPULATION_FEATURES)


_SECTOR_SQL = with_standins(
    f"SELECT {', '.join(O.KEYS + O.SECTOR)} FROM features"
)


def _sector(spark: SparkSession, sf_dir: str, strategy: str = "aggregate", **kw) -> DataFrame:
    """The sector columns need the base alone; a strategy that reads it twice has it written once first."""
    base = requirements_standardized(spark, sf_dir)
    twice = strategy == "aggregate"
    st = feature_stages(base, None, None, sector_strategy=strategy, exact_scale=EXACT, checkpoint_base=twice, **kw)
    return st.features.select(*_FEATURE_KEYS, *SECTOR_TOTALS, *SECTOR_RATIOS)


@register("features_sector", _SECTOR_SQL)
def q_features_sector(spark, sf_dir):
    """Sector totals by partial aggregate + checked broadcast join back."""
    return _sector(spark, sf_dir)


@register("features_sector_window", _SECTOR_SQL)
def q_features_sector_window(spark, sf_dir):
    """Sector totals as windows over (country_code, year, cluster_code), salted in two levels for hot groups."""
    return _sector(spark, sf_dir, strategy="salted_window")


@register("features_sector_lazy", _SECTOR_SQL)
def q_features_sector_lazy(spark, sf_dir):
    """Sector totals by partial aggregate + a shuffle join back, which AQE splits on a hot key."""
    return _sector(spark, sf_dir, broadcast_max_rows=None)


@register("features_all", with_standins(f"SELECT {', '.join(O.FEATURES)} FROM features"))
def features_all(spark, sf_dir):
    """All 36 columns of the feature table, planned for scale.

    The stand-in requirements are derived by joins and a line-item
    aggregate, so the base is checkpointed once; the three per-group tables
    are checked and broadcast; sector totals use the aggregate strategy.
    """
    return _stages(spark, sf_dir, checkpoint_base=True).features


@register("features_all_lazy", with_standins(f"SELECT {', '.join(O.FEATURES)} FROM features"))
def features_all_lazy(spark, sf_dir):
    """The same table with the joins left to Spark/AQE; the derived base is written once."""
    return _stages(spark, sf_dir, broadcast_max_rows=None, checkpoint_base=True).features


# ------------------------------------------------------- multi-valued flows


@register(
    "flows_exploded",
    with_standins(
        """
SELECT id, destination FROM (
  SELECT id, unnest(CASE WHEN parts IS NULL OR len(parts) = 0 THEN [NULL::VARCHAR] ELSE parts END)
           AS destination
  FROM (SELECT id, list_filter(list_transform(string_split(destGlobalClusters, ','),
                                              lambda x: lower(trim(x))),
                               lambda x: x <> '') AS parts
        FROM flows_raw))"""
    ),
)
def q_flows_exploded(spark, sf_dir):
    flows = standins.flows_raw(spark, sf_dir).select("id", "destGlobalClusters")
    return explode_multi(flows, "destGlobalClusters", sep=",", out="destination", lower=True).select(
        "id", "destination"
    )


@register(
    "flows_by_destination",
    with_standins(
        f"""
SELECT destination, {money_sql("amountUSD")} AS amount_usd,
       count(*) AS flow_count
FROM (
  SELECT amountUSD,
         unnest(CASE WHEN parts IS NULL OR len(parts) = 0 THEN [NULL::VARCHAR] ELSE parts END)
           AS destination
  FROM (SELECT amountUSD, list_filter(list_transform(string_split(destGlobalClusters, ','),
                                                     lambda x: lower(trim(x))),
                                      lambda x: x <> '') AS parts
        FROM flows_raw))
GROUP BY destination"""
    ),
)
def q_flows_by_destination(spark, sf_dir):
    flows = standins.flows_raw(spark, sf_dir)
    return flows_by_destination(flows, "destGlobalClusters", "amountUSD", lower=True, exact_scale=EXACT)


# ---------------------------------------------------------------- profiles


def _null_counts_sql(dataset: str, source: str, columns) -> str:
    parts = []
    for c in columns:
        nulls = f"(count(*) - count({q(c)}))"
        parts.append(
            f"SELECT {lit(dataset)} AS dataset, {lit(c)} AS column_name, {nulls} AS null_count, "
            f"count(*) AS row_count, CASE WHEN count(*) > 0 THEN {nulls} / count(*) * 100 "
            f"ELSE CAST(0 AS DOUBLE) END AS null_pct FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


_NULL_PROFILE_SQL = (
    "(" + _null_counts_sql("requirements", "requirements_raw", REQUIREMENTS_RAW_COLUMNS)
    + "\nUNION ALL\n" + _null_counts_sql("needs", "needs_raw", NEEDS_RAW_COLUMNS) + ")"
)


def _raw_null_profile(spark, sf_dir):
    return P.null_counts(standins.requirements_raw(spark, sf_dir), "requirements").unionByName(
        P.null_counts(standins.needs_raw(spark, sf_dir), "needs")
    )


@register(
    "null_profile",
    with_standins(f"SELECT * FROM {_NULL_PROFILE_SQL} WHERE null_count > 0"),
)
def q_null_profile(spark, sf_dir):
    """Columns with nulls, with null %, for the requirements and needs inputs."""
    return P.null_ranking(_raw_null_profile(spark, sf_dir))


@register(
    "null_total",
    with_standins(
        f"SELECT dataset, CAST(sum(null_count) AS BIGINT) AS total_nulls "
        f"FROM {_NULL_PROFILE_SQL} GROUP BY dataset"
    ),
)
def q_null_total(spark, sf_dir):
    return P.null_total(_raw_null_profile(spark, sf_dir))


_DISTINCT_TABLES = {
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate".split(),
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
}
_DISTINCT_SQL = "(" + "\nUNION ALL\n".join(
    f"SELECT {lit(t)} AS dataset, {lit(c)} AS column_name, count(DISTINCT {q(c)}) AS distinct_count FROM {t}"
    for t, cols in _DISTINCT_TABLES.items()
    for c in cols
) + ")"


def _distinct_profile(spark, sf_dir):
    frames = [
        P.distinct_counts(standins.read_table(spark, sf_dir, t), t) for t in _DISTINCT_TABLES
    ]
    return frames[0].unionByName(frames[1])


@register("distinct_profile", f"SELECT * FROM {_DISTINCT_SQL}")
def q_distinct_profile(spark, sf_dir):
    """Exact distinct counts of every column of lineitem and orders (one job)."""
    return _distinct_profile(spark, sf_dir)


_STATE_COLUMNS = [c for c in _DISTINCT_TABLES["orders"] if c != "o_orderpriority"]


@register(
    "profile_state",
    "\nUNION ALL\n".join(
        f"SELECT 'orders' AS dataset, {lit(c)} AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count, true AS estimate_within_5_pct FROM orders"
        for c in _STATE_COLUMNS
    ),
)
def q_profile_state(spark, sf_dir):
    """A stored profile of orders kept through appended loads (one per priority), each read once, beside exact counts."""
    orders = standins.read_table(spark, sf_dir, "orders")
    table, state = scratch_path(spark, "orders"), ProfileState(spark, scratch_path(spark, "profile"))
    early = F.col("o_orderpriority") < "3"
    for load in (orders.filter(early), orders.filter(~early | early.isNull())):
        load.write.mode("append").partitionBy("o_orderpriority").parquet(table)
        state.update(spark.read.parquet(table), "orders", ["o_orderpriority"])
    merged = state.profile().drop("null_pct")
    exact = P.distinct_counts(orders, "orders", _STATE_COLUMNS).drop("dataset")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.col("distinct_count") * 0.05
    return merged.join(exact, "column_name").withColumn("estimate_within_5_pct", off).drop("distinct_estimate")


@register(
    "top_cardinality",
    f"""SELECT dataset, column_name, distinct_count FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY coalesce(distinct_count, 0) DESC, column_name) AS r
  FROM {_DISTINCT_SQL}) WHERE r <= 15""",
)
def q_top_cardinality(spark, sf_dir):
    """The 15 highest-cardinality columns of each dataset (a top-k report)."""
    return P.top_cardinality(_distinct_profile(spark, sf_dir), 15)


@register(
    "sample_rows",
    with_standins("SELECT * FROM requirements_std ORDER BY appeal_id LIMIT 10"),
)
def q_sample_rows(spark, sf_dir):
    """A deterministic 10-row sample of the standardized requirements (sampling operator)."""
    return P.sample_rows(requirements_standardized(spark, sf_dir), 10, order_by=["appeal_id"])


# Numeric columns of lineitem and the decimal places of the units their moments are summed in.
_LINEITEM_NUMERIC = {
    **dict.fromkeys("l_orderkey l_partkey l_suppkey l_linenumber".split(), 0),
    **dict.fromkeys("l_quantity l_extendedprice l_discount l_tax".split(), EXACT),
}


def _units(c: str, scale: int) -> str:
    return f"CAST(round(CAST({c} AS DOUBLE) * {10**scale}) AS BIGINT)" if scale else f"CAST({c} AS BIGINT)"


def _as_double(integer: str) -> str:
    """An integer of any size as the nearest double."""
    return f"CAST(CAST({integer} AS VARCHAR) AS DOUBLE)"


def _exact_avg(c: str, scale: int) -> str:
    return f"{_as_double(f'sum({_units(c, scale)})')} / CAST({10**scale} AS DOUBLE) / count({c})"


def _exact_stddev(c: str, scale: int) -> str:
    u = f"CAST({_units(c, scale)} AS HUGEINT)"
    spread = _as_double(f"count({c}) * sum({u} * {u}) - sum({u}) * sum({u})")
    return f"CASE WHEN count({c}) > 1 THEN sqrt({spread} / (CAST(count({c}) AS DOUBLE) * (count({c}) - 1))) / CAST({10**scale} AS DOUBLE) END"


def _wide_avg(c: str) -> str:
    """Average from whole parts and fractions in 10^-12, summed as integers."""
    whole = f"CAST(floor({c}) AS HUGEINT)"
    fraction = f"CAST(floor(({c} - floor({c})) * 1e12 + 0.5) AS HUGEINT)"
    return f"{_as_double(f'sum({whole}) * 1000000000000 + sum({fraction})')} / 1e12 / count({c})"


@register(
    "numeric_profile",
    "\nUNION ALL\n".join(
        f"SELECT 'lineitem' AS dataset, {lit(c)} AS column_name, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"CASE WHEN typeof(min({c})) <> 'DOUBLE' THEN CAST(min({c}) AS VARCHAR) END AS exact_min, "
        f"CASE WHEN typeof(max({c})) <> 'DOUBLE' THEN CAST(max({c}) AS VARCHAR) END AS exact_max, "
        f"{_exact_avg(c, s)} AS avg, {_exact_stddev(c, s)} AS stddev FROM lineitem"
        for c, s in _LINEITEM_NUMERIC.items()
    ),
)
def q_numeric_profile(spark, sf_dir):
    """min/max/avg/stddev of every numeric column of lineitem, one pass, avg and stddev from exact sums."""
    return P.numeric_stats(standins.read_table(spark, sf_dir, "lineitem"), "lineitem", exact_scale=EXACT)


@register(
    "feature_stats",
    with_standins(
        "\nUNION ALL\n".join(
            f"SELECT {lit(g)} AS feature_group, {lit(c)} AS feature, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"{_wide_avg(c)} AS avg FROM features"
            for g, cols in O.STAT_GROUPS.items()
            for c in cols
        )
    ),
)
def q_feature_stats(spark, sf_dir):
    """min/max/avg of the 14 reported features in their three groups, one pass, avg from exact sums."""
    return P.feature_stats(features_all(spark, sf_dir), exact=True)


def _key_pairs():
    return [(d, c) for d, cols in KEY_PROFILE_CONFIG.items() for c in cols]


@register(
    "key_profile",
    with_standins(
        "\nUNION ALL\n".join(
            f"SELECT {lit(d)} AS dataset, {lit(c)} AS column_name, "
            f"count(*) - count({q(c)}) AS null_count, count(*) AS row_count, "
            f"CASE WHEN count(*) > 0 THEN (count(*) - count({q(c)})) / count(*) * 100 "
            f"ELSE CAST(0 AS DOUBLE) END AS null_pct, "
            f"count(DISTINCT {q(c)}) AS distinct_count FROM {d}_raw"
            for d, c in _key_pairs()
        )
    ),
)
def q_key_profile(spark, sf_dir):
    """Null and distinct counts of the configured key columns of every input."""
    return P.key_profiles(standins.raw_datasets(spark, sf_dir), KEY_PROFILE_CONFIG)


@register(
    "key_samples",
    with_standins(
        "\nUNION ALL\n".join(
            f"SELECT {lit(d)} AS dataset, {lit(c)} AS column_name, "
            f"CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS sample_rank, "
            f"CAST(v AS VARCHAR) AS sample_value FROM "
            f"(SELECT DISTINCT {q(c)} AS v FROM {d}_raw WHERE {q(c)} IS NOT NULL ORDER BY v LIMIT 5)"
            for d, c in _key_pairs()
        )
    ),
)
def q_key_samples(spark, sf_dir):
    """The five smallest distinct values of each configured key column, one scan per input."""
    return P.key_samples_all(standins.raw_datasets(spark, sf_dir), KEY_PROFILE_CONFIG, 5)


@register(
    "key_report",
    with_standins(
        "\nUNION ALL\n".join(
            f"SELECT {lit(d)} AS dataset, {lit(c)} AS column_name, rows.null_count, rows.row_count, rows.distinct_count, "
            f"sample_rank, sample_value, occurrences FROM (SELECT count(*) - count({q(c)}) AS null_count, count(*) AS row_count, "
            f"count(DISTINCT {q(c)}) AS distinct_count FROM {d}_raw) rows, "
            f"(SELECT CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS sample_rank, CAST(v AS VARCHAR) AS sample_value, n AS occurrences "
            f"FROM (SELECT {q(c)} AS v, count(*) AS n FROM {d}_raw WHERE {q(c)} IS NOT NULL GROUP BY v ORDER BY v LIMIT 5))"
            for d, c in _key_pairs()
        )
    ),
)
def q_key_report(spark, sf_dir):
    """Counts and the five smallest values with their rows, of each configured key column, from one scan per input."""
    report = P.key_reports(standins.raw_datasets(spark, sf_dir), KEY_PROFILE_CONFIG, 5)
    fixed = [F.col(c) for c in ("dataset", "column_name", "null_count", "row_count", "distinct_count")]
    each = report.select(*fixed, F.posexplode("samples").alias("at", "s"))
    return each.select(*fixed, (F.col("at") + 1).alias("sample_rank"), F.col("s.value").alias("sample_value"), F.col("s.occurrences").alias("occurrences"))


_TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_NS": "timestamp_ntz",
    "TIMESTAMP_MS": "timestamp_ntz",
    "TIMESTAMP_S": "timestamp_ntz",
    "TIMESTAMP_US": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "FLOAT[]": "array<float>",
}
_TYPE_CASE = "CASE data_type " + " ".join(
    f"WHEN {lit(k)} THEN {lit(v)}" for k, v in _TYPE_NAMES.items()
) + " ELSE lower(data_type) END"
_DRIVER_TABLE_LIST = ", ".join(lit(t) for t in DRIVER_TABLES)
# Columns of the driver views, whatever catalog or schema they were registered in.
_DRIVER_COLUMNS_CTE = f"""
WITH cols AS (
  SELECT DISTINCT table_name, ordinal_position, column_name, data_type, is_nullable
  FROM information_schema.columns
  WHERE table_name IN ({_DRIVER_TABLE_LIST})
)"""


@register(
    "profile_schema",
    f"""{_DRIVER_COLUMNS_CTE}
SELECT table_name AS dataset, CAST(ordinal_position AS BIGINT) AS ordinal,
       column_name, {_TYPE_CASE} AS data_type, is_nullable = 'YES' AS nullable
FROM cols""",
)
def q_profile_schema(spark, sf_dir):
    """Column names and types of every driver table (read from each table's schema)."""
    return P.profile_schema(spark, _driver(spark, sf_dir))


@register(
    "profile_shape",
    f"""{_DRIVER_COLUMNS_CTE}
SELECT c.dataset, r.row_count, c.column_count, c.columns
FROM (SELECT table_name AS dataset, count(*) AS column_count,
             string_agg(column_name, ', ' ORDER BY ordinal_position) AS columns
      FROM cols
      GROUP BY table_name) c
JOIN ({" UNION ALL ".join(f"SELECT {lit(t)} AS dataset, count(*) AS row_count FROM {t}" for t in DRIVER_TABLES)}) r
  ON c.dataset = r.dataset""",
)
def q_profile_shape(spark, sf_dir):
    """Rows, column count and column list of every driver table (one job)."""
    return P.profile_shape(_driver(spark, sf_dir))


@register(
    "join_key_candidates",
    with_standins(
        "SELECT DISTINCT dataset, column_name, key_kind FROM (\n"
        + "\nUNION ALL\n".join(
            f"SELECT {lit(d)} AS dataset, lower(column_name) AS column_name FROM (DESCRIBE SELECT * FROM {d}_raw)"
            for d in standins.RAW_BUILDERS
        )
        + ") names JOIN (VALUES "
        + ", ".join(f"({lit(k)}, {lit(t)})" for k, ts in O.KEY_TERMS.items() for t in ts)
        + ") terms(key_kind, term) ON contains(names.column_name, terms.term)"
    ),
)
def q_join_key_candidates(spark, sf_dir):
    """Candidate join-key columns of the five inputs, by name terms."""
    return P.join_key_candidates(spark, standins.raw_datasets(spark, sf_dir))


# ----------------------------------------------------------------- quality


@register(
    "nulls_after_fill",
    with_standins(
        "SELECT * FROM ("
        + _null_counts_sql("filled", "filled", O.BASE)
        + ") WHERE null_count > 0"
    ),
)
def q_nulls_after_fill(spark, sf_dir):
    """Columns that still have nulls after the fill (requirements, keys, text)."""
    return nulls_after_fill(q_filled_measures(spark, sf_dir))


@register(
    "quality_report",
    with_standins(
        "SELECT *, column_name IN ('country_code', 'cluster_code', 'year') AS expect_non_null, false AS absent, "
        "column_name IN ('country_code', 'cluster_code', 'year') AND null_count > 0 "
        "AS expectation_failed FROM ("
        + _null_counts_sql(
            "features",
            "features",
            O.CHECKED,
        )
        + ") UNION ALL SELECT 'features', 'sector_quality_index', count(*), count(*), 100.0, false, true, true FROM features"
    ),
)
def q_quality_report(spark, sf_dir):
    """Null count/% of the 12 checked columns, the key non-null expectation and one column that is absent."""
    return quality_report(features_all(spark, sf_dir), (*QUALITY_KEY_COLUMNS, "sector_quality_index"))


_AUDIT_STAGES = (
    ("requirements_raw", "requirements_raw"),
    ("requirements_std", "requirements_std"),
    ("needs_std", "needs_std"),
    ("population_std", "population_std"),
    ("plans_std", "plans_std"),
    ("after_needs", "after_needs"),
    ("after_population", "after_population"),
    ("features", "features"),
)


@register(
    "stage_audit",
    with_standins(
        "\nUNION ALL\n".join(
            f"SELECT {i + 1} AS step, {lit(name)} AS stage, count(*) AS row_count FROM {src}"
            for i, (name, src) in enumerate(_AUDIT_STAGES)
        )
    ),
)
def q_stage_audit(spark, sf_dir):
    """Row counts after each standardization and join, observed while the pipeline runs once."""
    raw, counts = standins.raw_datasets(spark, sf_dir), StageCounts()
    requirements = standardize_requirements(counts.watch("requirements_raw", raw["requirements"]))
    needs = counts.watch("needs_std", standardize_needs(raw["needs"]))
    population = counts.watch("population_std", standardize_population(raw["population"]))
    plans = counts.watch("plans_std", standardize_plans(raw["plans"]))
    st = feature_stages(requirements, needs, population, exact_scale=EXACT, checkpoint_base=True, audit=counts)

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    # the features in one run; the plans are prepared beside them, nothing joins them
    run_concurrently(spark, {"features": lambda: run(st.features), "plans": lambda: run(plans)})
    names = F.create_map(*[F.lit(x) for i, (s, _) in enumerate(_AUDIT_STAGES) for x in (s, i + 1)])
    report = counts.report(spark).withColumn("stage", F.when(F.col("stage") == "base", "requirements_std").otherwise(F.col("stage")))
    return report.withColumn("step", names[F.col("stage")])


# -------------------------------------------------------- sources and sinks


def _flows_as_csv(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The flows and a data row that starts with "#", written with the tag record inside each data file."""
    flows = standins.flows_raw(spark, sf_dir)
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("id"), F.lit("a row whose organization starts with a hash").alias("description"),
        F.lit(1.5).alias("amountUSD"), F.lit("#1 region").alias("srcOrganization"), F.lit("#1 region").alias("destGlobalClusters"), F.lit("EN").alias("destLocations"),
    )
    # source first, so that the hash is in the first field
    order = ["srcOrganization", *[c for c in flows.columns if c != "srcOrganization"]]
    rows = flows.unionByName(extra).select(order)
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in order])
    # a tag record with an empty cell, first in every file
    tags = F.struct(*[F.lit(None if c == "destLocations" else "#" + c.lower()).cast("string").alias(c) for c in order])
    numbered = as_text.withColumn("__row", F.monotonically_increasing_id() % (1 << 33))
    tagged = numbered.select(F.explode(F.when(F.col("__row") == 0, F.array(tags, F.struct(*order))).otherwise(F.array(F.struct(*order)))).alias("r")).select("r.*")
    path = scratch_path(spark, "csv")
    write_csv(tagged, path)
    return path, rows


_FLOWS_CSV_SQL = """
SELECT * FROM flows_raw UNION ALL
SELECT -1, 'a row whose organization starts with a hash', 1.5, '#1 region', '#1 region', 'EN'"""


@register("csv_roundtrip", with_standins(_FLOWS_CSV_SQL))
def q_csv_roundtrip(spark, sf_dir):
    """Flows written as CSV with tag records and multi-line text, read back typed."""
    path, rows = _flows_as_csv(spark, sf_dir)
    return read_csv_dataset(spark, path, schema=rows.schema, empty_as_null=False)


@register("csv_split_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_split_roundtrip(spark, sf_dir):
    """The documents written as CSV, quotes and line breaks inside, read back with every file cut into ranges."""
    docs = standins.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "csv")
    write_csv(docs, path)
    return read_csv_dataset(spark, path, schema=docs.schema, empty_as_null=False, split_records=True)


@register(
    "ingest_numeric",
    with_standins(
        "\nUNION ALL\n".join(
            f"""SELECT 'flows' AS dataset, {lit(c)} AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
{_exact_avg(c, s)} AS avg, {_exact_stddev(c, s)} AS stddev FROM ({_FLOWS_CSV_SQL})"""
            for c, s in (("id", 0), ("amountUSD", EXACT))
        )
    ),
)
def q_ingest_numeric(spark, sf_dir):
    """Flows CSVs ingested without a schema: tags dropped, types inferred, raw table saved, numbers profiled."""
    path, _ = _flows_as_csv(spark, sf_dir)
    with _database(spark) as (database, location):
        reports = ingest(spark, "", database, {"flows": path}, location=location, exact_scale=EXACT)
        return reports.numeric.drop("exact_min", "exact_max")


@contextmanager
def _database(spark: SparkSession):
    """(database, folder for its tables), dropped at the end; the tables' files stay for the frames that read them."""
    name, location = f"fundlens_check_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    ensure_database(spark, name, location=f"{location}/catalog")
    try:
        yield name, location
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


_TYPED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders")
_TYPED_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
}


def _inferred_sql(table: str, c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    fits = lambda kind, more="true": f"bool_and(TRY_CAST({text} AS {kind}) IS NOT NULL AND {more})"
    day = f"regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$')"
    return (
        f"SELECT {lit(table)} AS dataset, {lit(c)} AS column_name, CASE WHEN {fits('INTEGER')} AND max(typeof({c})) <> 'DOUBLE' THEN 'int' "
        f"WHEN {fits('BIGINT')} AND max(typeof({c})) <> 'DOUBLE' THEN 'bigint' WHEN {fits('DOUBLE')} THEN 'double' "
        f"WHEN {fits('DATE', day)} THEN 'date' WHEN {fits('TIMESTAMP')} THEN 'timestamp' ELSE 'string' END AS data_type, "
        f"count(*) AS row_count FROM {table}"
    )


@register("inferred_types", "\nUNION ALL\n".join(_inferred_sql(t, c) for t, cols in _TYPED_COLUMNS.items() for c in cols.split()))
def q_inferred_types(spark, sf_dir):
    """Six tables written as CSV and read without schemas: the types of all found in one wave of jobs."""
    paths = {t: scratch_path(spark, f"csv-{t}") for t in _TYPED_TABLES}
    tables = {t: standins.read_table(spark, sf_dir, t).select(*_TYPED_COLUMNS[t].split()) for t in _TYPED_TABLES}
    run_concurrently(spark, {t: (lambda t=t: write_csv(tables[t], paths[t])) for t in _TYPED_TABLES})
    loaded = load_datasets(spark, paths, infer_schema=True)
    if loaded.failures:
        raise RuntimeError(f"not loaded: {loaded.failures}")
    counts = P.profile_shape(loaded.frames).select("dataset", "row_count")
    kinds = P.profile_schema(spark, loaded.frames).select("dataset", "column_name", "data_type")
    return kinds.join(counts, "dataset")


@register("load_report", "SELECT 'flows' AS dataset, count(*) + 1 AS row_count, false AS failed FROM documents UNION ALL SELECT 'missing', NULL, true")
def q_load_report(spark, sf_dir):
    """Several datasets loaded, one of them absent: row counts and which failed."""
    path, _ = _flows_as_csv(spark, sf_dir)
    loaded = load_datasets(spark, {"flows": path, "missing": path + "-missing"})
    shape = P.profile_shape(loaded.frames).select("dataset", "row_count", F.lit(False).alias("failed"))
    failed = loaded.failures_frame(spark).select("dataset", F.lit(None).cast("long").alias("row_count"), F.lit(True).alias("failed"))
    return shape.unionByName(failed)


def _save_raw(spark: SparkSession, sf_dir: str, database: str, location: str) -> list[str]:
    raw = standins.raw_datasets(spark, sf_dir)
    failed = {k: v for k, v in save_raw_tables(raw, database, location=location).items() if v}
    if failed:
        raise RuntimeError(f"raw tables not saved: {failed}")
    return sorted(raw)


@register(
    "raw_tables",
    with_standins(" UNION ALL ".join(f"SELECT {lit(d)} AS dataset, count(*) AS row_count FROM {d}_raw" for d in standins.RAW_BUILDERS)),
)
def q_raw_tables(spark, sf_dir):
    """All raw datasets saved as catalog tables, loaded by name again and counted."""
    with _database(spark) as (database, location):
        names = _save_raw(spark, sf_dir, database, location)
        loaded = load_tables(spark, {k: f"{database}.raw_{k}" for k in names})
        return P.profile_shape(loaded.frames).select("dataset", "row_count")


@register(
    "listed_tables",
    with_standins(" UNION ALL ".join(f"SELECT 'raw_{d}' AS table_name, count(*) AS row_count FROM {d}_raw" for d in standins.RAW_BUILDERS)),
)
def q_listed_tables(spark, sf_dir):
    """The tables a database lists, each with its rows."""
    with _database(spark) as (database, location):
        names = _save_raw(spark, sf_dir, database, location)
        listed = list_tables(spark, database).select(F.col("tableName").alias("table_name"))
        reports = [verify_table(spark, f"{database}.raw_{n}").select(F.lit(f"raw_{n}").alias("table_name"), "row_count") for n in names]
        return listed.join(P.union_all(reports), "table_name", "left")


@register("persisted_counts", with_standins("SELECT count(*) AS row_count, count(country_code) AS with_country FROM needs_std"))
def q_persisted_counts(spark, sf_dir):
    """A cached input written and counted within one block, then released."""
    with persisted(needs_standardized(spark, sf_dir)) as needs:
        path = scratch_path(spark, "persisted")
        needs.write.parquet(path)
        counted = materialize(needs.agg(F.count(F.lit(1)).alias("row_count"), F.count("country_code").alias("with_country")))
    return counted


@register(
    "coalesced_candidates",
    with_standins(
        """
SELECT coalesce(CASE WHEN c_custkey % 5 <> 0 THEN n_name END, CASE WHEN c_custkey % 3 <> 0 THEN lower(n_name) END) AS country_code,
       TRY_CAST(CASE WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) END AS INTEGER) AS amount
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 5 <> 0 OR c_custkey % 3 <> 0"""
    ),
)
def q_coalesced_candidates(spark, sf_dir):
    """Two candidate columns that both hold values and nulls, malformed numbers, and null keys to drop."""
    customer, nation = (standins.read_table(spark, sf_dir, t) for t in ("customer", "nation"))
    k = F.col("c_custkey")
    raw = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(k % 5 != 0, F.col("n_name")).alias("ISO3"),
        F.when(k % 3 != 0, F.lower("n_name")).alias("Country Code"),
        F.when(k % 7 == 0, F.lit("n/a")).otherwise(k.cast("string")).alias("Amount"),
    )
    fields = (FieldSpec("country_code", ("iso3", "country_code"), "string"), FieldSpec("amount", ("amount",), "int"))
    return standardize(raw, fields, ("country_code",))


@register("rows_without_country", with_standins("SELECT id, year FROM requirements_raw WHERE countryCode IS NULL"))
def q_rows_without_country(spark, sf_dir):
    """The appeals that have no country."""
    return null_rows(standins.requirements_raw(spark, sf_dir), "countryCode").select("id", "year")


@register("table_roundtrip", with_standins(f"SELECT {', '.join(O.FEATURES)} FROM features"))
def q_table_roundtrip(spark, sf_dir):
    """The feature table saved over an older table, its catalog entry moved to it once checked, and read back."""
    with _database(spark) as (database, location):
        name, path = f"{database}.features", f"{location}/features"
        save_table(requirements_standardized(spark, sf_dir), name, path=path)
        save_table(features_all(spark, sf_dir), name, path=path, check="content")
        return spark.table(name)


@register(
    "table_content",
    with_standins(
        "SELECT 'as written' AS state, count(*) AS row_count, count(*) AS written_rows, true AS matches FROM requirements_std "
        "UNION ALL SELECT 'a row doubled', count(*) + 1, count(*), false FROM requirements_std "
        "UNION ALL SELECT 'a value changed', count(*), count(*), false FROM requirements_std"
    ),
)
def q_table_content(spark, sf_dir):
    """The content check of a saved table: as written, with one row stored twice, with one value changed."""
    base = requirements_standardized(spark, sf_dir)
    one = base.orderBy("appeal_id").limit(1)
    first = F.col("appeal_id") == one.first().appeal_id  # one row
    tampered = {
        "a row doubled": lambda stored: stored.unionByName(stored.filter(first)),
        "a value changed": lambda stored: stored.withColumn("appeal_name", F.when(first, "another").otherwise(F.col("appeal_name"))),
    }
    reports = []
    with _database(spark) as (database, location):
        name, path = f"{database}.requirements", f"{location}/requirements"
        written = save_table(base, name, path=path)
        reports.append(verify_content(spark, name).withColumn("state", F.lit("as written")))
        for state, change in tampered.items():
            changed, folder = change(spark.table(name)), f"{location}/{state.replace(' ', '-')}"
            changed.write.parquet(folder)
            write_marker(spark, folder, written)  # a version whose files are not those that were written
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            reports.append(verify_content(spark, name).withColumn("state", F.lit(state)))
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{current_version(spark, path)}'")
            spark.catalog.refreshTable(name)
    return P.union_all(reports).select("state", "row_count", "written_rows", "matches")


# Declared types of the feature table's columns, for the read-back report.
_FEATURE_TYPES = {
    **{c: "string" for c in ("country_code", "cluster_code", "cluster_name", "appeal_name", "appeal_code")},
    "year": "int",
    "appeal_id": "bigint",
    "startDate": "timestamp_ntz",
    "endDate": "timestamp_ntz",
    "sector_project_count": "bigint",
}
_FEATURE_SCHEMA = "struct<" + ",".join(
    f"{c}:{_FEATURE_TYPES.get(c, 'double')}" for c in O.FEATURES
) + ">"


@register(
    "table_verify",
    with_standins(
        "SELECT 'features_verify' AS table_name, count(*) AS row_count, "
        f"CAST(36 AS BIGINT) AS column_count, {lit(_FEATURE_SCHEMA)} AS schema FROM features"
    ),
)
def q_table_verify(spark, sf_dir):
    """Read-back report of a saved table: name, rows, columns."""
    with _database(spark) as (database, location):
        save_table(features_all(spark, sf_dir), f"{database}.features_verify", path=f"{location}/fv")
        report = verify_table(spark, f"{database}.features_verify")
        return report.withColumn("table_name", F.substring_index("table_name", ".", -1))
