"""Measure filling and the 19 derived features.

Project and population features are narrow projections (one ``withColumns``
each, collapsed by Catalyst into the scan's codegen stage).  Sector features
need per-group totals over (country_code, year, cluster_code); three strategies
give the same values:

* ``"aggregate"`` (default): ``groupBy`` with partial aggregation, then a
  null-safe join back.  The shuffle carries one partial row per group and map
  task, so a sector that holds a third of all rows costs no more than any
  other.  The totals are broadcast after a checked row count
  (``broadcast_if_small``); above the bound the join is a shuffle join whose
  skewed partitions AQE splits.
* ``"window"``: ``sum().over(partitionBy(keys))``.  One pass, but every row
  of a group is shuffled into one task and sorted there, so a hot group
  becomes a straggler; kept for small inputs and as a cross-check.
* ``"salted_window"``: windows in two levels.  The base is shuffled once, by
  (keys, salt); a window there gives every salted part of a group its partial
  totals, a second one over the parts' representatives (at most ``salts`` rows a
  group) the group's, and these meet the rows again by (keys, salt), where both
  already lie.  The base is read and shuffled once, and no task gets more of a
  group than one salt's share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.columns import EPS, guarded_ratio, measure_parts, measure_total, safe_ratio, sum_measure
from fundlens.operators.join import broadcast_if_small
from fundlens.operators.standardize import with_columns_if_missing

# Measures that are filled with 0.0 after the joins.  The
# requirements are deliberately not filled.
FILL_ZERO_COLUMNS = (
    "total_funding_usd",
    "funding_percent",
    "population",
    "targeted",
    "inneed",
    "affected",
    "reached",
)

SECTOR_KEYS = ("country_code", "year", "cluster_code")

PROJECT_FEATURES = (
    "beneficiary_to_funding_ratio",
    "need_to_requirements_ratio",
    "targeting_coverage_rate",
    "funding_gap_usd",
    "funding_gap_pct",
    "funding_coverage_rate",
    "cost_per_beneficiary",
)
POPULATION_FEATURES = (
    "cost_per_capita",
    "requirement_per_capita",
    "funding_coverage_pct",
    "requirement_coverage_pct",
)
SECTOR_TOTALS = (
    "sector_total_requirements_usd",
    "sector_total_funding_usd",
    "sector_total_gap_usd",
    "sector_project_count",
)
SECTOR_RATIOS = (
    "project_funding_share_of_sector_pct",
    "project_requirement_share_of_sector_pct",
    "sector_funding_efficiency_pct",
    "project_funding_status_vs_sector_avg",
)

BASE_COLUMNS = (
    "country_code",
    "year",
    "cluster_code",
    "cluster_name",
    "appeal_id",
    "appeal_name",
    "appeal_code",
    "startDate",
    "endDate",
    "total_requirements_usd",
    "total_funding_usd",
    "funding_percent",
    "targeted",
    "inneed",
    "affected",
    "reached",
    "population",
)
FEATURE_COLUMNS = (
    BASE_COLUMNS + PROJECT_FEATURES + POPULATION_FEATURES + SECTOR_TOTALS + SECTOR_RATIOS
)


def fill_measures(df: DataFrame, columns: Sequence[str] = FILL_ZERO_COLUMNS) -> DataFrame:
    """Fill the measures with 0.0; an absent measure is first added as null."""
    df = with_columns_if_missing(df, columns)
    return df.fillna(0.0, subset=list(columns))


def add_project_features(df: DataFrame, eps: float = EPS) -> DataFrame:
    """F1–F7: efficiency, coverage, gap and cost per beneficiary."""
    req, fund = F.col("total_requirements_usd"), F.col("total_funding_usd")
    targeted, inneed = F.col("targeted"), F.col("inneed")
    return df.withColumns(
        {
            "beneficiary_to_funding_ratio": safe_ratio(targeted, fund, eps),
            "need_to_requirements_ratio": safe_ratio(inneed, req, eps),
            "targeting_coverage_rate": safe_ratio(targeted, inneed, eps),
            "funding_gap_usd": req - fund,
            "funding_gap_pct": guarded_ratio(req - fund, req) * 100,
            "funding_coverage_rate": safe_ratio(fund, req, eps),
            "cost_per_beneficiary": guarded_ratio(fund, targeted),
        }
    )


def add_population_features(df: DataFrame, eps: float = EPS) -> DataFrame:
    """F8–F11: funding and requirements per person of the country-year.

    The ``*_coverage_pct`` names are kept as given although the values are
    per-capita amounts times 100.
    """
    req, fund, pop = F.col("total_requirements_usd"), F.col("total_funding_usd"), F.col("population")
    return df.withColumns(
        {
            "cost_per_capita": safe_ratio(fund, pop, eps),
            "requirement_per_capita": safe_ratio(req, pop, eps),
            "funding_coverage_pct": safe_ratio(fund, pop, eps) * 100,
            "requirement_coverage_pct": safe_ratio(req, pop, eps) * 100,
        }
    )


def _sector_total_columns(exact_scale: int | None, over=None) -> dict:
    return {
        "sector_total_requirements_usd": sum_measure(F.col("total_requirements_usd"), exact_scale, over),
        "sector_total_funding_usd": sum_measure(F.col("total_funding_usd"), exact_scale, over),
        "sector_total_gap_usd": sum_measure(F.col("funding_gap_usd"), exact_scale, over),
        "sector_project_count": (
            F.count("appeal_id") if over is None else F.count("appeal_id").over(over)
        ),
    }


def sector_totals(
    df: DataFrame, exact_scale: int | None = None, keys: Sequence[str] = SECTOR_KEYS
) -> DataFrame:
    """W1–W4 as a table: one row per sector group (nulls group together)."""
    totals = _sector_total_columns(exact_scale)
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])


def _salted_window_totals(df: DataFrame, exact_scale: int | None, keys: Sequence[str], salts: int) -> DataFrame:
    """``df`` with W1-W4 by windows in two levels.

    The salt is a hash of the whole row, so a rerun deals alike and only rows
    that are equal in every column share a salt.  Level two reads the exchange
    of level one again, so the base is read once: Spark reuses an exchange that
    both sides need with the same columns.  Both refer to the hash of the whole
    row for that; a caller who needs few columns selects them before.
    """
    measures = dict(zip(SECTOR_TOTALS[:3], ("total_requirements_usd", "total_funding_usd", "funding_gap_usd")))
    whole = F.xxhash64(*[F.col(c) for c in df.columns])
    # one key that is never null: windows and join then ask for the same partitioning
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    salted = df.withColumns({"__key": key, "__salt": F.pmod(whole, F.lit(salts))}).repartition("__key", "__salt")
    part = Window.partitionBy("__key", "__salt")
    parts: dict[str, list[tuple]] = {
        name: [(f"__{m}_{i}", agg, value) for i, (agg, value) in enumerate(measure_parts(F.col(m), exact_scale))]
        for name, m in measures.items()
    }
    parts["sector_project_count"] = [("__projects", F.sum, F.when(F.col("appeal_id").isNotNull(), 1).otherwise(0).cast("bigint"))]
    flat = [p for group in parts.values() for p in group]
    level1 = salted.withColumns({n: agg(value).over(part) for n, agg, value in flat})
    # the order decides nothing but which of a part's equal totals is kept
    level1 = level1.withColumn("__first", F.row_number().over(part.orderBy(whole)))
    group = Window.partitionBy("__key")
    level2 = level1.filter(F.col("__first") == 1).withColumns({n: agg(F.col(n)).over(group) for n, agg, _ in flat})
    totals = level2.select(
        "__key",
        "__salt",
        *[measure_total([F.col(n) for n, _, _ in parts[t]], exact_scale).alias(t) for t in SECTOR_TOTALS[:3]],
        F.col("__projects").alias("sector_project_count"),
    )
    # the count is never null: the hash only keeps every column on this side of the exchange too
    count = F.coalesce("sector_project_count", whole).alias("sector_project_count")
    return salted.join(totals, ["__key", "__salt"], "left").select(*df.columns, *SECTOR_TOTALS[:3], count)


def add_sector_features(
    df: DataFrame,
    strategy: str = "aggregate",
    exact_scale: int | None = None,
    eps: float = EPS,
    keys: Sequence[str] = SECTOR_KEYS,
    broadcast_max_rows: int | None = None,
    totals: DataFrame | None = None,
    salts: int = 32,
) -> DataFrame:
    """W1–W4 (sector totals) and F12–F15 (shares and sector efficiency).

    With ``strategy="aggregate"`` and ``broadcast_max_rows`` set, the totals
    are materialized first and broadcast when they have at most that many
    rows (see ``broadcast_if_small``); otherwise the join is left to Spark.
    ``totals`` passes a precomputed :func:`sector_totals` table (possibly
    already materialized) for the aggregate strategy, ``salts`` is the number
    of parts a group is dealt into by ``"salted_window"``.
    """
    if strategy == "window":
        w = Window.partitionBy(*keys)
        with_totals = df.withColumns(_sector_total_columns(exact_scale, over=w))
    elif strategy == "salted_window":
        with_totals = _salted_window_totals(df, exact_scale, keys, salts)
    elif strategy == "aggregate":
        renamed = [f"__sector_key{i}" for i in range(len(keys))]
        if totals is None:
            totals = broadcast_if_small(sector_totals(df, exact_scale, keys), broadcast_max_rows)
        totals = totals.select(
            *[F.col(k).alias(r) for k, r in zip(keys, renamed)], *SECTOR_TOTALS
        )
        cond = None
        for k, r in zip(keys, renamed):
            term = df[k].eqNullSafe(F.col(r))
            cond = term if cond is None else cond & term
        with_totals = df.join(totals, on=cond, how="left").select(*df.columns, *SECTOR_TOTALS)
    else:
        raise ValueError(f"unknown sector strategy {strategy!r}; use 'aggregate', 'window' or 'salted_window'")

    req, fund = F.col("total_requirements_usd"), F.col("total_funding_usd")
    s_req, s_fund = F.col("sector_total_requirements_usd"), F.col("sector_total_funding_usd")
    efficiency = safe_ratio(s_fund, s_req, eps) * 100
    return with_totals.withColumns(
        {
            "project_funding_share_of_sector_pct": safe_ratio(fund, s_fund, eps) * 100,
            "project_requirement_share_of_sector_pct": safe_ratio(req, s_req, eps) * 100,
            "sector_funding_efficiency_pct": efficiency,
            "project_funding_status_vs_sector_avg": F.col("funding_percent") - efficiency,
        }
    )
