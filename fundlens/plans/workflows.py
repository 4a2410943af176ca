"""The two end-to-end workflows: ingest + profile, and the feature pipeline.

Both return DataFrames (reports and tables) instead of printing, and run
only the actions they must: the table writes and the checked broadcasts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fundlens.operators import profile as P
from fundlens.operators.quality import StageCounts, quality_report, stage_audit
from fundlens.operators.standardize import (
    standardize_needs,
    standardize_plans,
    standardize_population,
    standardize_requirements,
)
from fundlens.plans.features import feature_stages
from fundlens.sinks.tables import ensure_database, list_tables, save_raw_tables, save_table
from fundlens.sinks.versions import current_version
from fundlens.sources.catalog import load_tables
from fundlens.sources.csv import load_datasets

# The seven input files by dataset name, and the country
# columns whose values are profiled per dataset.
DATASET_FILES = {
    "hno": "hpc_hno_2025.csv",
    "hrp": "humanitarian-response-plans.csv",
    "fts_requirements": "fts_requirements_funding_globalcluster_global.csv",
    "fts_incoming": "fts_incoming_funding_global.csv",
    "fts_internal": "fts_internal_funding_global.csv",
    "fts_outgoing": "fts_outgoing_funding_global.csv",
    "population": "cod_population_admin1.csv",
}
COUNTRY_KEY_COLUMNS = {
    "hno": ["countryCode", "country_code", "country"],
    "hrp": ["countryCode", "country_code", "country"],
    "fts_requirements": ["countryCode"],
    "fts_incoming": ["srcLocations", "destLocations"],
    "population": ["adm0_en"],
}


@dataclass
class ProfileReports:
    """The exploratory reports of a set of datasets, all lazy DataFrames."""

    shape: DataFrame | None
    schema: DataFrame
    nulls: DataFrame | None
    distinct: DataFrame | None
    top_cardinality: DataFrame | None
    numeric: DataFrame | None
    join_key_candidates: DataFrame
    key_profile: DataFrame | None
    key_samples: DataFrame | None
    previews: dict[str, DataFrame] = field(default_factory=dict)
    tables: DataFrame | None = None
    failures: dict[str, str] = field(default_factory=dict)


def _union(frames):
    frames = [f for f in frames if f is not None]
    return P.union_all(frames) if frames else None


def profile_datasets(
    spark: SparkSession,
    dfs: Mapping[str, DataFrame],
    key_columns: Mapping[str, list[str]] = COUNTRY_KEY_COLUMNS,
    approx_distinct: bool = False,
    exact_scale: int | None = None,
) -> ProfileReports:
    """Every exploratory report for ``dfs`` (nothing is executed here); without datasets the reports are absent.

    ``exact_scale`` makes averages and deviations independent of the order of rows (``numeric_stats``).
    """
    numeric = [P.numeric_stats(df, name, exact_scale=exact_scale) for name, df in dfs.items() if P.numeric_columns(df)]
    distinct = _union(P.distinct_counts(df, name, approx=approx_distinct) for name, df in dfs.items())
    return ProfileReports(
        shape=P.profile_shape(dfs) if dfs else None,
        schema=P.profile_schema(spark, dfs),
        nulls=_union(P.null_counts(df, name) for name, df in dfs.items()),
        distinct=distinct,
        top_cardinality=P.top_cardinality(distinct) if distinct is not None else None,
        numeric=_union(numeric),
        join_key_candidates=P.join_key_candidates(spark, dfs),
        key_profile=P.key_profiles(dfs, key_columns),
        key_samples=P.key_samples_all(dfs, key_columns),
        previews={name: P.sample_rows(df) for name, df in dfs.items()},
    )


def ingest(
    spark: SparkSession,
    base_dir: str,
    database: str,
    registry: Mapping[str, str] = DATASET_FILES,
    location: str | None = None,
    schemas: Mapping[str, StructType] | None = None,
    multi_line: bool = True,
    split_records: bool = False,
    exact_scale: int | None = None,
) -> ProfileReports:
    """Read the CSV inputs present, save each as ``<database>.raw_<name>`` and profile them.

    Each CSV is parsed once, by the write; the profiles then read the saved
    parquet tables (columnar, splittable).  Missing or unreadable files are
    reported in ``failures`` (failed writes under ``write:<name>``); the
    others proceed.  ``schemas`` (name → StructType) types the text columns;
    types of a dataset without a schema are inferred once its tag record is
    dropped.  ``multi_line=False`` makes files without line breaks inside
    quotes splittable, ``split_records=True`` those that have some.
    """
    loaded = load_datasets(
        spark, registry, base_dir=base_dir, schemas=schemas, infer_schema=True, multi_line=multi_line, split_records=split_records
    )
    ensure_database(spark, database, location=location)
    status = save_raw_tables(loaded.frames, database, location=location)
    saved = {name: spark.table(f"{database}.raw_{name}") for name, err in status.items() if not err}
    reports = profile_datasets(spark, saved, exact_scale=exact_scale)
    reports.failures = dict(loaded.failures)
    reports.failures.update({f"write:{k}": v for k, v in status.items() if v})
    reports.tables = list_tables(spark, database)
    return reports


@dataclass
class PipelineResult:
    features: DataFrame
    audit: DataFrame
    quality: DataFrame
    feature_stats: DataFrame
    plans: DataFrame | None
    failures: dict[str, str]
    preview: DataFrame | None = None
    sources: dict[str, str] = field(default_factory=dict)


def feature_pipeline(
    spark: SparkSession,
    database: str,
    output_table: str | None = "features",
    location: str | None = None,
    **feature_options,
) -> PipelineResult:
    """Read ``<database>.raw_*``, standardize, build and (optionally) save the feature table.

    The requirements table is required; needs and population are optional.
    A raw table not found in the catalog is read from ``<location>/raw_<name>``
    when ``location`` is given (the folder ``ingest`` wrote it to), so the
    workflow also works across sessions without a persistent metastore.
    ``feature_options`` go to :func:`fundlens.plans.features.feature_stages`.
    """
    raw_names = {
        "requirements": "raw_fts_requirements",
        "needs": "raw_hno",
        "population": "raw_population",
        "plans": "raw_hrp",
    }
    loaded = load_tables(spark, {k: f"{database}.{v}" for k, v in raw_names.items()})
    sources = {key: f"{database}.{raw_names[key]}" for key in loaded.frames}
    if location:
        # only a table that is not in the catalog is looked for in the folder; any other error stays an error
        for key in [k for k, why in loaded.failures.items() if "TABLE_OR_VIEW_NOT_FOUND" in why or "SCHEMA_NOT_FOUND" in why]:
            try:
                folder = f"{location.rstrip('/')}/{raw_names[key]}"
                folder = current_version(spark, folder) or folder
                loaded.frames[key] = spark.read.parquet(folder)
                sources[key] = folder
                del loaded.failures[key]
            except Exception as exc:  # noqa: BLE001 - still reported as missing
                loaded.failures[key] += f"; {type(exc).__name__}: {exc}".splitlines()[0]
    if "requirements" not in loaded.frames:
        raise ValueError(f"requirements table missing: {loaded.failures.get('requirements')}")
    raw = loaded.frames
    counts = StageCounts() if output_table else None  # filled in by the save
    st = feature_stages(
        standardize_requirements(raw["requirements"]),
        standardize_needs(raw["needs"]) if "needs" in raw else None,
        standardize_population(raw["population"]) if "population" in raw else None,
        audit=counts,
        **feature_options,
    )
    plans = standardize_plans(raw["plans"]) if "plans" in raw else None
    if output_table:
        ensure_database(spark, database, location=location)
        path = f"{location.rstrip('/')}/{output_table}" if location else None
        save_table(st.features, f"{database}.{output_table}", path=path)
        features = spark.table(f"{database}.{output_table}")
        audit = counts.report(spark).filter("stage <> 'features'")
    else:
        features = st.features
        audit = stage_audit(
            {"base": st.base, "after_needs": st.after_needs, "after_population": st.after_population}
        )
    return PipelineResult(
        features=features,
        audit=audit,
        quality=quality_report(features),
        feature_stats=P.feature_stats(features),
        plans=plans,
        failures=dict(loaded.failures),
        preview=P.sample_rows(features),
        sources=sources,
    )
