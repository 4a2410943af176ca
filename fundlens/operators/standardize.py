"""Standardizers: map each input's columns to the common keys and types.

Each standardizer is one ``select`` (rename + ``try_cast``) followed by a
null-key filter, so Catalyst prunes unused input columns at the scan and can
push plain-column ``IS NOT NULL`` filters into parquet.  ``try_cast`` turns
malformed text (such as a leftover tag row ``#date``) into null instead of
raising under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fundlens.functions.columns import coalesce_existing, qcol, typed_null


@dataclass(frozen=True)
class FieldSpec:
    """One output column: its name, source-name candidates and type.

    ``dtype=None`` keeps the input type.  A missing ``required`` field raises;
    a missing optional field becomes a typed null column.
    """

    target: str
    candidates: tuple[str, ...]
    dtype: str | None = None
    required: bool = True


def standardize(
    df: DataFrame, fields: Sequence[FieldSpec], key_columns: Sequence[str] = ()
) -> DataFrame:
    """Project ``df`` onto ``fields`` and drop rows with a null key."""
    cols = []
    for f in fields:
        c = coalesce_existing(df, f.candidates, f.dtype)
        if c is None:
            if f.required:
                raise ValueError(
                    f"no column for {f.target!r}; looked for {list(f.candidates)} in {df.columns}"
                )
            c = typed_null(f.dtype or "string")
        cols.append(c.alias(f.target))
    out = df.select(*cols)
    return drop_null_keys(out, key_columns) if key_columns else out


def drop_null_keys(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all non-null (a conjunction of IS NOT NULL)."""
    cond = None
    for k in key_columns:
        term = qcol(k).isNotNull()
        cond = term if cond is None else cond & term
    return df.filter(cond) if cond is not None else df


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is null."""
    return df.filter(qcol(column).isNull())


# Source column names of the four inputs, as the input files
# name them, with the name variants seen in the inputs' documentation.
REQUIREMENTS_FIELDS = (
    FieldSpec("country_code", ("countryCode",), "string"),
    FieldSpec("cluster_code", ("clusterCode",), "string"),
    FieldSpec("cluster_name", ("cluster",), "string"),
    FieldSpec("year", ("year",), "int"),
    FieldSpec("appeal_id", ("id",)),
    FieldSpec("appeal_name", ("name",), "string"),
    FieldSpec("appeal_code", ("code",), "string"),
    FieldSpec("startDate", ("startDate",)),
    FieldSpec("endDate", ("endDate",)),
    FieldSpec("total_requirements_usd", ("requirements",), "double"),
    FieldSpec("total_funding_usd", ("funding",), "double"),
    FieldSpec("funding_percent", ("percentFunded",), "double"),
)
REQUIREMENTS_KEYS = ("country_code", "year")

NEEDS_FIELDS = (
    FieldSpec("country_code", ("country_iso3", "Country ISO3"), "string"),
    FieldSpec("cluster_code", ("sector_cluster_code", "Cluster"), "string"),
    FieldSpec("population", ("population", "Population"), "double", required=False),
    FieldSpec("inneed", ("inneed", "In Need"), "double"),
    FieldSpec("targeted", ("targeted", "Targeted"), "double"),
    FieldSpec("affected", ("affected", "Affected"), "double"),
    FieldSpec("reached", ("reached", "Reached"), "double"),
)
NEEDS_KEYS = ("country_code",)

POPULATION_FIELDS = (
    FieldSpec("country_code", ("ISO3",), "string"),
    FieldSpec("country", ("Country",), "string", required=False),
    FieldSpec("year", ("Reference_year",), "int"),
    FieldSpec("population", ("Population",), "double"),
)
POPULATION_KEYS = ("country_code", "year")

PLANS_FIELDS = (
    FieldSpec("country_code", ("locations",), "string"),
    FieldSpec("year", ("years",)),
    FieldSpec("plan_id", ("code",)),
    FieldSpec("total_requirements_usd", ("origRequirements",), "double"),
    FieldSpec("revised_requirements_usd", ("revisedRequirements",), "double"),
    FieldSpec("startDate", ("startDate",)),
    FieldSpec("endDate", ("endDate",)),
    FieldSpec("plan_type", ("categories",)),
    FieldSpec("internal_id", ("internalId",)),
)
PLANS_KEYS = ("country_code", "year")


def standardize_requirements(df: DataFrame) -> DataFrame:
    """Appeal requirements and funding per (country, cluster, year) → 12 columns."""
    return standardize(df, REQUIREMENTS_FIELDS, REQUIREMENTS_KEYS)


def standardize_needs(df: DataFrame) -> DataFrame:
    """Needs overview rows → country/cluster keys and five people measures.

    Key and measure columns are found by folded name among the candidates
    and coalesced when several exist.  Needs carry no year.
    """
    return standardize(df, NEEDS_FIELDS, NEEDS_KEYS)


def standardize_population(df: DataFrame) -> DataFrame:
    """Population rows → country_code, country, year (int), population (double)."""
    return standardize(df, POPULATION_FIELDS, POPULATION_KEYS)


def standardize_plans(df: DataFrame) -> DataFrame:
    """Response plans → plan keys and requirements; ``year`` keeps its input type."""
    return standardize(df, PLANS_FIELDS, PLANS_KEYS)


def with_columns_if_missing(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    """Add each absent column as a typed null (metadata check, no job)."""
    missing = {c: typed_null(dtype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


__all__ = [
    "FieldSpec",
    "NEEDS_FIELDS",
    "PLANS_FIELDS",
    "POPULATION_FIELDS",
    "REQUIREMENTS_FIELDS",
    "drop_null_keys",
    "null_rows",
    "standardize",
    "standardize_needs",
    "standardize_plans",
    "standardize_population",
    "standardize_requirements",
    "with_columns_if_missing",
]
