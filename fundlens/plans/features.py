"""The feature pipeline as one lazy plan: standardize → pre-aggregate → join → fill → features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fundlens.operators.aggregate import needs_by_country_cluster, population_by_country_year
from fundlens.operators.features import (
    FEATURE_COLUMNS,
    add_population_features,
    add_project_features,
    add_sector_features,
    fill_measures,
    sector_totals,
)
from fundlens.operators.join import (
    BROADCAST_MAX_ROWS,
    SizedSide,
    broadcast_if_small,
    materialize,
    run_concurrently,
    join_needs,
    join_population,
)
from fundlens.operators.quality import StageCounts
from fundlens.operators.standardize import (
    standardize_needs,
    standardize_population,
    standardize_requirements,
)


@dataclass
class FeatureStages:
    """Every intermediate of the pipeline, all lazy DataFrames."""

    base: DataFrame
    needs_agg: DataFrame | None
    population_agg: DataFrame | None
    after_needs: DataFrame
    after_population: DataFrame
    filled: DataFrame
    features: DataFrame


def feature_stages(
    requirements: DataFrame,
    needs: DataFrame | None = None,
    population: DataFrame | None = None,
    *,
    sector_strategy: str = "aggregate",
    exact_scale: int | None = None,
    broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
    checkpoint_base: bool = False,
    audit: StageCounts | None = None,
) -> FeatureStages:
    """Build the pipeline from *standardized* inputs; needs and population are optional.

    A missing input contributes null measures, which the fill step turns
    into zeros, so the schema never depends on which inputs were present.

    With ``broadcast_max_rows`` set (the default) the three small per-group
    tables (needs, population and sector totals) are computed concurrently
    and checkpointed first, then broadcast if under the bound, so the base
    is never shuffled for a join with a small side; above the bound hot keys
    are dealt over several tasks (``skew_join``).  The sector totals only
    use base columns (requirements, filled funding, appeal id), so they are
    taken from the base before the joins, which keep its rows.  ``None``
    keeps the whole pipeline lazy and leaves join choice to Spark/AQE.

    ``checkpoint_base=True`` writes the requirements input once, as a parquet
    table in the shared checkpoint folder.  Use it when that input is itself derived by
    joins or aggregations: the sector totals and the final pass then read it
    instead of recomputing it.  For a stored table it only adds a write.

    ``audit`` watches the base, both joins and the features on the path to the
    result: running the features once fills in their row counts.
    """
    watch = audit.watch if audit else (lambda stage, df: df)
    needs_agg = None if needs is None else needs_by_country_cluster(needs, exact_scale)
    pop_agg = None if population is None else population_by_country_year(population, exact_scale)
    totals = needs_side = pop_side = None
    if broadcast_max_rows is None:
        if checkpoint_base:
            requirements = materialize(requirements, as_table=True)
    else:
        # Phase 1: independent materializations run concurrently; the sector
        # totals join them unless they must wait for the checkpointed base.
        tasks = {}
        if needs_agg is not None:
            tasks["needs"] = lambda: SizedSide.of(needs_agg, broadcast_max_rows)
        if pop_agg is not None:
            tasks["population"] = lambda: SizedSide.of(pop_agg, broadcast_max_rows)

        def _totals(base: DataFrame) -> DataFrame:
            table = sector_totals(add_project_features(fill_measures(base)), exact_scale)
            return broadcast_if_small(table, broadcast_max_rows)

        with_totals = sector_strategy == "aggregate"
        if checkpoint_base:
            tasks["base"] = lambda: materialize(requirements, as_table=True)
        elif with_totals:
            tasks["sector"] = lambda: _totals(requirements)
        done = run_concurrently(requirements.sparkSession, tasks)
        needs_side = done.get("needs")
        pop_side = done.get("population")
        requirements = done.get("base", requirements)
        totals = done.get("sector")
        if with_totals and totals is None:
            totals = _totals(requirements)  # phase 2: from the checkpointed base
    requirements = watch("base", requirements)
    after_needs = watch("after_needs", join_needs(requirements, needs_side or needs_agg))
    after_pop = watch("after_population", join_population(after_needs, pop_side or pop_agg))
    filled = fill_measures(after_pop)
    feats = add_project_features(filled)
    feats = add_population_features(feats)
    feats = add_sector_features(
        feats,
        strategy=sector_strategy,
        exact_scale=exact_scale,
        broadcast_max_rows=broadcast_max_rows,
        totals=totals,
    )
    return FeatureStages(
        base=requirements,
        needs_agg=needs_side.frame if needs_side else needs_agg,
        population_agg=pop_side.frame if pop_side else pop_agg,
        after_needs=after_needs,
        after_population=after_pop,
        filled=filled,
        features=watch("features", feats.select(*FEATURE_COLUMNS)),
    )


def build_features(
    requirements: DataFrame,
    needs: DataFrame | None = None,
    population: DataFrame | None = None,
    *,
    sector_strategy: str = "aggregate",
    exact_scale: int | None = None,
    broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
    checkpoint_base: bool = False,
) -> DataFrame:
    """The 36-column feature table (one row per appeal row) from standardized inputs."""
    return feature_stages(
        requirements,
        needs,
        population,
        sector_strategy=sector_strategy,
        exact_scale=exact_scale,
        broadcast_max_rows=broadcast_max_rows,
        checkpoint_base=checkpoint_base,
    ).features


def build_features_from_raw(
    raw: dict[str, DataFrame],
    *,
    sector_strategy: str = "aggregate",
    exact_scale: int | None = None,
    broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
    checkpoint_base: bool = False,
) -> DataFrame:
    """Standardize the raw inputs present in ``raw`` and build the feature table.

    ``raw`` must hold ``requirements``; ``needs`` and ``population`` are optional.
    """
    req = standardize_requirements(raw["requirements"])
    needs = standardize_needs(raw["needs"]) if "needs" in raw else None
    pop = standardize_population(raw["population"]) if "population" in raw else None
    return build_features(
        req,
        needs,
        pop,
        sector_strategy=sector_strategy,
        exact_scale=exact_scale,
        broadcast_max_rows=broadcast_max_rows,
        checkpoint_base=checkpoint_base,
    )
