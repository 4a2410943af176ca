"""Pre-aggregations that make each right side of a join unique on its keys.

All are ``groupBy().agg()`` with algebraic aggregates, so Spark runs a
partial (map-side) aggregate before the shuffle: a hot key that holds a third
of the rows still leaves each map task as a single partial row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol, sum_measure
from fundlens.functions.multivalue import explode_multi

NEEDS_MEASURES = ("targeted", "inneed", "affected", "reached")


def population_by_country_year(
    population: DataFrame, exact_scale: int | None = None, with_name: bool = False
) -> DataFrame:
    """Total population per (country_code, year), all admin rows added.

    ``with_name`` also returns the smallest country name of the group as
    ``country_name`` (a deterministic pick; not used by the feature table).
    """
    aggs = [sum_measure(F.col("population"), exact_scale).alias("population")]
    if with_name:
        aggs.append(F.min("country").alias("country_name"))
    return population.groupBy("country_code", "year").agg(*aggs)


def needs_by_country_cluster(needs: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Sums of targeted, inneed, affected and reached per (country_code, cluster_code).

    Every row of the group is added, admin-level totals included, as the
    inputs are given; a null cluster forms its own group.
    """
    return needs.groupBy("country_code", "cluster_code").agg(
        *[sum_measure(F.col(m), exact_scale).alias(m) for m in NEEDS_MEASURES]
    )


def flows_by_destination(
    flows: DataFrame,
    destination_col: str,
    amount_col: str,
    sep: str = ",",
    lower: bool = False,
    exact_scale: int | None = None,
) -> DataFrame:
    """Flow amount and count per destination of a multi-valued destination field.

    A flow listing several destinations counts its full amount for each of
    them, so the totals across destinations exceed the total of the flows;
    the inputs give no rule to split an amount.  A flow without destination
    is kept under a null destination.
    """
    exploded = explode_multi(
        flows.select(qcol(destination_col).alias("destination"), qcol(amount_col).alias("amount")),
        "destination",
        sep=sep,
        lower=lower,
    )
    return exploded.groupBy("destination").agg(
        sum_measure(F.col("amount"), exact_scale).alias("amount_usd"),
        F.count(F.lit(1)).alias("flow_count"),
    )
