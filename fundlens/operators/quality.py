"""Quality gates over the joined and feature tables (reports, not actions)."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.operators.profile import union_all, null_counts, null_ranking

# Columns checked by the quality report, and the join keys
# among them that are expected to have no nulls.
QUALITY_KEY_COLUMNS = (
    "country_code",
    "year",
    "cluster_code",
    "total_requirements_usd",
    "total_funding_usd",
    "funding_gap_pct",
    "cost_per_beneficiary",
    "targeted",
    "inneed",
    "population",
    "sector_total_funding_usd",
    "sector_project_count",
)
NON_NULL_KEYS = ("country_code", "cluster_code", "year")


def nulls_after_fill(filled: DataFrame, dataset: str = "filled") -> DataFrame:
    """Columns that still hold nulls after the fill, most first (one pass)."""
    return null_ranking(null_counts(filled, dataset))


def quality_report(
    features: DataFrame,
    columns: Sequence[str] = QUALITY_KEY_COLUMNS,
    non_null_keys: Sequence[str] = NON_NULL_KEYS,
    dataset: str = "features",
) -> DataFrame:
    """Null count and % for the checked columns, with a key expectation flag.

    ``expect_non_null`` marks join keys; ``expectation_failed`` is true for a
    join key that has nulls or, as ``absent`` says, is not there at all: each
    checked column has a row.  One aggregate pass computes all counts.
    """
    spark_columns = set(features.columns)
    checked = features.select(*[qcol(c) if c in spark_columns else F.lit(None).cast("string").alias(c) for c in columns])
    report = null_counts(checked, dataset)
    missing = [c for c in columns if c not in spark_columns]
    absent = F.col("column_name").isin(missing) if missing else F.lit(False)
    keys = F.array(*[F.lit(k) for k in non_null_keys])
    expect = F.array_contains(keys, F.col("column_name"))
    return report.select(
        "dataset",
        "column_name",
        "null_count",
        "row_count",
        "null_pct",
        expect.alias("expect_non_null"),
        absent.alias("absent"),
        (absent | (expect & (F.col("null_count") > 0))).alias("expectation_failed"),
    )


def stage_audit(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count after each named stage, in one job (a union of counts)."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(i + 1).alias("step"), F.lit(name).alias("stage"), "row_count"
        )
        for i, (name, df) in enumerate(stages.items())
    ]
    return union_all(frames)


ARRIVAL_SECONDS = 5.0  # for which a report waits for the observations of finished actions


class StageCounts:
    """Row counts of named stages as a by-product of running the pipeline once.

    :meth:`watch` puts an observation into the plan at a stage; whatever action
    runs that plan first fills it in, so counting costs no job and no second
    run.  :meth:`report` then gives the table that :func:`stage_audit` computes
    by running every stage.  Stages keep the order in which they were watched.

    A stage inside a shuffled part of a plan may be counted too high if an
    executor is lost there and its tasks run again; stages of the last,
    unshuffled part (where the feature joins are) are exact.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, stage: str, df: DataFrame) -> DataFrame:
        if stage in self._seen:
            raise ValueError(f"stage {stage!r} is watched already")
        self._seen[stage] = Observation()
        return df.observe(self._seen[stage], F.count(F.lit(1)).alias("row_count"))

    def pending(self) -> list[str]:
        """Watched stages whose plan no action has finished yet."""
        return [s for s, o in self._seen.items() if not o._jo.future().isCompleted()]

    def report(self, spark: SparkSession) -> DataFrame:
        """(step, stage, row_count) of every watched stage; raises while one has not run.

        Observations arrive a moment after their action has returned, so a missing one is waited for.
        """
        until = time.monotonic() + ARRIVAL_SECONDS
        while self.pending() and time.monotonic() < until:
            time.sleep(0.05)
        if waiting := self.pending():
            raise RuntimeError(f"not run yet: {', '.join(waiting)}")
        rows = [(i + 1, stage, seen.get["row_count"] or 0) for i, (stage, seen) in enumerate(self._seen.items())]
        return spark.createDataFrame(rows, "step int, stage string, row_count long")


def join_preserves_rows(audit: DataFrame, before: str, after: str) -> DataFrame:
    """One row: whether the ``after`` stage has as many rows as ``before``."""
    counts = audit.groupBy().pivot("stage", [before, after]).agg(F.first("row_count"))
    return counts.select(
        F.lit(before).alias("before"),
        F.lit(after).alias("after"),
        (F.col(before) == F.col(after)).alias("rows_preserved"),
    )
