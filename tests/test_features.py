import pytest
from pyspark.sql import functions as F

from fundlens.functions import EPS
from fundlens.operators.features import FEATURE_COLUMNS
from fundlens.plans.features import build_features, feature_stages

BASE_SCHEMA = (
    "country_code string, cluster_code string, cluster_name string, year int, appeal_id bigint, "
    "appeal_name string, appeal_code string, startDate date, endDate date, "
    "total_requirements_usd double, total_funding_usd double, funding_percent double"
)
NEEDS_SCHEMA = (
    "country_code string, cluster_code string, population double, inneed double, "
    "targeted double, affected double, reached double"
)
POP_SCHEMA = "country_code string, country string, year int, population double"


def _base(spark):
    rows = [
        ("C1", "K1", "k1", 2024, 1, "A", "a", None, None, 100.0, 40.0, 40.0),
        ("C1", "K1", "k1", 2024, 2, "B", "b", None, None, 300.0, None, None),
        ("C1", None, None, 2024, 3, "C", "c", None, None, 0.0, 10.0, None),
        ("C1", None, None, 2024, 4, "D", "d", None, None, None, 5.0, None),
        ("C2", "K1", "k1", 2023, 5, "E", "e", None, None, 50.0, 50.0, 100.0),
        ("C3", "K2", "k2", 2024, None, "F", "f", None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, BASE_SCHEMA)


def _needs(spark):
    rows = [
        ("C1", "K1", None, 1000.0, 200.0, None, None),
        ("C1", "K1", None, 500.0, -50.0, 10.0, None),
        ("C1", None, None, 7.0, 7.0, None, None),
    ]
    return spark.createDataFrame(rows, NEEDS_SCHEMA)


def _pop(spark):
    rows = [("C1", "n", 2024, 1000.0), ("C1", "n", 2024, 3000.0), ("C2", "m", 2022, 5.0)]
    return spark.createDataFrame(rows, POP_SCHEMA)


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
@pytest.mark.parametrize("bmax", [None, 1000, 0])
def test_features_hand_computed(spark, strategy, bmax):
    out = build_features(
        _base(spark), _needs(spark), _pop(spark), sector_strategy=strategy, broadcast_max_rows=bmax
    )
    assert tuple(out.columns) == FEATURE_COLUMNS
    r = {x.appeal_name: x for x in out.collect()}
    assert len(r) == 6

    a = r["A"]
    assert (a.targeted, a.inneed, a.affected, a.reached, a.population) == (150.0, 1500.0, 10.0, 0.0, 4000.0)
    assert a.beneficiary_to_funding_ratio == 150.0 / (40.0 + EPS)
    assert a.need_to_requirements_ratio == 1500.0 / (100.0 + EPS)
    assert a.targeting_coverage_rate == 150.0 / (1500.0 + EPS)
    assert a.funding_gap_usd == 60.0 and a.funding_gap_pct == 60.0
    assert a.funding_coverage_rate == 40.0 / (100.0 + EPS)
    assert a.cost_per_beneficiary == 40.0 / 150.0
    assert a.cost_per_capita == 40.0 / (4000.0 + EPS)
    assert a.funding_coverage_pct == a.cost_per_capita * 100
    assert a.requirement_coverage_pct == a.requirement_per_capita * 100
    assert (a.sector_total_requirements_usd, a.sector_total_funding_usd) == (400.0, 40.0)
    assert (a.sector_total_gap_usd, a.sector_project_count) == (360.0, 2)
    assert a.project_funding_share_of_sector_pct == 40.0 / (40.0 + EPS) * 100
    assert a.project_requirement_share_of_sector_pct == 100.0 / (400.0 + EPS) * 100
    eff = 40.0 / (400.0 + EPS) * 100
    assert a.sector_funding_efficiency_pct == eff
    assert a.project_funding_status_vs_sector_avg == 40.0 - eff

    b = r["B"]  # funding filled with 0
    assert (b.total_funding_usd, b.funding_percent, b.funding_gap_pct) == (0.0, 0.0, 100.0)
    assert b.cost_per_beneficiary == 0.0 and b.project_funding_share_of_sector_pct == 0.0

    c = r["C"]  # null cluster: no needs match; zero requirements
    assert (c.targeted, c.inneed) == (0.0, 0.0)
    assert c.funding_gap_pct is None and c.cost_per_beneficiary is None
    assert c.funding_coverage_rate == 10.0 / EPS
    assert (c.sector_total_requirements_usd, c.sector_total_funding_usd) == (0.0, 15.0)
    assert (c.sector_total_gap_usd, c.sector_project_count) == (-10.0, 2)

    d = r["D"]  # null requirements stay null (never filled)
    assert d.total_requirements_usd is None and d.funding_gap_usd is None
    assert d.need_to_requirements_ratio is None and d.requirement_per_capita is None

    e = r["E"]  # no needs, no population for that year
    assert (e.targeted, e.population) == (0.0, 0.0)
    assert e.cost_per_capita == 50.0 / EPS
    assert e.sector_project_count == 1 and e.sector_total_gap_usd == 0.0

    f = r["F"]  # all-null group: sums null, count of null ids 0
    assert f.sector_total_requirements_usd is None and f.sector_total_funding_usd == 0.0
    assert f.sector_project_count == 0 and f.sector_funding_efficiency_pct is None
    assert f.project_funding_status_vs_sector_avg is None


def test_missing_inputs_give_zero_measures(spark):
    out = build_features(_base(spark), None, None, broadcast_max_rows=None)
    assert tuple(out.columns) == FEATURE_COLUMNS
    r = out.filter(F.col("appeal_name") == "A").first()
    assert (r.targeted, r.inneed, r.affected, r.reached, r.population) == (0.0,) * 5
    assert r.beneficiary_to_funding_ratio == 0.0


def test_bad_strategy_raises(spark):
    with pytest.raises(ValueError):
        build_features(_base(spark), sector_strategy="nope", broadcast_max_rows=None)


def _standin_stages(spark, small_dir, **kw):
    from fundlens.operators.standardize import (
        standardize_needs,
        standardize_population,
        standardize_requirements,
    )
    from fundlens.sources import standins

    raw = standins.raw_datasets(spark, small_dir)
    req = kw.pop("req_transform", lambda d: d)(standardize_requirements(raw["requirements"]))
    return feature_stages(
        req,
        standardize_needs(raw["needs"]),
        standardize_population(raw["population"]),
        exact_scale=2,
        **kw,
    )


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_strategies_and_partitionings_agree(spark, small_dir):
    ref = _rows(_standin_stages(spark, small_dir, sector_strategy="window", broadcast_max_rows=None).features)
    agg = _rows(_standin_stages(spark, small_dir, sector_strategy="aggregate").features)
    shuffled = _rows(
        _standin_stages(
            spark,
            small_dir,
            broadcast_max_rows=None,
            req_transform=lambda d: d.repartition(5, "appeal_id"),
        ).features
    )
    assert ref == agg == shuffled


def test_invariants_on_standins(spark, small_dir):
    st = _standin_stages(spark, small_dir, broadcast_max_rows=None)
    n = st.base.count()
    assert st.after_needs.count() == n and st.after_population.count() == n
    feats = st.features
    assert feats.filter(F.col("funding_coverage_pct") != F.col("cost_per_capita") * 100).count() == 0
    shares = (
        feats.filter(F.col("sector_total_funding_usd") > 0)
        .groupBy("country_code", "year", "cluster_code")
        .agg(F.sum("project_funding_share_of_sector_pct").alias("s"))
        .filter(F.abs(F.col("s") - 100) > 1e-6)
    )
    assert shares.count() == 0


def test_fallback_without_broadcast_uses_shuffle_join(spark):
    """Above the bound nothing is hinted: with Spark's own auto-broadcast off the
    joins become sort-merge joins, and the rows are the same as with broadcasts."""
    expected = _rows(build_features(_base(spark), _needs(spark), _pop(spark), exact_scale=2))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = build_features(
            _base(spark), _needs(spark), _pop(spark), exact_scale=2, broadcast_max_rows=0
        )
        got = _rows(out)
        final = out._jdf.queryExecution().executedPlan().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == expected
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final
