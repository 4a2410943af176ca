"""The feature pipeline against a plain-Python brute force on random fixtures.

Inputs carry cents, nulls, zeros, negative people counts and missing keys;
with ``exact_scale=2`` every sum is exact, so the comparison is exact.
"""

import random

import pytest

from fundlens.functions import EPS
from fundlens.operators.features import FEATURE_COLUMNS
from fundlens.plans.features import build_features

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


def _money(rng, null_p=0.2, zero_p=0.1, neg=False):
    r = rng.random()
    if r < null_p:
        return None
    if r < null_p + zero_p:
        return 0.0
    v = rng.randint(0, 10_000_000) / 100
    return -v if neg and rng.random() < 0.2 else v


def _fixture(seed):
    rng = random.Random(seed)
    countries, clusters, years = ["A", "B", "C"], ["K1", "K2", None], [2020, 2021]
    base = []
    for i in range(60):
        base.append(
            (
                rng.choice(countries),
                rng.choice(clusters),
                None,
                rng.choice(years),
                None if rng.random() < 0.1 else i,
                f"n{i}",
                None,
                None,
                None,
                _money(rng),
                _money(rng),
                _money(rng),
            )
        )
    needs = [
        (rng.choice(countries[:2]), rng.choice(clusters), None, _money(rng, neg=True),
         _money(rng, neg=True), _money(rng), _money(rng))
        for _ in range(15)
    ]
    pop = [(rng.choice(countries[:2]), "x", rng.choice(years), _money(rng, zero_p=0.0)) for _ in range(10)]
    return base, needs, pop


def _exact_sum(values):
    vals = [round(v * 100) for v in values if v is not None]
    return float(sum(vals)) / 100.0 if vals else None


def _ratio(n, d):
    return None if n is None or d is None else n / (d + EPS)


def _brute(base, needs, pop):
    nagg = {}
    for c, k, _p, inneed, targeted, affected, reached in needs:
        nagg.setdefault((c, k), []).append((targeted, inneed, affected, reached))
    nsum = {
        key: tuple(_exact_sum([r[i] for r in rows]) for i in range(4)) for key, rows in nagg.items()
    }
    pagg = {}
    for c, _n, y, p in pop:
        pagg.setdefault((c, y), []).append(p)
    psum = {key: _exact_sum(v) for key, v in pagg.items()}

    rows = []
    for c, k, kn, y, aid, an, ac, sd, ed, req, fund, pct in base:
        t, i_, a, r = nsum.get((c, k), (None,) * 4) if k is not None else (None,) * 4
        p = psum.get((c, y))
        fund = 0.0 if fund is None else fund
        pct = 0.0 if pct is None else pct
        t, i_, a, r, p = (0.0 if v is None else v for v in (t, i_, a, r, p))
        gap = None if req is None else req - fund
        rows.append(
            dict(
                country_code=c, year=y, cluster_code=k, cluster_name=kn, appeal_id=aid,
                appeal_name=an, appeal_code=ac, startDate=sd, endDate=ed,
                total_requirements_usd=req, total_funding_usd=fund, funding_percent=pct,
                targeted=t, inneed=i_, affected=a, reached=r, population=p,
                beneficiary_to_funding_ratio=_ratio(t, fund),
                need_to_requirements_ratio=_ratio(i_, req),
                targeting_coverage_rate=_ratio(t, i_),
                funding_gap_usd=gap,
                funding_gap_pct=(req - fund) / req * 100 if req is not None and req > 0 else None,
                funding_coverage_rate=_ratio(fund, req),
                cost_per_beneficiary=fund / t if t > 0 else None,
                cost_per_capita=_ratio(fund, p),
                requirement_per_capita=_ratio(req, p),
                funding_coverage_pct=_ratio(fund, p) * 100,
                requirement_coverage_pct=None if req is None else _ratio(req, p) * 100,
            )
        )
    groups = {}
    for row in rows:
        groups.setdefault((row["country_code"], row["year"], row["cluster_code"]), []).append(row)
    for members in groups.values():
        w1 = _exact_sum([m["total_requirements_usd"] for m in members])
        w2 = _exact_sum([m["total_funding_usd"] for m in members])
        w3 = _exact_sum([m["funding_gap_usd"] for m in members])
        w4 = sum(1 for m in members if m["appeal_id"] is not None)
        for m in members:
            eff = None if _ratio(w2, w1) is None else _ratio(w2, w1) * 100
            m.update(
                sector_total_requirements_usd=w1,
                sector_total_funding_usd=w2,
                sector_total_gap_usd=w3,
                sector_project_count=w4,
                project_funding_share_of_sector_pct=_ratio(m["total_funding_usd"], w2) * 100,
                project_requirement_share_of_sector_pct=(
                    None if _ratio(m["total_requirements_usd"], w1) is None
                    else _ratio(m["total_requirements_usd"], w1) * 100
                ),
                sector_funding_efficiency_pct=eff,
                project_funding_status_vs_sector_avg=None if eff is None else m["funding_percent"] - eff,
            )
    return sorted((tuple(m[c] for c in FEATURE_COLUMNS) for m in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("strategy,bmax", [("aggregate", 1000), ("window", None), ("aggregate", None)])
def test_features_equal_brute_force(spark, seed, strategy, bmax):
    base, needs, pop = _fixture(seed)
    out = build_features(
        spark.createDataFrame(base, BASE_SCHEMA),
        spark.createDataFrame(needs, NEEDS_SCHEMA),
        spark.createDataFrame(pop, POP_SCHEMA),
        sector_strategy=strategy,
        exact_scale=2,
        broadcast_max_rows=bmax,
    )
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == _brute(base, needs, pop)
