"""Exact moments: independent of the order of rows, equal to rational arithmetic."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fundlens.functions.exact import UnitMoments, WideMean
from fundlens.operators import profile as P


def unit_stats(df, scale):
    m = UnitMoments(F.col("x"), scale, "m")
    return df.agg(*m.aggregates()).select(m.average().alias("avg"), m.stddev().alias("sd")).first()


def wide_mean(df):
    m = WideMean(F.col("x"), "m")
    return df.agg(*m.aggregates()).select(m.average().alias("avg")).first().avg


@pytest.mark.parametrize("low,high,scale", [(-1000, 1000, 2), (0, 9_000_000, 2), (10**9, 10**9 + 50, 0), (-(2**61), 2**61, 0)])
def test_unit_moments_equal_rational_arithmetic(spark, low, high, scale):
    rng = random.Random(low)
    units = [rng.randrange(low, high) for _ in range(700)]
    xs = [u / 10**scale for u in units] if scale else units
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double" if scale else "x long").repartition(7)
    got = unit_stats(df, scale)
    mean = Fraction(sum(units), len(units)) / 10**scale
    assert math.isclose(got.avg, mean, rel_tol=1e-15)
    n = len(units)
    spread = Fraction(n * sum(u * u for u in units) - sum(units) ** 2, n * (n - 1))
    assert math.isclose(got.sd, math.sqrt(spread) / 10**scale, rel_tol=1e-12)
    for parts in (1, 3):
        again = unit_stats(df.repartition(parts, F.rand(parts)), scale)
        assert (again.avg, again.sd) == (got.avg, got.sd)


def test_wide_mean_over_many_magnitudes(spark):
    rng = random.Random(4)
    xs = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-9, 25) for _ in range(900)]
    xs += [0.1, -0.1, 2.0**40, -(2.0**40) - 0.5, 1e15 + 0.25, -0.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    expect = sum(map(Fraction, xs)) / len(xs)
    means = {wide_mean(df.repartition(n, F.rand(n))) for n in (1, 2, 5, 8)}
    assert len(means) == 1 and math.isclose(means.pop(), expect, rel_tol=1e-14)


def test_small_fractions_are_kept(spark):
    xs = [0.25045, -0.0136, 1e-12, 0.7241718052877]
    assert abs(wide_mean(spark.createDataFrame([(x,) for x in xs], "x double")) - statistics.fmean(xs)) < 1e-12


@pytest.mark.parametrize("xs,avg,sd", [([], None, None), ([None], None, None), ([2.5], 2.5, None), ([2.5, 2.5, 2.5], 2.5, 0.0)])
def test_few_rows(spark, xs, avg, sd):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = unit_stats(df, 2)
    assert (got.avg, got.sd) == (avg, sd) and wide_mean(df) == avg


def test_values_that_are_not_finite(spark):
    inf = float("inf")
    for xs, expect in (([1.0, inf], inf), ([-inf, 2.0], -inf), ([inf, -inf], None), ([float("nan"), 1.0], None)):
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        for got in (unit_stats(df, 2).avg, wide_mean(df)):
            assert got == expect if expect else math.isnan(got)
        assert math.isnan(unit_stats(df, 2).sd)


def test_profiles_with_exact_sums(spark):
    df = spark.createDataFrame([(i, i / 100, None) for i in range(1, 101)], "i int, x double, e double")
    plain = {r.column_name: r for r in P.numeric_stats(df, "t").collect()}
    exact = {r.column_name: r for r in P.numeric_stats(df, "t", exact_scale=2).collect()}
    for c in ("i", "x"):
        assert math.isclose(plain[c].avg, exact[c].avg) and math.isclose(plain[c].stddev, exact[c].stddev)
    assert exact["e"].avg is None and exact["e"].stddev is None
    rep = {r.feature: r.avg for r in P.feature_stats(df, {"g": ("x", "e")}, exact=True).collect()}
    assert math.isclose(rep["x"], 0.505) and rep["e"] is None
