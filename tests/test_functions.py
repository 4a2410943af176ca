import math

from pyspark.sql import functions as F

from fundlens.functions import (
    EPS,
    coalesce_existing,
    explode_multi,
    fold_name,
    guarded_ratio,
    resolve_column,
    resolve_columns,
    safe_ratio,
    sum_measure,
)


def test_fold_name_variants():
    assert fold_name("In Need") == fold_name("inneed") == "inneed"
    assert fold_name("Country ISO3") == fold_name("country_iso3")


def test_resolve_columns_order_and_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Country ISO3` int, other int, country_iso3 int")
    assert resolve_columns(df, ["country_iso3", "Country ISO3"]) == ["Country ISO3", "country_iso3"]
    assert resolve_column(df, ["nope", "OTHER"]) == "other"
    assert resolve_column(df, ["nope"]) is None


def test_coalesce_existing_prefers_first_non_null(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "c")], "`Country ISO3` string, country_iso3 string")
    c = coalesce_existing(df, ["Country ISO3", "country_iso3"])
    assert [r[0] for r in df.select(c).collect()] == ["b", "a"]
    assert coalesce_existing(df, ["missing"]) is None


def test_safe_ratio_zero_divisor_is_large_finite(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0), (None, 1.0)], "n double, d double")
    out = [r[0] for r in df.select(safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert out[0] == 5.0 / EPS and math.isfinite(out[0])
    assert out[1] == 5.0 / (2.0 + EPS)
    assert out[2] is None


def test_guarded_ratio_null_unless_positive(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, -1.0), (6.0, 3.0)], "n double, d double")
    out = [r[0] for r in df.select(guarded_ratio(F.col("n"), F.col("d"))).collect()]
    assert out == [None, None, 2.0]


def test_sum_measure_exact_is_partition_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,), (1e6 + 0.01,), (None,)] * 50
    df = spark.createDataFrame(vals, "x double")
    a = df.repartition(1).agg(sum_measure(F.col("x"), 2)).first()[0]
    b = df.repartition(7).agg(sum_measure(F.col("x"), 2)).first()[0]
    assert a == b == (10 + 20 + 30 + 100000001) * 50 / 100
    allnull = spark.createDataFrame([(None,)], "x double")
    assert allnull.agg(sum_measure(F.col("x"), 2)).first()[0] is None


def test_explode_multi_trims_drops_empty_keeps_null_rows(spark):
    df = spark.createDataFrame(
        [(1, "a, B,,c "), (2, None), (3, " , ")], "id int, dest string"
    )
    rows = sorted(
        explode_multi(df, "dest", lower=True).collect(), key=lambda r: (r.id, r.dest or "")
    )
    assert [(r.id, r.dest) for r in rows] == [(1, "a"), (1, "b"), (1, "c"), (2, None), (3, None)]
    dropped = explode_multi(df, "dest", keep_empty=False).select("id").distinct().collect()
    assert [r.id for r in dropped] == [1]
