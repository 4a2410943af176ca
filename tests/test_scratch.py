"""Shared scratch, its release, the byte bound of broadcasts and exact sums."""

import os

from pyspark.sql import functions as F

from fundlens.functions.columns import sum_measure
from fundlens.operators.join import broadcast_if_small, materialize
from fundlens.session import release_scratch, scratch_path


def test_materialized_tables_are_released(spark):
    path = scratch_path(spark, "probe")
    assert materialize(spark.range(5), as_table=True).count() == 5
    folder = os.path.dirname(path).removeprefix("file:")
    assert os.listdir(folder)
    release_scratch(spark)
    assert not os.path.exists(folder) or not os.listdir(folder)


def test_broadcast_is_bounded_by_bytes_too(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(wide))
    assert not hinted(broadcast_if_small(wide, max_bytes=50_000))
    assert not hinted(broadcast_if_small(wide, max_rows=10))


def test_exact_sums_survive_nan_and_large_totals(spark):
    df = spark.createDataFrame([("a", 9e16), ("a", 9e16), ("b", float("nan")), ("b", 1.0), ("c", None), ("d", -2.25), ("d", 1.0)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(sum_measure(F.col("v"), 2).alias("s")).collect()}
    assert got["a"] == 1.8e17 and got["b"] != got["b"] and got["c"] is None and got["d"] == -1.25
