"""Profile state: incremental equals full on a table that is appended to, and only new partitions are read."""

import pytest
from pyspark.sql import functions as F

from fundlens.operators.profile_state import ProfileState, merged_profile, partition_profiles
from fundlens.sinks.versions import versions


def load(spark, day, low, high):
    ids = spark.range(low, high)
    return ids.select(
        "id",
        (F.col("id") % 997).cast("int").alias("k"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 5000)).alias("s"),
        F.when(F.col("id") % 2 > 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("z"),
        F.array(F.col("id") % 10).alias("a"),
        F.lit(None).cast("date").alias("none"),
        F.lit(day).cast("string").alias("day"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_incremental_equals_full_on_an_appended_table(spark, tmp_path):
    table, state = f"{tmp_path}/t", ProfileState(spark, f"{tmp_path}/state")
    bounds = {"d1": (0, 30_000), "d2": (20_000, 70_000), "d3": (60_000, 61_000), None: (5, 40)}
    for i, (day, (low, high)) in enumerate(bounds.items()):
        load(spark, day, low, high).repartition(3).write.mode("append").partitionBy("day").parquet(table)
        assert state.update(spark.read.parquet(table), "t", ["day"]) == 1
        assert state.update(spark.read.parquet(table), "t", ["day"]) == 0
        assert len(versions(spark, state.path)) == i + 1
    df = spark.read.parquet(table)
    full = merged_profile(partition_profiles(df, "t", ["day"]))
    assert rows(state.profile()) == rows(full)
    got = {r.column_name: r for r in state.profile().collect()}
    total = sum(b - a for a, b in bounds.values())
    assert {r.row_count for r in got.values()} == {total}
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in got], *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n_{c}") for c in got]).first()
    for c, r in got.items():
        assert r.null_count == exact[f"n_{c}"]
        assert abs(r.distinct_estimate - exact[c]) <= 0.03 * exact[c]
    assert got["z"].distinct_estimate == 1 and got["none"].distinct_estimate == 0 and got["none"].null_pct == 100.0


def test_only_new_partitions_are_read(spark, tmp_path, monkeypatch):
    table, state = f"{tmp_path}/t", ProfileState(spark, f"{tmp_path}/state")
    scanned, plain = [], partition_profiles
    monkeypatch.setattr("fundlens.operators.profile_state.partition_profiles", lambda df, *a: scanned.append(df) or plain(df, *a))
    for i, day in enumerate(["d1", "d2"]):
        load(spark, day, i * 100, i * 100 + 50).write.mode("append").partitionBy("day").parquet(table)
        assert state.update(spark.read.parquet(table), "t", ["day"]) == 1
        plan = scanned[-1]._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert day in filters and ("d1" in filters) == (day == "d1")
    assert {r.row_count for r in state.profile().collect()} == {100}


def test_a_failed_update_leaves_nothing(spark, tmp_path):
    state = ProfileState(spark, f"{tmp_path}/state")
    df = spark.createDataFrame([("p", 1)], "p string, v int")
    assert state.update(df, "t", ["p"]) == 1
    failing = spark.createDataFrame([("q", 1)], df.schema).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        state.update(failing, "t", ["p"])
    assert len(versions(spark, state.path, marked=False)) == 1


def test_refresh_several_datasets_and_keys(spark, tmp_path, monkeypatch):
    state = ProfileState(spark, f"{tmp_path}/state")
    df = spark.createDataFrame([(2020, "a", 1), (2020, "b", 2), (2021, "a", None)], "y int, src string, v int")
    assert state.update(df, "one", ["y", "src"]) == 3
    assert state.update(df, "two", ["y"], columns=["v"]) == 2
    changed = df.unionByName(spark.createDataFrame([(2020, "a", 9)], df.schema))
    assert state.update(changed, "one", ["y", "src"]) == 0
    assert state.update(changed, "one", ["y", "src"], refresh=[(2020, "a")]) == 1
    got = {(r.dataset, r.column_name): (r.row_count, r.null_count, r.distinct_estimate) for r in state.profile().collect()}
    assert got == {("one", "v"): (4, 1, 3), ("two", "v"): (3, 1, 2)}
    monkeypatch.setattr("fundlens.operators.profile_state.NAMED_PARTITIONS", 1)
    other = ProfileState(spark, f"{tmp_path}/other")
    assert other.update(df, "one", ["y", "src"]) == 3  # more partitions than are named: a semi join
    assert {r.row_count for r in other.profile().collect()} == {3}


def test_an_empty_table(spark, tmp_path):
    state = ProfileState(spark, f"{tmp_path}/state")
    assert state.update(spark.createDataFrame([], "v int, p string"), "t", ["p"]) == 0
    assert state.profile().collect() == []
