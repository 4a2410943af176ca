from fundlens.operators import profile as P


def _df(spark):
    rows = [
        (1, "a", 1.0, None),
        (2, "b", None, None),
        (2, None, 3.0, None),
        (3, "a", float("nan"), None),
    ]
    return spark.createDataFrame(rows, "k int, s string, x double, allnull double")


def test_null_counts_and_ranking(spark):
    prof = P.null_counts(_df(spark), "t")
    got = {r.column_name: (r.null_count, r.row_count, r.null_pct) for r in prof.collect()}
    assert got == {"k": (0, 4, 0.0), "s": (1, 4, 25.0), "x": (1, 4, 25.0), "allnull": (4, 4, 100.0)}
    ranked = [r.column_name for r in P.null_ranking(prof).collect()]
    assert ranked == ["allnull", "s", "x"]
    assert P.null_total(prof).first().total_nulls == 6


def test_null_pct_zero_rows(spark):
    empty = spark.createDataFrame([], "a int")
    r = P.null_counts(empty, "e").first()
    assert (r.null_count, r.row_count, r.null_pct) == (0, 0, 0.0)


def test_distinct_counts_exact_and_approx(spark):
    df = _df(spark)
    exact = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t").collect()}
    assert exact == {"k": 3, "s": 2, "x": 3, "allnull": 0}
    approx = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t", approx=True).collect()}
    assert approx["k"] == 3 and approx["allnull"] == 0


def test_distinct_counts_plan_has_no_expand(spark):
    plan = P.distinct_counts(_df(spark), "t")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_top_cardinality_ties_by_name(spark):
    prof = spark.createDataFrame(
        [("t", "b", 5), ("t", "a", 5), ("t", "c", None), ("t", "d", 9)],
        "dataset string, column_name string, distinct_count bigint",
    )
    assert [r.column_name for r in P.top_cardinality(prof, 3).collect()] == ["d", "a", "b"]


def test_numeric_stats_keeps_all_null_column(spark):
    df = _df(spark)
    assert P.numeric_columns(df) == ["k", "x", "allnull"]
    got = {r.column_name: r for r in P.numeric_stats(df, "t", ["k", "allnull"]).collect()}
    assert (got["k"].min, got["k"].max, got["k"].avg) == (1.0, 3.0, 2.0)
    assert got["allnull"].min is None and got["allnull"].stddev is None


def test_key_profile_and_samples(spark):
    df = _df(spark)
    r = P.key_profile(df, "t", "s").first()
    assert (r.null_count, r.row_count, r.null_pct, r.distinct_count) == (1, 4, 25.0, 2)
    samples = P.key_samples(df, "t", "k", n=2).collect()
    assert [(x.sample_rank, x.sample_value) for x in samples] == [(1, "1"), (2, "2")]


def test_key_profiles_skip_absent(spark):
    dfs = {"t": _df(spark)}
    out = P.key_profiles(dfs, {"t": ["s", "missing"], "absent": ["x"]})
    assert [r.column_name for r in out.collect()] == ["s"]
    assert P.key_profiles(dfs, {"absent": ["x"]}) is None


def test_join_key_candidates_multi_kind(spark):
    df = spark.createDataFrame([], "countryCode string, destPlanCode string, amountUSD double, foo int")
    got = {(r.column_name, r.key_kind) for r in P.join_key_candidates(spark, {"d": df}).collect()}
    assert got == {
        ("countrycode", "country"),
        ("destplancode", "country"),
        ("amountusd", "funding"),
    }


def test_profile_shape_and_schema(spark):
    df = _df(spark)
    r = P.profile_shape({"t": df}).first()
    assert (r.dataset, r.row_count, r.column_count, r.columns) == ("t", 4, 4, "k, s, x, allnull")
    sch = [(r.ordinal, r.column_name, r.data_type) for r in P.profile_schema(spark, {"t": df}).collect()]
    assert sch[0] == (1, "k", "int") and sch[3] == (4, "allnull", "double")


def test_sample_rows_ordered(spark):
    got = [r.k for r in P.sample_rows(_df(spark), 2, order_by=["k"]).collect()]
    assert got == [1, 2]


def test_feature_stats_groups(spark):
    from fundlens.operators.features import FEATURE_COLUMNS

    cols = ", ".join(f"`{c}` double" for c in P.FEATURE_STAT_GROUPS["project"])
    df = spark.createDataFrame([tuple(float(i) for i in range(6))], cols)
    groups = {k: v for k, v in P.FEATURE_STAT_GROUPS.items() if k == "project"}
    out = {r.feature: (r.feature_group, r.min) for r in P.feature_stats(df, groups).collect()}
    assert out["funding_gap_pct"] == ("project", 3.0)
    assert set(P.FEATURE_STAT_GROUPS["sector"]) <= set(FEATURE_COLUMNS)


def test_distinct_counts_single_pass_matches_union(spark):
    df = _df(spark)
    a = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t").collect()}
    b = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t", single_pass=True).collect()}
    assert a == b


def test_key_profile_many_columns_one_aggregate(spark):
    out = {r.column_name: (r.null_count, r.distinct_count) for r in P.key_profile(_df(spark), "t", ["k", "s"]).collect()}
    assert out == {"k": (0, 3), "s": (1, 2)}


def test_distinct_counts_batches_match(spark):
    df = _df(spark)
    a = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t").collect()}
    for size in (2, 3):
        b = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t", batch_size=size).collect()}
        assert a == b


def test_distinct_counts_wide_table_uses_batches(spark):
    cols = ", ".join(f"c{i} int" for i in range(40))
    df = spark.createDataFrame([tuple(range(40)), tuple(i % 2 for i in range(40))], cols)
    prof = P.distinct_counts(df, "w", batch_size=8)
    got = {r.column_name: r.distinct_count for r in prof.collect()}
    assert got["c0"] == 1 and got["c3"] == 2 and len(got) == 40
    plan = prof._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") < 40


def test_key_profile_batches(spark):
    df = _df(spark)
    one = {r.column_name: (r.null_count, r.distinct_count) for r in P.key_profile(df, "t", ["k", "s", "x"]).collect()}
    two = {r.column_name: (r.null_count, r.distinct_count) for r in P.key_profile(df, "t", ["k", "s", "x"], batch_size=2).collect()}
    assert one == two == {"k": (0, 3), "s": (1, 2), "x": (1, 3)}


def test_key_samples_materialized_inputs_same(spark):
    dfs = {"t": _df(spark)}
    cfg = {"t": ["k", "s"]}
    a = sorted(map(tuple, P.key_samples_all(dfs, cfg, 2).collect()))
    b = sorted(map(tuple, P.key_samples_all(dfs, cfg, 2, materialize_inputs=True).collect()))
    assert a == b and len(a) == 4


def test_numeric_profile_has_every_column_and_exact_extremes(spark):
    wide = ", ".join(f"c{i} bigint" for i in range(20))
    df = spark.createDataFrame([tuple([9007199254740993] * 20), tuple([-1] * 20)], wide)
    got = P.numeric_stats(df, "w").collect()
    assert len(got) == 20 and {(r.exact_min, r.exact_max) for r in got} == {("-1", "9007199254740993")}
    assert P.numeric_stats(spark.createDataFrame([("a",)], "s string"), "w").collect() == []


def test_top_cardinality_is_per_dataset(spark):
    rows = [("wide", f"c{i:02d}", 100 + i) for i in range(20)] + [("small", "a", 1), ("small", "b", None)]
    got = P.top_cardinality(spark.createDataFrame(rows, "dataset string, column_name string, distinct_count bigint")).collect()
    assert len(got) == 17 and sum(r.dataset == "small" for r in got) == 2


def _scans(df):
    """File scans of a finished adaptive plan, without those below a reused exchange."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan().toString()
    return plan.count("FileScan parquet"), plan


def test_key_reports_scan_each_input_once(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"k{i % 3}", float(i % 4), None) for i in range(400)]
    path = f"{tmp_path}/t"
    spark.createDataFrame(rows, "i int, s string, x double, e date").repartition(3).write.parquet(path)
    df, cols = spark.read.parquet(path), ["i", "s", "x", "e"]
    for report in (P.key_profile(df, "t", cols), P.key_samples(df, "t", cols, 3)):
        assert _scans(report)[0] == 1
    report = P.key_report(df, "t", cols, 2)
    scans, plan = _scans(report)
    assert plan.count("ReusedExchange") + (scans == 1) >= 1
    got = {r.column_name: r for r in report.collect()}
    assert (got["i"].row_count, got["i"].null_count, got["i"].distinct_count) == (400, 80, 7)
    zeros = sum(1 for r in rows if r[0] == 0)
    assert [tuple(s) for s in got["i"].samples] == [("0", zeros), ("1", sum(1 for r in rows if r[0] == 1))]
    assert [s.value for s in got["x"].samples] == ["0.0", "1.0"]
    assert (got["e"].null_count, got["e"].distinct_count, got["e"].samples) == (400, 0, [])


def test_key_report_of_an_empty_table_and_floats(spark):
    empty = P.key_report(spark.createDataFrame([], "a int, b string"), "t", ["a", "b"]).collect()
    assert [(r.row_count, r.null_count, r.null_pct, r.distinct_count, r.samples) for r in empty] == [(0, 0, 0.0, 0, [])] * 2
    floats = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,)], "x double")
    got = P.key_report(floats, "t", "x").first()
    assert (got.distinct_count, got.null_count) == (2, 1) and [s.occurrences for s in got.samples] == [2, 2]
