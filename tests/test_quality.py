import pytest

from fundlens.operators.quality import (
    join_preserves_rows,
    nulls_after_fill,
    quality_report,
    stage_audit,
)


def test_quality_report_flags_null_keys(spark):
    df = spark.createDataFrame(
        [("A", None, 2024, 1.0), ("B", "K", 2024, None)],
        "country_code string, cluster_code string, year int, population double",
    )
    got = {r.column_name: r for r in quality_report(df).collect()}
    assert len(got) == 12 and {c for c, r in got.items() if not r.absent} == {"country_code", "cluster_code", "year", "population"}
    assert got["inneed"].absent and got["inneed"].expectation_failed and got["inneed"].null_count == 2
    assert got["cluster_code"].expectation_failed and got["cluster_code"].null_pct == 50.0
    assert not got["country_code"].expectation_failed
    assert not got["population"].expect_non_null and not got["population"].expectation_failed


def test_stage_audit_and_row_preservation(spark):
    a = spark.range(5)
    b = a.join(spark.range(3).withColumnRenamed("id", "j"), a.id == 1000, "left")
    audit = stage_audit({"base": a, "joined": b})
    assert [(r.step, r.stage, r.row_count) for r in audit.orderBy("step").collect()] == [
        (1, "base", 5),
        (2, "joined", 5),
    ]
    assert join_preserves_rows(audit, "base", "joined").first().rows_preserved


def test_nulls_after_fill(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert [(r.column_name, r.null_count) for r in nulls_after_fill(df).collect()] == [("b", 2), ("a", 1)]


def test_stage_counts_come_from_one_run(spark):
    from fundlens.operators.quality import StageCounts, stage_audit

    sc = spark.sparkContext
    rows = [(i, f"k{i % 3}" if i % 5 else None) for i in range(40)]

    def stages(counts=None):
        watch = counts.watch if counts else (lambda stage, df: df)
        raw = watch("raw", spark.createDataFrame(rows, "id int, k string"))
        kept = watch("kept", raw.dropna(subset=["k"]))
        side = kept.groupBy("k").count().withColumnRenamed("count", "n")
        joined = watch("joined", kept.join(side, "k", "left"))
        return {"raw": raw, "kept": kept, "joined": joined}

    def jobs(name, run):
        sc.setJobGroup(name, name)
        run()
        sc.setJobGroup("idle", "idle")
        return len(sc.statusTracker().getJobIdsForGroup(name))

    counts = StageCounts()
    watched = stages(counts)
    with pytest.raises(RuntimeError, match="raw, kept, joined"):
        counts.report(spark)
    plain = stages()["joined"]
    one = jobs("plain-run", lambda: plain.write.format("noop").mode("overwrite").save())
    assert jobs("watched-run", lambda: watched["joined"].write.format("noop").mode("overwrite").save()) == one
    report = counts.report(spark)
    assert counts.pending() == [] and report.schema["row_count"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, stage_audit(stages()).collect()))
    with pytest.raises(ValueError, match="watched already"):
        counts.watch("raw", watched["raw"])


def test_stage_counts_of_empty_stages(spark):
    from fundlens.operators.quality import StageCounts

    counts = StageCounts()
    empty = counts.watch("none", spark.range(5).filter("id > 9"))
    empty.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in counts.report(spark).collect()] == [(1, "none", 0)]
