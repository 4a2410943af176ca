"""Both workflows end to end on hand-made CSV inputs written by the test."""

import os
import tempfile

from fundlens.plans.workflows import feature_pipeline, ingest

REQ = (
    "countryCode,clusterCode,cluster,year,id,name,code,startDate,endDate,requirements,funding,percentFunded\n"
    "#country+code,#sector+code,#sector+name,#date+year,#activity+id,#activity+name,#activity+code,"
    "#date+start,#date+end,#value+required,#value+funding,#value+percent\n"
    'AFG,FSC,"Food, Security",2024,1,"Appeal ""one""",HAFG24,2024-01-01,2024-12-31,100,40,40\n'
    "AFG,FSC,Food,2024,2,Two,HAFG24,2024-01-01,2024-12-31,300,,\n"
    "AFG,,,2024,3,Three,HAFG24,,,0,10,\n"
    ",FSC,Food,2024,4,NoCountry,X,,,5,5,100\n"
    "SYR,WSH,Water,2023,5,Five,HSYR23,,,50,50,100\n"
)
HNO = (
    "Country ISO3,Cluster,Population,In Need,Targeted,Affected,Reached\n"
    "AFG,FSC,10,1000,200,,\n"
    "AFG,FSC,10,500,-50,10,\n"
)
POP = "ISO3,Country,Reference_year,Population\nAFG,Afghanistan,2024,1000\nAFG,Afghanistan,2024,3000\n"


def test_ingest_then_feature_pipeline(spark):
    d = tempfile.mkdtemp(prefix="fundlens-inputs-")
    for name, text in {
        "fts_requirements_funding_globalcluster_global.csv": REQ,
        "hpc_hno_2025.csv": HNO,
        "cod_population_admin1.csv": POP,
    }.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    loc = tempfile.mkdtemp(prefix="fundlens-db-")
    rep = ingest(spark, d, "fl_flow", location=loc)
    assert {"hrp", "fts_incoming", "fts_internal", "fts_outgoing"} <= set(rep.failures)
    shape = {r.dataset: r.row_count for r in rep.shape.collect()}
    assert shape == {"hno": 2, "fts_requirements": 5, "population": 2}  # tag row dropped
    keys = {(r.dataset, r.column_name): r.distinct_count for r in rep.key_profile.collect()}
    assert keys[("fts_requirements", "countryCode")] == 2
    assert rep.nulls.filter("dataset = 'fts_requirements' AND column_name = 'funding'").first().null_count == 1
    assert rep.distinct.count() == 12 + 7 + 4

    res = feature_pipeline(spark, "fl_flow", location=loc, exact_scale=2)
    rows = {str(r.appeal_id): r for r in res.features.collect()}
    assert sorted(rows) == ["1", "2", "3", "5"]
    assert {r.column_name for r in rep.numeric.filter("dataset = 'population'").collect()} == {"Reference_year", "Population"}
    assert {r.tableName for r in rep.tables.collect()} >= {"raw_hno", "raw_population"}
    assert res.preview.count() == 4 and set(rep.previews) == {"hno", "fts_requirements", "population"}
    assert rows["1"].targeted == 150.0 and rows["1"].population == 4000.0
    assert rows["1"].sector_total_requirements_usd == 400.0 and rows["1"].sector_project_count == 2
    assert rows["5"].targeted == 0.0 and rows["5"].population == 0.0
    assert [r.row_count for r in res.audit.orderBy("step").collect()] == [4, 4, 4]
    assert res.plans is None and "plans" in res.failures
    q = {r.column_name: r.null_count for r in res.quality.collect()}
    assert q["cluster_code"] == 1 and q["country_code"] == 0
    assert res.feature_stats.count() == 14


def test_command_line(spark, capsys):
    from fundlens.__main__ import main

    d = tempfile.mkdtemp(prefix="fundlens-inputs-")
    with open(os.path.join(d, "fts_requirements_funding_globalcluster_global.csv"), "w") as fh:
        fh.write(REQ)
    loc = tempfile.mkdtemp(prefix="fundlens-db-")
    assert main(["ingest", "--input", d, "--database", "fl_cli", "--location", loc]) == 0
    assert main(["features", "--database", "fl_cli", "--location", loc, "--window"]) == 0
    out = capsys.readouterr().out
    assert "skipped hno" in out and "== quality" in out and "funding_gap_pct" in out
    assert spark.table("fl_cli.features").count() == 4


def test_feature_pipeline_without_catalog_entries(spark):
    """A new session without a persistent metastore: raw tables are read from the folder."""
    d = tempfile.mkdtemp(prefix="fundlens-inputs-")
    with open(os.path.join(d, "fts_requirements_funding_globalcluster_global.csv"), "w") as fh:
        fh.write(REQ)
    loc = tempfile.mkdtemp(prefix="fundlens-db-")
    ingest(spark, d, "fl_gone", location=loc)
    # forget the catalog entry; the table is external, so its parquet files stay
    spark.sql("DROP TABLE fl_gone.raw_fts_requirements")
    res = feature_pipeline(spark, "fl_gone", location=loc)
    assert res.features.count() == 4 and "requirements" not in res.failures


def test_ingest_with_schema_profiles_numbers(spark):
    from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

    d = tempfile.mkdtemp(prefix="fundlens-inputs-")
    with open(os.path.join(d, "fts_requirements_funding_globalcluster_global.csv"), "w") as fh:
        fh.write(REQ)
    schema = StructType(
        [
            StructField("countryCode", StringType()),
            StructField("year", IntegerType()),
            StructField("requirements", DoubleType()),
        ]
    )
    rep = ingest(
        spark, d, "fl_typed", location=tempfile.mkdtemp(prefix="fundlens-db-"),
        schemas={"fts_requirements": schema},
    )
    stats = {r.column_name: (r.min, r.max) for r in rep.numeric.collect()}
    assert stats == {"year": (2023.0, 2024.0), "requirements": (0.0, 300.0)}


def test_ingest_without_any_input_reports_the_failures(spark):
    d, loc = tempfile.mkdtemp(prefix="fundlens-none-"), tempfile.mkdtemp(prefix="fundlens-db-")
    rep = ingest(spark, d, "fl_empty", location=loc)
    assert len(rep.failures) == 7 and rep.shape is None and rep.numeric is None
