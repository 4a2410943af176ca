import os
import tempfile

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from pyspark.sql import functions as F

from fundlens.sinks.tables import (
    ensure_database,
    list_tables,
    persisted,
    save_raw_tables,
    save_table,
    verify_table,
)
from fundlens.sources.catalog import load_tables
from fundlens.sources.csv import drop_tag_row, infer_text_types, load_datasets, read_csv_dataset

# A hand-made look-alike of a flows file: header, tag row, quoted fields with
# commas, doubled quotes, tabs and line breaks, CRLF line ends.
CSV_TEXT = (
    'date,description,amountUSD,destGlobalClusters,id\r\n'
    '#date,#description+notes,#value+funding+total+usd,#sector+cluster+name+list,#activity+id\r\n'
    '2019-03-11,"Response, ""urgent""\r\nsecond line\tand tab",1500,"Food Security,Nutrition,Water",1\r\n'
    '2019-04-12,plain,72000,Food Security,2\r\n'
    '2019-05-13,,310,,3\r\n'
)


def _write(tmpdir, name="flows.csv", text=CSV_TEXT):
    path = os.path.join(tmpdir, name)
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


def test_read_csv_drops_tag_row_and_keeps_multiline(spark):
    d = tempfile.mkdtemp(prefix="fundlens-csv-")
    path = _write(d)
    raw = read_csv_dataset(spark, path)
    rows = raw.orderBy("id").collect()
    assert len(rows) == 3  # 1 tag + 3 records read; tag dropped
    # Spark's CSV parser returns a line break inside quotes as "\n" (CRLF normalized)
    assert rows[0].description == 'Response, "urgent"\nsecond line\tand tab'
    assert rows[0].destGlobalClusters == "Food Security,Nutrition,Water"
    assert rows[2].description is None
    assert dict(raw.dtypes)["amountUSD"] == "string"


def test_read_csv_with_schema_try_casts(spark):
    d = tempfile.mkdtemp(prefix="fundlens-csv-")
    path = _write(d)
    schema = StructType(
        [
            StructField("id", LongType()),
            StructField("amountUSD", DoubleType()),
            StructField("description", StringType()),
            StructField("missing", StringType()),
        ]
    )
    out = read_csv_dataset(spark, path, schema=schema).orderBy("id").collect()
    assert [(r.id, r.amountUSD, r.missing) for r in out] == [
        (1, 1500.0, None),
        (2, 72000.0, None),
        (3, 310.0, None),
    ]


def test_only_a_record_whose_fields_are_all_tags_is_dropped(spark):
    rows = [("#x", "#y", 1), (None, "#y", 2), ("#1 region", "a", 3), (None, None, 4), ("a", "#y", 5), ("", "#y", 6)]
    df = spark.createDataFrame(rows, "c string, d string, n int")
    kept = drop_tag_row(df.select("c", "d"))
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.filter("n IN (3, 4, 5)").select("c", "d").collect())


def test_types_are_inferred_after_the_tags(spark):
    d = tempfile.mkdtemp(prefix="fundlens-csv-")
    out = read_csv_dataset(spark, _write(d), infer_schema=True)
    assert dict(out.dtypes) == {"date": "date", "description": "string", "amountUSD": "int", "destGlobalClusters": "string", "id": "int"}
    codes = spark.createDataFrame([("007", "1.5", "x"), ("010", None, "1")], "code string, amount string, mixed string")
    assert dict(infer_text_types(codes).dtypes) == {"code": "string", "amount": "double", "mixed": "string"}


def test_load_datasets_reports_missing(spark):
    d = tempfile.mkdtemp(prefix="fundlens-csv-")
    _write(d)
    res = load_datasets(spark, {"flows": "flows.csv", "absent": "nope.csv"}, base_dir=d)
    assert set(res.frames) == {"flows"} and set(res.failures) == {"absent"}
    assert res.failures_frame(spark).count() == 1


def test_tables_roundtrip(spark):
    loc = tempfile.mkdtemp(prefix="fundlens-wh-")
    ensure_database(spark, "fl_test", location=loc)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with persisted(df) as cached:
        save_table(cached, "fl_test.t1", path=f"{loc}/t1")
    status = save_raw_tables({"x": df, "bad": df.selectExpr("k AS `a b`", "k AS `a b`")}, "fl_test", location=loc)
    assert status["x"] is None and status["bad"] is not None
    rep = verify_table(spark, "fl_test.t1").first()
    assert (rep.table_name, rep.row_count, rep.column_count) == ("fl_test.t1", 2, 2)
    assert rep.schema == "struct<k:int,v:string>"
    names = {r.tableName for r in list_tables(spark, "fl_test").collect()}
    assert {"t1", "raw_x"} <= names
    res = load_tables(spark, {"t": "fl_test.t1", "nope": "fl_test.nope"})
    assert set(res.frames) == {"t"} and "nope" in res.failures
    # overwrite replaces data and schema
    save_table(df.selectExpr("k", "v", "k * 2 AS k2"), "fl_test.t1", path=f"{loc}/t1")
    assert spark.table("fl_test.t1").columns == ["k", "v", "k2"]


def test_single_line_mode_reads_plain_files(spark):
    d = tempfile.mkdtemp(prefix="fundlens-csv-")
    path = _write(d, "plain.csv", "a,b\n#x,#y\n1,2\n3,4\n")
    out = read_csv_dataset(spark, path, multi_line=False).collect()
    assert [(r.a, r.b) for r in out] == [("1", "2"), ("3", "4")]


def test_all_datasets_are_typed_in_one_wave(spark, monkeypatch):
    from fundlens.sources import csv as source

    d = tempfile.mkdtemp(prefix="fundlens-csv-")
    columns = {
        "a": 'x,y,z\n1,2020-01-05,true\n,2020-1-6,false\n',
        "b": 'x,y,z\n1,2020-01-05 10:00:00,07\n3000000000,2021-01-01,8\n',
        "c": 'x,y,z\n1.5,a,\n-2,1,\n',
        "d": 'x,y,z\n" 4 ",1e3,0\n5,.5,1\n',
    }
    for n, text in columns.items():
        _write(d, f"{n}.csv", text)
    waves, plain = [], source.run_concurrently
    monkeypatch.setattr(source, "run_concurrently", lambda s, tasks, **kw: waves.append(sorted(tasks)) or plain(s, tasks, **kw))
    res = load_datasets(spark, {n: f"{n}.csv" for n in (*columns, "absent")}, base_dir=d, infer_schema=True)
    assert waves == [sorted(columns)] and set(res.failures) == {"absent"}
    kinds = {n: [k for _, k in df.dtypes] for n, df in res.frames.items()}
    assert kinds == {
        "a": ["int", "date", "boolean"],
        "b": ["bigint", "timestamp", "string"],
        "c": ["double", "string", "string"],
        "d": ["int", "double", "int"],
    }
    assert [r.x for r in res.frames["d"].collect()] == [4, 5]


def test_a_dataset_that_cannot_be_typed_is_reported(spark):
    from fundlens.sources.csv import text_types

    bad = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("x"))
    kinds, failed = text_types({"bad": bad, "good": spark.createDataFrame([("1",)], "x string"), "none": spark.range(2)})
    assert kinds == {"good": {"x": "int"}, "none": {}} and set(failed) == {"bad"}
    assert text_types({}) == ({}, {})
