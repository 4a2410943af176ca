"""Type inference over written CSV: bounded files, one short expression for all columns."""

import glob

from fundlens.sources import csv


def test_files_are_bounded_and_types_are_found(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "FILE_RECORDS", 10, raising=False)
    rows = [(i, 3_000_000_000 + i, i / 4, f"2024-0{1 + i % 9}-1", f"name {i}\nline", f"00{i}", None, "NaN" if i == 7 else "1") for i in range(95)]
    names = "a long, b long, c double, d string, e string, f string, g string, h string"
    path = str(tmp_path / "t")
    csv.write_csv(spark.createDataFrame(rows, names).coalesce(1), path)
    assert len(glob.glob(f"{path}/part-*")) == 10
    frame = csv.load_datasets(spark, {"t": path}, infer_schema=True).frames["t"]
    assert [f.dataType.simpleString() for f in frame.schema] == ["int", "bigint", "double", "date", "string", "string", "string", "string"]
    got = sorted(tuple(r) for r in frame.select("a", "b", "c", "e", "f").collect())
    assert got == [(r[0], r[1], r[2], r[4], r[5]) for r in rows]


def test_one_expression_serves_every_column(spark):
    df = spark.createDataFrame([("1", "x", None)], "a string, b string, c string")
    found = {r["at"]: r["bits"] for r in csv._fitting_types(df, df.columns).collect()}
    assert found[0] & 0b111 == 0b111 and found[1] == 0 and 2 not in found
