"""Replacing a table: the old one survives every failure, and the stored rows are vouched for."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from fundlens.sinks import tables
from fundlens.sinks.tables import TableCheckFailed, ensure_database, save_table, verify_content
from fundlens.sinks.versions import content_digest, current_version, versions


@pytest.fixture
def db(spark, tmp_path):
    name = f"versions_{os.getpid()}_{abs(hash(str(tmp_path))) % 10**8}"
    ensure_database(spark, name, location=str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=repr)


def frame(spark, n, tag="a"):
    return spark.range(n).select("id", F.concat(F.lit(tag), "id").alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("x"))


def test_a_write_that_fails_midway_leaves_the_old_table(spark, db, tmp_path):
    name, path = f"{db}.t", str(tmp_path / "t")
    save_table(frame(spark, 20), name, path=path)
    before, held = rows(spark, name), versions(spark, path)
    # the last of several tasks fails, after others have written
    failing = frame(spark, 1000, "b").repartitionByRange(4, "id").withColumn(
        "v", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        save_table(failing, name, path=path)
    assert rows(spark, name) == before and versions(spark, path, marked=False) == held
    save_table(frame(spark, 5, "c"), name, path=path)
    assert rows(spark, name) == sorted(map(tuple, frame(spark, 5, "c").collect()), key=repr)


def test_a_failed_check_leaves_the_old_table(spark, db, tmp_path, monkeypatch):
    name, path = f"{db}.t", str(tmp_path / "t")
    save_table(frame(spark, 20), name, path=path)
    before = rows(spark, name)
    monkeypatch.setattr(tables, "content_digest", lambda df: content_digest(df.limit(3)))
    with pytest.raises(TableCheckFailed):
        save_table(frame(spark, 9), name, path=path, check="content")
    assert rows(spark, name) == before
    monkeypatch.undo()
    assert save_table(frame(spark, 9), name, path=path, check="content") == content_digest(frame(spark, 9))
    with pytest.raises(ValueError, match="unknown check"):
        save_table(frame(spark, 9), name, path=path, check="all")


@pytest.mark.parametrize("with_path", [True, False])
def test_schema_layout_and_self_reading(spark, db, tmp_path, with_path):
    name, path = f"{db}.t", str(tmp_path / "t") if with_path else None
    frame(spark, 4, "managed").write.saveAsTable(name)  # as an earlier release left it
    save_table(spark.table(name).unionByName(frame(spark, 2)), name, path=path)
    assert spark.table(name).count() == 6
    save_table(spark.table(name).withColumn("more", F.col("id") % 2), name, path=path)
    assert spark.table(name).columns == ["id", "v", "x", "more"]
    save_table(spark.table(name), name, path=path, partition_by=["more", "v"])
    assert spark.table(name).count() == 6 and set(spark.table(name).columns) == {"id", "v", "x", "more"}
    assert spark.table(name).filter("more = 1").count() == 3
    assert verify_content(spark, name).first().matches is True
    save_table(frame(spark, 3, "plain"), name, path=path)
    assert spark.table(name).columns == ["id", "v", "x"] and spark.table(name).count() == 3
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()} == {"t"}


def test_a_half_done_replacement_is_undone(spark, db, tmp_path, monkeypatch):
    name, path = f"{db}.t", str(tmp_path / "t")
    save_table(frame(spark, 4), name, path=path)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__previous")  # a driver lost between the two renames
    save_table(spark.createDataFrame([(1,)], "other int"), f"{db}.else", path=str(tmp_path / "else"))
    with pytest.raises(Exception, match="lost"):
        save_table(frame(spark, 4).withColumn("v", F.raise_error(F.lit("lost")).cast("string")), name, path=path)
    assert spark.table(name).count() == 4


def test_versions_are_kept_for_readers(spark, db, tmp_path):
    name, path = f"{db}.t", str(tmp_path / "t")
    save_table(frame(spark, 4), name, path=path)
    reading = spark.table(name)
    save_table(frame(spark, 7), name, path=path)
    assert reading.count() == 4  # began before the replacement
    for n in (8, 9):
        save_table(frame(spark, n), name, path=path)
    assert len(versions(spark, path)) == 2
    assert spark.read.parquet(current_version(spark, path)).count() == 9
    assert current_version(spark, str(tmp_path / "nowhere")) is None


def test_content_check_sees_changed_and_doubled_rows(spark, db, tmp_path):
    name, path = f"{db}.t", str(tmp_path / "t")
    save_table(frame(spark, 50).repartition(3), name, path=path)
    told = verify_content(spark, name).first()
    assert told.matches is True and told.row_count == told.written_rows == 50 and told.digest == told.written_digest
    folder = current_version(spark, path)
    changed = spark.table(name).withColumn("v", F.when(F.col("id") == 7, "other").otherwise(F.col("v")))
    doubled = spark.table(name).unionByName(spark.table(name).filter("id = 7"))
    swapped = spark.table(name).withColumn("id", F.when(F.col("id") == 7, 8).when(F.col("id") == 8, 7).otherwise(F.col("id")))
    for other, n in ((changed, 50), (doubled, 51), (swapped, 50)):
        assert content_digest(other) != content_digest(spark.table(name))
    kept = doubled.collect()
    spark.createDataFrame(kept, doubled.schema).coalesce(1).write.mode("append").parquet(folder)
    spark.catalog.refreshTable(name)
    told = verify_content(spark, name).first()
    assert told.matches is False and told.row_count == 101
    assert glob.glob(f"{folder}/_VERIFIED")
    frame(spark, 3).write.saveAsTable(f"{db}.foreign")
    assert verify_content(spark, f"{db}.foreign").first().matches is None


def test_digest_of_nulls_nested_values_and_no_rows(spark):
    ddl = "a string, b string, c array<int>, d struct<e:int,f:map<string,int>>"
    base = [("x", None, [1, None], (1, {"k": None})), (None, "x", None, None)]
    one = content_digest(spark.createDataFrame(base, ddl))
    assert one == content_digest(spark.createDataFrame(base[::-1], ddl).select("d", "c", "b", "a"))
    for other in (
        [("x", None, [1, None], (1, {"k": None})), ("x", None, None, None)],
        [("x", None, [1], (1, {"k": None})), (None, "x", None, None)],
        [("x", None, [1, None], (1, {})), (None, "x", None, None)],
        [("x", None, [1, None], (None, {"k": None})), (None, "x", None, None)],
    ):
        assert content_digest(spark.createDataFrame(other, ddl)) != one
    empty = content_digest(spark.createDataFrame([], ddl))
    assert (empty.rows, empty.total, empty.mix) == (0, 0, 0) and type(empty).parse(str(one)) == one


def test_an_empty_table_is_saved(spark, db, tmp_path):
    assert save_table(frame(spark, 5).limit(0), f"{db}.e", path=str(tmp_path / "e")).rows == 0
    assert spark.table(f"{db}.e").count() == 0
