"""Compare a registered Spark query with its DuckDB oracle, strictly.

Used by the tests and runnable by hand:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]

Columns are matched by name; rows are compared as multisets of exact values
(floats bit for bit, NaN equal to NaN, null equal to null).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


# Spark simple type name -> DuckDB type name, for the schema comparison.
TYPE_MAP = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def spark_types(df) -> dict:
    return {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}


def duck_types(con, sql: str) -> dict:
    rel = con.sql(sql)
    return {n: str(t) for n, t in zip(rel.columns, rel.types)}


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return cols, rows


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return cols, rows


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols, s_rows = spark_rows(df)
    t1 = time.time()
    d_cols, d_rows = duck_rows(con, sql)
    s_types, d_types = spark_types(df), duck_types(con, sql)
    res = {
        "name": name,
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "cols_match": s_cols == d_cols,
        "types_match": s_types == d_types,
        "spark_sec": round(t1 - t0, 2),
    }
    if s_types != d_types:
        res["type_diffs"] = {
            k: (s_types.get(k), d_types.get(k)) for k in s_types if s_types.get(k) != d_types.get(k)
        }
    if s_cols != d_cols:
        res["cols_spark"] = s_cols
        res["cols_oracle"] = d_cols
        res["match"] = False
        return res
    cs, cd = Counter(s_rows), Counter(d_rows)
    res["match"] = cs == cd and res["types_match"]
    if not res["match"]:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        res["only_spark"] = only_s
        res["only_oracle"] = only_d
        # per column mismatch count on key-aligned rows (first diff column names)
        diff_cols = set()
        for a, b in zip(sorted(only_s, key=repr), sorted(only_d, key=repr)):
            for c, x, y in zip(s_cols, a, b):
                if x != y:
                    diff_cols.add(c)
        res["diff_cols"] = sorted(diff_cols)
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry
    from fundlens.session import local_session

    if os.environ.get("PLAIN_SESSION"):
        # as a driver would build it: no tuning beyond the shuffle width
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
            .getOrCreate()
        )
    else:
        spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print({"name": name, "rows_spark": df.count(), "oracle": None}, flush=True)
            continue
        r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        bad += not r["match"]
        print(r, flush=True)
    print("MISMATCHES", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
