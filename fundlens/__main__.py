"""Command line for the two workflows, for ``spark-submit`` or ``python -m fundlens``.

    python -m fundlens ingest   --input /data/inputs --database aid --location /shared/aid
    python -m fundlens features --database aid --location /shared/aid [--window]

The session is taken from the environment (``getOrCreate``); cluster
settings such as ``spark.checkpoint.dir`` come from ``spark-submit``.
Reports are small DataFrames and are shown; tables are written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fundlens.plans.workflows import feature_pipeline, ingest


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fundlens")
    sub = parser.add_subparsers(dest="command", required=True)
    p_in = sub.add_parser("ingest", help="CSV inputs -> raw tables + profile reports")
    p_in.add_argument("--input", required=True)
    p_in.add_argument("--database", required=True)
    p_in.add_argument("--location")
    p_ft = sub.add_parser("features", help="raw tables -> feature table + quality reports")
    p_ft.add_argument("--database", required=True)
    p_ft.add_argument("--location")
    p_ft.add_argument("--table", default="features")
    p_ft.add_argument("--window", action="store_true", help="sector totals by window")
    p_ft.add_argument("--exact-scale", type=int, default=None)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"fundlens-{args.command}").getOrCreate()
    if args.command == "ingest":
        rep = ingest(spark, args.input, args.database, location=args.location)
        for name, err in sorted(rep.failures.items()):
            print(f"skipped {name}: {err}")
        for title, df in [
            ("shape", rep.shape),
            ("nulls", rep.nulls.filter("null_count > 0") if rep.nulls is not None else None),
            ("top cardinality", rep.top_cardinality),
            ("numeric", rep.numeric),
            ("join key candidates", rep.join_key_candidates),
            ("key columns", rep.key_profile),
            ("key samples", rep.key_samples),
            ("tables", rep.tables),
            *((f"first rows of {n}", df) for n, df in rep.previews.items()),
        ]:
            if df is not None:
                print(f"== {title}")
                df.show(200, truncate=False)
    else:
        res = feature_pipeline(
            spark,
            args.database,
            output_table=args.table,
            location=args.location,
            sector_strategy="window" if args.window else "aggregate",
            exact_scale=args.exact_scale,
        )
        for name, err in sorted(res.failures.items()):
            print(f"missing {name}: {err}")
        for title, df in [
            ("stage audit", res.audit),
            ("quality", res.quality),
            ("feature statistics", res.feature_stats),
            ("first rows", res.preview),
        ]:
            print(f"== {title}")
            df.show(200, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
