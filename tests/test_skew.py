"""Hot keys: one sector / country / destination holding most of the rows."""

from pyspark.sql import functions as F

from fundlens.operators.aggregate import flows_by_destination
from fundlens.operators.features import add_sector_features
from fundlens.operators.join import NEEDS_JOIN_KEYS, skew_join
from fundlens.plans.features import build_features

BASE = (
    "country_code string, cluster_code string, cluster_name string, year int, appeal_id bigint, "
    "appeal_name string, appeal_code string, startDate date, endDate date, "
    "total_requirements_usd double, total_funding_usd double, funding_percent double"
)


def _skewed_base(spark, n=20000):
    ids = spark.range(n)
    hot = F.col("id") % 10 < 8  # 80 % of rows in one sector
    return ids.select(
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 7).cast("string"))).alias("country_code"),
        F.when(hot, F.lit("K")).otherwise(F.lit(None).cast("string")).alias("cluster_code"),
        F.lit(None).cast("string").alias("cluster_name"),
        F.lit(2024).alias("year"),
        F.col("id").alias("appeal_id"),
        F.lit(None).cast("string").alias("appeal_name"),
        F.lit(None).cast("string").alias("appeal_code"),
        F.lit(None).cast("date").alias("startDate"),
        F.lit(None).cast("date").alias("endDate"),
        ((F.col("id") % 1000) * 1.25).alias("total_requirements_usd"),
        ((F.col("id") % 300) * 0.5).alias("total_funding_usd"),
        F.lit(None).cast("double").alias("funding_percent"),
    )


def _needs(spark):
    return spark.createDataFrame(
        [("HOT", "K", None, 10.0, 5.0, None, None), ("C1", None, None, 1.0, 1.0, None, None)],
        "country_code string, cluster_code string, population double, inneed double, "
        "targeted double, affected double, reached double",
    )


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hot_sector_strategies_agree(spark):
    base = _skewed_base(spark).repartition(6)
    a = build_features(base, _needs(spark), None, exact_scale=2)
    w = build_features(base, _needs(spark), None, exact_scale=2, sector_strategy="window", broadcast_max_rows=None)
    assert _rows(a) == _rows(w)
    hot = a.filter("country_code = 'HOT'").select("sector_project_count").distinct().collect()
    assert [r[0] for r in hot] == [16000]


def test_hot_key_shuffle_join_fallback_with_aqe_skew_split(spark):
    """Broadcast disabled: the base is shuffled; AQE may split the hot partition; same rows."""
    base = _skewed_base(spark).repartition(6)
    expected = _rows(build_features(base, _needs(spark), None, exact_scale=2))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = _rows(build_features(base, _needs(spark), None, exact_scale=2, broadcast_max_rows=0))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected


def test_hot_destination_flows(spark):
    n = 30000
    flows = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot, other")).otherwise(F.lit("cold")).alias("dest"),
        F.lit(2.5).alias("amount"),
    )
    got = {r.destination: (r.amount_usd, r.flow_count) for r in flows_by_destination(flows, "dest", "amount", exact_scale=2).collect()}
    assert got == {"hot": (50000.0, 20000), "other": (50000.0, 20000), "cold": (25000.0, 10000)}


def _largest_share(df):
    """The largest task's rows over the mean of all shuffle partitions."""
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) * 16 / sum(sizes)


def _with_conf(spark, conf, run):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}


def test_salted_windows_agree_and_spread_a_hot_group(spark):
    base = _skewed_base(spark)
    for scale in (2, None):
        a = build_features(base, _needs(spark), None, exact_scale=scale)
        w = build_features(base, _needs(spark), None, exact_scale=scale, sector_strategy="salted_window", broadcast_max_rows=None)
        if scale is None:  # plain double sums: equal up to their last bits
            a, w = (x.select(*[F.col(c).cast("float") if t == "double" else F.col(c) for c, t in x.dtypes]) for x in (a, w))
        assert _rows(a) == _rows(w)

    def share():
        one = base.withColumn("country_code", F.lit("HOT")).withColumn("cluster_code", F.lit(None).cast("string"))
        gap = one.withColumn("funding_gap_usd", F.col("total_requirements_usd") - F.col("total_funding_usd"))
        salted = add_sector_features(gap, "salted_window", 2, salts=128)
        assert salted.select("sector_project_count").distinct().collect() == [(20000,)]
        # base exchange, group window of the parts; windows and join add no exchange of the base
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(__key") <= 3 and "SortMergeJoin" in plan
        return _largest_share(salted)

    assert _with_conf(spark, SHUFFLED, share) < 2.5


def test_hot_and_null_keys_above_the_broadcast_bound(spark):
    """A third of the rows on one key, a third without a key, and no side may be broadcast but the list of hot keys."""
    base = _skewed_base(spark).withColumn(
        "country_code",
        F.when(F.col("appeal_id") % 3 == 0, "HOT").when(F.col("appeal_id") % 3 == 1, None).otherwise(F.concat(F.lit("C"), F.col("appeal_id") % 97)),
    ).withColumn("cluster_code", F.lit("K"))
    needs = spark.range(97).select(
        F.concat(F.lit("C"), "id").alias("country_code"), F.lit("K").alias("cluster_code"), F.col("id").cast("double").alias("targeted"),
        *[F.lit(1.0).alias(m) for m in ("inneed", "affected", "reached")],
    )
    needs = needs.unionByName(needs.limit(1).withColumn("country_code", F.lit("HOT")))
    plain = base.join(needs, ["country_code", "cluster_code"], "left")

    def run():
        found = skew_join(base, needs, NEEDS_JOIN_KEYS)
        assert found.columns == plain.columns
        assert _rows(found) == _rows(plain.select(*found.columns))
        return _largest_share(found), _largest_share(plain)

    skewed, unsalted = _with_conf(spark, SHUFFLED, run)
    assert unsalted > 4 and skewed < 2.5
    built = _with_conf(spark, SHUFFLED, lambda: _rows(build_features(base, needs, None, exact_scale=2, broadcast_max_rows=0)))
    assert built == _rows(build_features(base, needs, None, exact_scale=2))


def test_skew_join_of_few_and_no_rows(spark):
    base, needs = _skewed_base(spark, 3), _needs(spark)
    expect = _rows(base.join(needs, list(NEEDS_JOIN_KEYS), "left"))
    assert _rows(skew_join(base, needs, NEEDS_JOIN_KEYS)) == expect
    assert skew_join(base.limit(0), needs, NEEDS_JOIN_KEYS).count() == 0
    assert skew_join(base, needs.limit(0), NEEDS_JOIN_KEYS).count() == 3
