"""Stand-ins: the library's input shapes derived from the driver tables.

The real inputs (funding requirements, needs overview, population, response
plans, funding flows) are CSV files that are not shipped.  These functions
derive DataFrames with the same column names and kinds from the TPC-H-like
tables, over whole tables, so every query's work grows with the data.  Nulls
are injected by key arithmetic on the row's own key (never by dropping rows);
coverage gaps (a needs or population input that lacks some countries) come
from other codes for one region's nations, so no row is dropped.  ``fundlens.plans.oracle`` holds the same
definitions as SQL for the independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.columns import sum_measure

# Fixed values of the stand-ins (shared with the SQL versions).
NULL_COUNTRY_MOD = 23  # requirements/plans: country null when key % 23 = 0
NULL_CLUSTER_MOD = 17  # requirements: cluster null when key % 17 = 0
NULL_YEAR_MOD = 19  # requirements/plans: year null when key % 19 = 0
NULL_REQUIREMENTS_MOD = 11  # requirements null when key % 11 = 0
ZERO_REQUIREMENTS_MOD = 13  # requirements 0 when key % 13 = 0
TARGETED_MOD, AFFECTED_MOD, REACHED_MOD = 3, 4, 7  # needs measures present when custkey % m = 0
NO_FLOW_DESTINATION_MOD = 10  # flows: destination null when doc_id % 10 = 0
NEEDS_MISSING_REGION = 0  # needs name this region's nations by other codes
POPULATION_MISSING_REGION = 1  # so does population for this one
FUNDED_RETURN_FLAG = "R"  # funding = extended price of the lines with this flag


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(missing_region: int):
    """The nation's code; an input that lacks a region uses other codes for it, so its rows stay."""
    return F.when(F.col("n_regionkey") == missing_region, F.concat(F.lit("X-"), F.col("n_name"))).otherwise(F.col("n_name"))


def _null_when(key, mod: int, value):
    return F.when(key % mod != 0, value)


def _orders_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )


def requirements_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One appeal per order: country = nation, cluster = market segment.

    funding = exact sum of the order's returned-line prices (null without
    such lines); endDate = last ship date of the order's lines.
    """
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        sum_measure(
            F.when(F.col("l_returnflag") == FUNDED_RETURN_FLAG, F.col("l_extendedprice")), 2
        ).alias("funding"),
        F.max("l_shipdate").alias("last_ship"),
    )
    o = _orders_with_place(spark, sf_dir).join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    k = F.col("o_orderkey")
    requirements = (
        F.when(k % NULL_REQUIREMENTS_MOD == 0, F.lit(None).cast("double"))
        .when(k % ZERO_REQUIREMENTS_MOD == 0, F.lit(0.0))
        .otherwise(F.col("o_totalprice"))
    )
    year_text = F.year("o_orderdate").cast("int").cast("string")
    out = o.select(
        _null_when(k, NULL_COUNTRY_MOD, F.col("n_name")).alias("countryCode"),
        _null_when(k, NULL_CLUSTER_MOD, F.col("c_mktsegment")).alias("clusterCode"),
        _null_when(k, NULL_CLUSTER_MOD, F.lower("c_mktsegment")).alias("cluster"),
        _null_when(k, NULL_YEAR_MOD, year_text).alias("year"),
        k.alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.col("o_orderstatus"), F.lit("-"), k.cast("string")).alias("code"),
        F.col("o_orderdate").alias("startDate"),
        F.col("last_ship").alias("endDate"),
        requirements.alias("requirements"),
        F.col("funding"),
    )
    r, f = F.col("requirements"), F.col("funding")
    return out.withColumn("percentFunded", F.when(r != 0, f / r * 100))


def needs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One needs row per customer; names in mixed variants."""
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    return c.select(
        _code(NEEDS_MISSING_REGION).alias("country_iso3"),
        F.col("c_mktsegment").alias("Cluster"),
        (bal * 3).alias("population"),
        bal.alias("In Need"),
        F.when(key % TARGETED_MOD == 0, bal).alias("targeted"),
        F.when(key % AFFECTED_MOD == 0, bal).alias("affected"),
        F.when(key % REACHED_MOD == 0, bal).alias("reached"),
    )


def population_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One admin row per line item."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    j = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    return j.select(
        _code(POPULATION_MISSING_REGION).alias("ISO3"),
        F.lower("n_name").alias("Country"),
        F.year("l_shipdate").cast("int").alias("Reference_year"),
        F.col("l_quantity").alias("Population"),
    )


def plans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response plan per order; ``years`` stays text."""
    o = _orders_with_place(spark, sf_dir)
    k = F.col("o_orderkey")
    return o.select(
        _null_when(k, NULL_COUNTRY_MOD, F.col("n_name")).alias("locations"),
        _null_when(k, NULL_YEAR_MOD, F.year("o_orderdate").cast("int").cast("string")).alias("years"),
        k.alias("code"),
        F.col("o_totalprice").alias("origRequirements"),
        (F.col("o_totalprice") * 1.25).alias("revisedRequirements"),
        F.col("o_orderdate").alias("startDate"),
        F.col("o_orderdate").alias("endDate"),
        F.col("o_orderpriority").alias("categories"),
        F.col("o_custkey").alias("internalId"),
    )


def flows_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One funding flow per document; the destination list is comma-joined text."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return d.select(
        k.alias("id"),
        F.col("text").alias("description"),
        F.col("n_chars").cast("double").alias("amountUSD"),
        F.col("source").alias("srcOrganization"),
        _null_when(
            k, NO_FLOW_DESTINATION_MOD, F.concat(F.col("source"), F.lit(", "), F.upper("lang"))
        ).alias("destGlobalClusters"),
        F.upper("lang").alias("destLocations"),
    )


RAW_BUILDERS = {
    "requirements": requirements_raw,
    "needs": needs_raw,
    "population": population_raw,
    "plans": plans_raw,
    "flows": flows_raw,
}


def raw_datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five raw stand-ins by dataset name (lazy; nothing is read yet)."""
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
