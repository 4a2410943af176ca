"""Reference SQL for the correctness oracle (DuckDB dialect, also valid Spark SQL
where noted).

Written independently of the DataFrame code: nothing is imported from the
library, each query restates the operator's semantics and its column lists in
plain SQL over the driver tables (pre-registered views ``orders``,
``lineitem``, ...).
"""

from __future__ import annotations


EXACT = 2  # scale of the exact money sums used by every registered query


def money_sql(expr: str, over: str = "") -> str:
    """SQL of an exact money sum: rounded to cents, summed as integers."""
    cents = f"CAST(round(CAST({expr} AS DOUBLE) * 100) AS BIGINT)"
    return f"CAST(sum({cents}) {over} AS DOUBLE) / CAST(100 AS DOUBLE)"


_s = money_sql


# The five raw stand-ins and their standardized forms as CTEs.
STANDIN_CTES = f"""
lines_by_order AS (
  SELECT l_orderkey,
         {_s("CASE WHEN l_returnflag = 'R' THEN l_extendedprice END")} AS funding,
         max(l_shipdate) AS last_ship
  FROM lineitem
  GROUP BY l_orderkey
),
orders_placed AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
         o.o_orderpriority, c.c_name, c.c_mktsegment, n.n_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
requirements_pre AS (
  SELECT CASE WHEN o_orderkey % 23 <> 0 THEN n_name END AS countryCode,
         CASE WHEN o_orderkey % 17 <> 0 THEN c_mktsegment END AS clusterCode,
         CASE WHEN o_orderkey % 17 <> 0 THEN lower(c_mktsegment) END AS cluster,
         CASE WHEN o_orderkey % 19 <> 0
              THEN CAST(CAST(year(o_orderdate) AS INT) AS STRING) END AS year,
         o_orderkey AS id,
         c_name AS name,
         concat(o_orderstatus, '-', CAST(o_orderkey AS STRING)) AS code,
         o_orderdate AS startDate,
         last_ship AS endDate,
         CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE)
              WHEN o_orderkey % 13 = 0 THEN CAST(0 AS DOUBLE)
              ELSE o_totalprice END AS requirements,
         funding
  FROM orders_placed LEFT JOIN lines_by_order ON o_orderkey = l_orderkey
),
requirements_raw AS (
  SELECT *, CASE WHEN requirements <> 0 THEN funding / requirements * 100 END AS percentFunded
  FROM requirements_pre
),
needs_raw AS (
  SELECT CASE WHEN n_regionkey = 0 THEN concat('X-', n_name) ELSE n_name END AS country_iso3,
         c_mktsegment AS Cluster,
         c_acctbal * 3 AS population,
         c_acctbal AS "In Need",
         CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS targeted,
         CASE WHEN c_custkey % 4 = 0 THEN c_acctbal END AS affected,
         CASE WHEN c_custkey % 7 = 0 THEN c_acctbal END AS reached
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
population_raw AS (
  SELECT CASE WHEN n_regionkey = 1 THEN concat('X-', n_name) ELSE n_name END AS ISO3,
         lower(n_name) AS Country,
         CAST(year(l_shipdate) AS INT) AS Reference_year,
         l_quantity AS Population
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
plans_raw AS (
  SELECT CASE WHEN o_orderkey % 23 <> 0 THEN n_name END AS locations,
         CASE WHEN o_orderkey % 19 <> 0
              THEN CAST(CAST(year(o_orderdate) AS INT) AS STRING) END AS years,
         o_orderkey AS code,
         o_totalprice AS origRequirements,
         o_totalprice * CAST(1.25 AS DOUBLE) AS revisedRequirements,
         o_orderdate AS startDate,
         o_orderdate AS endDate,
         o_orderpriority AS categories,
         o_custkey AS internalId
  FROM orders_placed
),
flows_raw AS (
  SELECT doc_id AS id,
         text AS description,
         CAST(n_chars AS DOUBLE) AS amountUSD,
         source AS srcOrganization,
         CASE WHEN doc_id % 10 <> 0 THEN concat(source, ', ', upper(lang)) END
           AS destGlobalClusters,
         upper(lang) AS destLocations
  FROM documents
),
requirements_std AS (
  SELECT countryCode AS country_code,
         clusterCode AS cluster_code,
         cluster AS cluster_name,
         TRY_CAST(year AS INTEGER) AS year,
         id AS appeal_id,
         name AS appeal_name,
         code AS appeal_code,
         startDate,
         endDate,
         TRY_CAST(requirements AS DOUBLE) AS total_requirements_usd,
         TRY_CAST(funding AS DOUBLE) AS total_funding_usd,
         TRY_CAST(percentFunded AS DOUBLE) AS funding_percent
  FROM requirements_raw
  WHERE countryCode IS NOT NULL AND TRY_CAST(year AS INTEGER) IS NOT NULL
),
needs_std AS (
  SELECT country_iso3 AS country_code,
         Cluster AS cluster_code,
         population,
         "In Need" AS inneed,
         targeted,
         affected,
         reached
  FROM needs_raw
  WHERE country_iso3 IS NOT NULL
),
population_std AS (
  SELECT ISO3 AS country_code,
         Country AS country,
         TRY_CAST(Reference_year AS INTEGER) AS year,
         TRY_CAST(Population AS DOUBLE) AS population
  FROM population_raw
  WHERE ISO3 IS NOT NULL AND TRY_CAST(Reference_year AS INTEGER) IS NOT NULL
),
plans_std AS (
  SELECT locations AS country_code,
         years AS year,
         code AS plan_id,
         TRY_CAST(origRequirements AS DOUBLE) AS total_requirements_usd,
         TRY_CAST(revisedRequirements AS DOUBLE) AS revised_requirements_usd,
         startDate,
         endDate,
         categories AS plan_type,
         internalId AS internal_id
  FROM plans_raw
  WHERE locations IS NOT NULL AND years IS NOT NULL
),
needs_agg AS (
  SELECT country_code, cluster_code,
         {_s("targeted")} AS targeted,
         {_s("inneed")} AS inneed,
         {_s("affected")} AS affected,
         {_s("reached")} AS reached
  FROM needs_std
  GROUP BY country_code, cluster_code
),
population_agg AS (
  SELECT country_code, year, {_s("population")} AS population
  FROM population_std
  GROUP BY country_code, year
),
after_needs AS (
  SELECT r.*, n.targeted, n.inneed, n.affected, n.reached
  FROM requirements_std r
  LEFT JOIN needs_agg n ON r.country_code = n.country_code AND r.cluster_code = n.cluster_code
),
after_population AS (
  SELECT a.*, p.population
  FROM after_needs a
  LEFT JOIN population_agg p ON a.country_code = p.country_code AND a.year = p.year
),
filled AS (
  SELECT country_code, year, cluster_code, cluster_name, appeal_id, appeal_name, appeal_code,
         startDate, endDate, total_requirements_usd,
         coalesce(total_funding_usd, CAST(0 AS DOUBLE)) AS total_funding_usd,
         coalesce(funding_percent, CAST(0 AS DOUBLE)) AS funding_percent,
         coalesce(targeted, CAST(0 AS DOUBLE)) AS targeted,
         coalesce(inneed, CAST(0 AS DOUBLE)) AS inneed,
         coalesce(affected, CAST(0 AS DOUBLE)) AS affected,
         coalesce(reached, CAST(0 AS DOUBLE)) AS reached,
         coalesce(population, CAST(0 AS DOUBLE)) AS population
  FROM after_population
),
project_features AS (
  SELECT *,
         targeted / (total_funding_usd + CAST(1e-9 AS DOUBLE)) AS beneficiary_to_funding_ratio,
         inneed / (total_requirements_usd + CAST(1e-9 AS DOUBLE)) AS need_to_requirements_ratio,
         targeted / (inneed + CAST(1e-9 AS DOUBLE)) AS targeting_coverage_rate,
         total_requirements_usd - total_funding_usd AS funding_gap_usd,
         CASE WHEN total_requirements_usd > 0
              THEN (total_requirements_usd - total_funding_usd) / total_requirements_usd * 100
         END AS funding_gap_pct,
         total_funding_usd / (total_requirements_usd + CAST(1e-9 AS DOUBLE)) AS funding_coverage_rate,
         CASE WHEN targeted > 0 THEN total_funding_usd / targeted END AS cost_per_beneficiary
  FROM filled
),
population_features AS (
  SELECT *,
         total_funding_usd / (population + CAST(1e-9 AS DOUBLE)) AS cost_per_capita,
         total_requirements_usd / (population + CAST(1e-9 AS DOUBLE)) AS requirement_per_capita,
         total_funding_usd / (population + CAST(1e-9 AS DOUBLE)) * 100 AS funding_coverage_pct,
         total_requirements_usd / (population + CAST(1e-9 AS DOUBLE)) * 100 AS requirement_coverage_pct
  FROM project_features
),
sector_totals AS (
  SELECT *,
         {_s("total_requirements_usd", "OVER (PARTITION BY country_code, year, cluster_code)")}
           AS sector_total_requirements_usd,
         {_s("total_funding_usd", "OVER (PARTITION BY country_code, year, cluster_code)")}
           AS sector_total_funding_usd,
         {_s("funding_gap_usd", "OVER (PARTITION BY country_code, year, cluster_code)")}
           AS sector_total_gap_usd,
         count(appeal_id) OVER (PARTITION BY country_code, year, cluster_code)
           AS sector_project_count
  FROM population_features
),
features AS (
  SELECT *,
         total_funding_usd / (sector_total_funding_usd + CAST(1e-9 AS DOUBLE)) * 100
           AS project_funding_share_of_sector_pct,
         total_requirements_usd / (sector_total_requirements_usd + CAST(1e-9 AS DOUBLE)) * 100
           AS project_requirement_share_of_sector_pct,
         sector_total_funding_usd / (sector_total_requirements_usd + CAST(1e-9 AS DOUBLE)) * 100
           AS sector_funding_efficiency_pct,
         funding_percent
           - sector_total_funding_usd / (sector_total_requirements_usd + CAST(1e-9 AS DOUBLE)) * 100
           AS project_funding_status_vs_sector_avg
  FROM sector_totals
)
"""


def with_standins(select: str) -> str:
    """A full statement: the stand-in CTEs followed by ``select``."""
    return "WITH " + STANDIN_CTES.strip() + "\n" + select.strip()


# Column lists as the reports must show them (fixed values, in order).
KEYS = "appeal_id country_code year cluster_code".split()
FEATURES = """
country_code year cluster_code cluster_name appeal_id appeal_name appeal_code startDate endDate
total_requirements_usd total_funding_usd funding_percent targeted inneed affected reached population
beneficiary_to_funding_ratio need_to_requirements_ratio targeting_coverage_rate funding_gap_usd
funding_gap_pct funding_coverage_rate cost_per_beneficiary cost_per_capita requirement_per_capita
funding_coverage_pct requirement_coverage_pct sector_total_requirements_usd sector_total_funding_usd
sector_total_gap_usd sector_project_count project_funding_share_of_sector_pct
project_requirement_share_of_sector_pct sector_funding_efficiency_pct project_funding_status_vs_sector_avg
""".split()
BASE = """
country_code year cluster_code cluster_name appeal_id appeal_name appeal_code startDate endDate
total_requirements_usd total_funding_usd funding_percent targeted inneed affected reached population
""".split()
PROJECT = """
beneficiary_to_funding_ratio need_to_requirements_ratio targeting_coverage_rate funding_gap_usd
funding_gap_pct funding_coverage_rate cost_per_beneficiary
""".split()
POPULATION = """
cost_per_capita requirement_per_capita funding_coverage_pct requirement_coverage_pct
""".split()
SECTOR = """
sector_total_requirements_usd sector_total_funding_usd sector_total_gap_usd sector_project_count
project_funding_share_of_sector_pct project_requirement_share_of_sector_pct sector_funding_efficiency_pct
project_funding_status_vs_sector_avg
""".split()
STAT_GROUPS = {
    "project": "beneficiary_to_funding_ratio need_to_requirements_ratio targeting_coverage_rate funding_gap_pct funding_coverage_rate cost_per_beneficiary".split(),
    "population": "cost_per_capita requirement_per_capita funding_coverage_pct requirement_coverage_pct".split(),
    "sector": "project_funding_share_of_sector_pct project_requirement_share_of_sector_pct sector_funding_efficiency_pct project_funding_status_vs_sector_avg".split(),
}
CHECKED = """
country_code year cluster_code total_requirements_usd total_funding_usd funding_gap_pct cost_per_beneficiary
targeted inneed population sector_total_funding_usd sector_project_count
""".split()
KEY_TERMS = {
    "country": "country countrycode code iso3 iso2".split(),
    "cluster": "cluster sector cluster_name sector_name clustercode clusterid".split(),
    "year": "year date_year year_start year_end".split(),
    "appeal_id": "appeal appeal_id appeal_code plan_id activity_id".split(),
    "funding": "funding amount value".split(),
}
