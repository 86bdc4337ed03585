"""Policy table derived from the star-schema Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]

# Valid in Spark SQL and in DuckDB; {lineitem} etc. name the inputs. The CASE arms put
# NULLs and negative amounts in, because the input tables have none.
POLICIES_SQL = """
SELECT
  l_orderkey * 10 + l_linenumber                                   AS UnderwrittenCoverID,
  l_orderkey                                                       AS PolicyID,
  CAST(date_trunc('month', l_shipdate) AS DATE)                    AS TransactionMonth,
  r_name                                                           AS Province,
  n_name                                                           AS MainCrestaZone,
  CAST(c_custkey AS STRING)                                        AS PostalCode,
  CASE WHEN c_custkey % 10 = 0 THEN NULL
       WHEN c_custkey % 10 = 5 THEN 'Not specified'
       WHEN c_custkey % 2 = 1 THEN 'Female' ELSE 'Male' END        AS Gender,
  c_mktsegment                                                     AS CoverType,
  o_orderpriority                                                  AS CoverCategory,
  CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END           AS VehicleType,
  p_brand                                                          AS Make,
  2015 - p_size                                                    AS RegistrationYear,
  l_extendedprice * 10                                             AS SumInsured,
  CASE WHEN p_partkey % 4 = 0 THEN NULL
       ELSE p_retailprice * p_size * 8 END                         AS CustomValueEstimate,
  l_extendedprice / 12                                             AS CalculatedPremiumPerTerm,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL
       WHEN l_orderkey % 89 = 0 THEN -l_extendedprice * l_discount
       ELSE l_extendedprice * (1 - l_discount) END                 AS TotalPremium,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL
       WHEN l_returnflag = 'R' AND l_linestatus = 'F'
            THEN l_extendedprice * l_tax * 25 ELSE CAST(0 AS DOUBLE) END AS TotalClaims
FROM {lineitem}
JOIN {orders}   ON l_orderkey  = o_orderkey
JOIN {customer} ON o_custkey   = c_custkey
JOIN {nation}   ON c_nationkey = n_nationkey
JOIN {region}   ON n_regionkey = r_regionkey
JOIN {part}     ON l_partkey   = p_partkey
"""


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy view over the Parquet tables of one folder; lazy, joins left to Catalyst."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return spark.sql(POLICIES_SQL, **tables)
