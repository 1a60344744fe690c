"""Inputs in the shape of registry, facility, census and gazetteer extracts, derived from the order tables.

Plain SQL that Spark and DuckDB both take. A base table is written as ``{name}``:
Spark gets the frame there, DuckDB the bare name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    # one raw census row per customer (county source)
    "fx_acs": """
SELECT c_custkey,
  concat('Area ', cast(c_custkey AS string),
    CASE c_custkey % 6 WHEN 0 THEN ' County' WHEN 1 THEN ' Parish' WHEN 2 THEN ' City and Borough'
      WHEN 3 THEN ' Census Area' WHEN 4 THEN ' Borough' ELSE '' END,
    ', ', n_name) AS name,
  CASE WHEN c_custkey % 17 = 0 THEN 'N/A' ELSE cast((c_custkey * 7919) % 100000 AS string) END AS pop,
  CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS string) ELSE cast(20000 + (c_custkey * 613) % 90000 AS string) END AS income,
  cast(cast(floor(((c_custkey * 7919) % 57000) / 1e3) AS int) AS string) AS state,
  cast((c_custkey * 7919) % 1000 AS string) AS county
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    # long-format attribute rows, some counties absent
    "fx_rucc": """
SELECT cast((c_custkey * 7919) % 57000 AS string) AS fips, 'RUCC_2023' AS attribute, cast(c_custkey % 9 + 1 AS string) AS value
FROM {customer} WHERE c_custkey % 23 <> 0
UNION ALL
SELECT cast((c_custkey * 7919) % 57000 AS string), 'Population_2020', cast(c_custkey AS string) FROM {customer}""",
    # measure rows with '.0' keys and suppressed values
    "fx_cdc": """
SELECT concat(cast((c_custkey * 7919) % 57000 AS string), '.0') AS locationid,
  CASE WHEN c_custkey % 19 = 0 THEN '*' ELSE concat(cast(2 + c_custkey % 9 AS string), '.', lpad(cast((c_custkey * 37) % 1000 AS string), 3, '0')) END AS data_value,
  CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS string) ELSE '2022' END AS year
FROM {customer} WHERE c_custkey % 11 <> 0""",
    # designations keyed by user, many rows per county
    "fx_hpsa": """
SELECT cast((user_id * 7919) % 57000 AS string) AS county_fips,
  CASE event_type WHEN 'click' THEN ' Designated ' WHEN 'view' THEN 'Proposed For Withdrawal' ELSE 'Withdrawn' END AS status
FROM {events} WHERE user_id % 2 = 0""",
    # several counties per ZCTA, tied and zero weights
    "fx_crosswalk": """
SELECT lpad(cast((c_custkey * 31) % 900 AS string), 5, '0') AS zcta,
  cast((c_custkey * 7919) % 57000 AS string) AS county_geoid,
  CASE WHEN c_custkey % 10 = 0 THEN CAST(NULL AS string) ELSE cast((c_custkey * 101) % 5 AS string) END AS poppt
FROM {customer}""",
    # ZCTA centroids
    "fx_zcta_gaz": """
SELECT DISTINCT cast((c_custkey * 31) % 900 AS string) AS geoid,
  25 + ((((c_custkey * 31) % 900) * 7919) % 2400) / 1e2 AS lat,
  -125 + ((((c_custkey * 31) % 900) * 104729) % 5800) / 1e2 AS lng
FROM {customer}""",
    # county centroids, some missing
    "fx_county_gaz": """
SELECT cast((c_custkey * 7919) % 57000 AS string) AS geoid,
  25 + ((c_custkey * 6151) % 2400) / 1e2 AS lat,
  -125 + ((c_custkey * 3571) % 5800) / 1e2 AS lng
FROM {customer} WHERE c_custkey % 29 <> 0""",
    # five repeated (code, switch) slots instead of fifteen
    "fx_provider": """
SELECT o_orderkey AS npi,
  CASE WHEN o_orderkey % 10 = 0 THEN '2' ELSE '1' END AS entity_type,
  CASE WHEN o_orderkey % 101 = 0 THEN CAST(NULL AS string)
    WHEN o_orderkey % 3 = 0 THEN concat(lpad(cast(z AS string), 5, '0'), '1234')
    WHEN o_orderkey % 3 = 1 THEN cast(z AS string)
    ELSE concat(cast(z AS string), '.0') END AS postal,
  CASE WHEN (o_orderkey + 1) % 4 = 0 THEN CAST(NULL AS string) ELSE concat('T', cast((o_orderkey * 3 + 7) % 60 AS string)) END AS code_1,
  CASE WHEN (o_orderkey + 2) % 4 = 0 THEN CAST(NULL AS string) ELSE concat('T', cast((o_orderkey * 5 + 14) % 60 AS string)) END AS code_2,
  CASE WHEN (o_orderkey + 3) % 4 = 0 THEN CAST(NULL AS string) ELSE concat('T', cast((o_orderkey * 7 + 21) % 60 AS string)) END AS code_3,
  CASE WHEN (o_orderkey + 4) % 4 = 0 THEN CAST(NULL AS string) ELSE concat('T', cast((o_orderkey * 9 + 28) % 60 AS string)) END AS code_4,
  CASE WHEN (o_orderkey + 5) % 4 = 0 THEN CAST(NULL AS string) ELSE concat('T', cast((o_orderkey * 11 + 35) % 60 AS string)) END AS code_5,
  CASE WHEN o_orderkey % 5 = 0 THEN 'y' ELSE 'N' END AS switch_1,
  CASE WHEN o_orderkey % 5 = 1 THEN 'Y' ELSE 'N' END AS switch_2,
  CASE WHEN o_orderkey % 5 = 2 THEN 'Y' ELSE 'N' END AS switch_3,
  CASE WHEN o_orderkey % 5 = 3 THEN 'Y' ELSE CAST(NULL AS string) END AS switch_4,
  CASE WHEN o_orderkey % 5 = 4 THEN 'Y' ELSE 'N' END AS switch_5
FROM (SELECT o_orderkey, (o_custkey * 31 + o_orderkey % 2) % 900 AS z FROM {orders}) o""",
    # facilities with type text in mixed case
    "fx_hospital": """
SELECT CASE WHEN p_partkey % 97 = 0 THEN CAST(NULL AS string) ELSE cast(p_partkey AS string) END AS ccn,
  p_name AS name, cast((p_partkey * 31) % 900 AS string) AS zip,
  CASE WHEN p_partkey % 53 = 0 THEN CAST(NULL AS string) WHEN p_partkey % 4 = 0 THEN 'CRITICAL access Hospitals' ELSE 'Acute Care Hospitals' END AS hospital_type
FROM {part}""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The frame of one view over the tables in ``sf_dir``."""
    tables = set(re.findall(r"\{(\w+)\}", VIEWS[name]))
    return spark.sql(VIEWS[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def duckdb_view(name: str) -> str:
    """The SELECT of one view for DuckDB."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])
