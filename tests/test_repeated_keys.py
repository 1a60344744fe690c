"""Queries over tables in which areas' keys repeat: every combination is a row, as in the SQL twins."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import SF, rows

from reachmap.operators import dims
from reachmap.plans.oracle import ORACLE_SQL
from reachmap.plans.queries import QUERIES

NAMES = [
    "q10_merge_areas",
    "q12_area_atlas",
    "q13a_filter_none",
    "q13b_filter_state",
    "q13c_filter_rural",
    "q13d_filter_facility",
    "q13e_filter_shortage",
    "q13f_filter_stacked",
    "q14_national_stats",
    "q15_state_stats",
    "q16_density_histogram",
    "q17_distance_histogram",
    "q18_map_layer",
    "q19_area_report",
    "q20_area_card",
    "q25_json_rows",
    "q24_pipeline_summary",
    "q26_lookup",
    "q44_area_export",
    "q53_json_array",
    "q55_subset_stats",
    "q58_area_array",
    "q59_report_files",
    "q60_lookup_by_key",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with every customer twice, under keys that give one area."""
    folder = tmp_path_factory.mktemp("tables")
    for name in os.listdir(SF):
        (folder / name).symlink_to(f"{SF}/{name}")
    (folder / "customer.parquet").unlink()
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    kind = dict(customer.dtypes)["c_custkey"]
    customer.union(customer.withColumn("c_custkey", (F.col("c_custkey") + 57000).cast(kind))).coalesce(1).write.parquet(str(folder / "customer.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_where_keys_repeat(spark, duck, folder, name):
    got = QUERIES[name](spark, folder)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    found = got.collect()
    assert rows(got.columns, found) == rows(names, result.fetchall())
    if "ORDER BY fips" in ORACLE_SQL[name].rpartition("\n")[2] and "fips" in names:
        assert [r.fips for r in found] == sorted(r.fips for r in found)


def test_merged_areas_with_repeated_keys(spark):
    base = spark.createDataFrame([("01001", "Autauga", 1.0, None)], "fips string, county_name string, population double, median_hh_income double")
    rural = spark.createDataFrame([("01001", 2, False), ("01001", 5, True)], "fips string, rucc_2023 int, rural boolean")
    n_providers = spark.createDataFrame([("01001", 3)], "fips string, n_providers long")
    n_facilities = spark.createDataFrame([], "fips string, n_hospitals long, n_cah long")
    shortage = spark.createDataFrame([], "fips string, hpsa_primary_care boolean")
    measured = spark.createDataFrame([("01001", 7.0), ("01001", 7.0), ("01001", 8.0)], "fips string, disease_measure double")
    points = spark.createDataFrame([("01001", 32.0, -86.0)], "fips string, county_lat double, county_lng double")
    tables = (base, rural, n_providers, n_facilities, shortage, measured, points)
    found = dims.merge_areas(*tables).select("fips", "rucc_2023", "n_providers", "disease_measure").collect()
    assert sorted(map(tuple, found)) == [("01001", k, 3, m) for k in (2, 5) for m in (7.0, 7.0, 8.0)]
    with pytest.raises(Exception, match="fips repeats: 01001"):
        dims.merge_areas(*tables, unique=True).collect()
