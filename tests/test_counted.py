"""Queries over tables in which every area's key is there sixteen times: rows are counted before the joins, not multiplied in them."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import SF, rows

from reachmap import storage
from reachmap.operators import dims, records, view
from reachmap.plans.oracle import ORACLE_SQL
from reachmap.plans.queries import QUERIES

COPIES = 16
NAMES = [
    "q12_area_atlas",
    "q14_national_stats",
    "q15_state_stats",
    "q16_density_histogram",
    "q17_distance_histogram",
    "q24_pipeline_summary",
    "q55_subset_stats",
    "q18_map_layer",
    "q19_area_report",
    "q20_area_card",
    "q25_json_rows",
    "q26_lookup",
    "q60_lookup_by_key",
    "q44_area_export",
    "q53_json_array",
    "q58_area_array",
    "q59_report_files",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name in os.listdir(SF):
        (folder / name).symlink_to(f"{SF}/{name}")
    (folder / "customer.parquet").unlink()
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    shifted = [customer.withColumn("c_custkey", (F.col("c_custkey") + 57000 * k).cast(dict(customer.dtypes)["c_custkey"])) for k in range(COPIES)]
    records.union_all(shifted).coalesce(1).write.parquet(str(folder / "customer.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    return con


def listed(seq):
    return [seq.apply(k) for k in range(seq.size())]


def joined_rows(spark, run):
    """What ``run`` returns, and the most rows that a join of it has put out, but for the search of the nearest point."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark._jsc.sc().listenerBus()
    bus.waitUntilEmpty(60_000)
    last = max((e.executionId() for e in listed(store.executionsList().toSeq())), default=-1)
    result, most = run(), 0
    bus.waitUntilEmpty(60_000)
    for e in listed(store.executionsList().toSeq()):
        if e.executionId() > last:
            values = store.executionMetrics(e.executionId())
            for node in listed(store.planGraph(e.executionId()).allNodes().toSeq()):
                for metric in listed(node.metrics().toSeq()) if "Join" in node.name() and "[node#" not in node.desc() else []:
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        most = max(most, int(values.apply(metric.accumulatorId()).replace(",", "")))
    return result, most


@pytest.mark.parametrize("name", NAMES)
def test_query_multiplies_no_rows_in_joins(spark, duck, folder, name):
    def run():
        got = QUERIES[name](spark, folder)
        return got.columns, got.groupBy(*got.columns).agg(F.count(F.lit(1)).alias("copies")).collect()

    (columns, found), most = joined_rows(spark, run)
    result = duck.execute(f"SELECT *, count(*) AS copies FROM ({ORACLE_SQL[name]}) GROUP BY ALL")
    assert rows([*columns, "copies"], found) == rows([d[0] for d in result.description], result.fetchall())
    # the table has over 3,000,000 rows, a few thousand of them different
    assert 0 < most < 4 * duck.execute(f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({ORACLE_SQL['q13a_filter_none']}))").fetchone()[0]


def test_merged_areas_are_multiplied_last(spark, duck, folder):
    def run():
        got = QUERIES["q10_merge_areas"](spark, folder)
        return got.columns, got.groupBy(*got.columns).agg(F.count(F.lit(1)).alias("copies")).collect()

    (columns, found), most = joined_rows(spark, run)
    result = duck.execute(f"SELECT *, count(*) AS copies FROM ({ORACLE_SQL['q10_merge_areas']}) GROUP BY ALL")
    assert rows([*columns, "copies"], found) == rows([d[0] for d in result.description], result.fetchall())
    # each area of the result is there ten times or more
    assert 0 < most <= len(found) < sum(r.copies for r in found) / 10


def test_expanded_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 65536), ("e", 65537), ("f", 200_000)], "k string, n long")
    want = {"a": 1, "b": 3, "c": 1, "d": 65536, "e": 65537, "f": 200_000}
    found = records.expanded(df.coalesce(1).orderBy(F.desc("k")))
    assert found.columns == ["k"] and {r.k: r["count"] for r in found.groupBy("k").count().collect()} == want
    assert [r.k for r in found.collect()] == [k for k in sorted(want, reverse=True) for _ in range(want[k])]
    twice = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2), ("b", 1)], "k string, v int")
    assert sorted(map(tuple, records.counted(twice).collect()), key=str) == [("a", 1, 2), ("b", 1, 1), (None, 2, 2)]
    assert sorted(map(tuple, records.expanded(records.counted(twice)).collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_merged_and_counted(spark):
    base = spark.createDataFrame([("01001", "A", 1.0, None)] * 2 + [("01003", "B", 2.0, 3.0), ("99001", "C", 1.0, 1.0)], "fips string, county_name string, population double, median_hh_income double")
    rural = spark.createDataFrame([("01001", 2, False), ("01001", 2, False), ("01001", 5, True)], "fips string, rucc_2023 int, rural boolean")
    n_providers = spark.createDataFrame([("01001", 3)], "fips string, n_providers long")
    n_facilities = spark.createDataFrame([], "fips string, n_hospitals long, n_cah long")
    shortage = spark.createDataFrame([("01003", True)], "fips string, hpsa_primary_care boolean")
    measured = spark.createDataFrame([("01001", 7.01), ("01001", 7.02), ("01001", 8.0)], "fips string, disease_measure double")
    points = spark.createDataFrame([("01001", 32.0, -86.0), ("01001", 33.0, -86.0), ("01003", 1.0, 1.0), ("01005", 1.0, None)], "fips string, county_lat double, county_lng double")
    tables = (base, rural, n_providers, n_facilities, shortage, measured, points)
    found = dims.merge_counted(*tables)
    assert sorted((r.fips, r.rucc_2023, r.disease_measure, r.n) for r in found.filter("fips = '01001'").collect()) == [("01001", 2, 7.0, 16), ("01001", 2, 8.0, 8), ("01001", 5, 7.0, 8), ("01001", 5, 8.0, 4)]
    whole = dims.merge_areas(*tables).dropna(subset=["county_lat", "county_lng"]).drop("county_lat", "county_lng")
    assert sorted(map(str, records.expanded(found).collect())) == sorted(map(str, whole.collect()))


def test_rows_counted_in_both_ways(spark):
    rows = spark.createDataFrame([("a", True), ("a", True), ("b", False), (None, None)], "k string, rural boolean")
    df, seen = records.counted(rows, "rows of both", rural=F.col("rural"), with_key=F.col("k").isNotNull())
    assert df.count() == 4 and seen.get == {"rows": 4, "rural": 2, "with_key": 3}
    assert sorted(map(tuple, records.counted(rows).collect()), key=str) == sorted([("a", True, 2), ("b", False, 1), (None, None, 1)], key=str)
    with pytest.raises(TypeError):
        records.counted(rows, rural=F.col("rural"))


def test_layer_has_each_row_once_and_its_copies_are_dealt_out(spark):
    ids = spark.createDataFrame([("01001", 3), ("48001", 2)], "fips string, n long")
    areas = [(k, f"{c} of {k}", s, 1.5, True, m) for k, s in (("01001", "AL"), ("48001", "TX")) for c, m in (("A", 10_000), ("B", 20_000))]
    layer = view.map_layer(ids, spark.createDataFrame(areas, "fips string, county string, state string, miles_to_nearest double, rural boolean, n long"), view.AreaQuery(state="TX", rural_only=True, metric="distance"), "n")
    want = [("01001", None, 90_000), ("48001", "A of 48001, TX", 20_000), ("48001", "B of 48001, TX", 40_000)]
    assert sorted((r.fips, r.label, r.n) for r in layer.collect()) == want
    dealt = records.expanded(layer, dealt=True)
    assert sorted(map(tuple, dealt.groupBy("fips", "label").count().collect())) == want
    # copies of the one row outside of the state come out of several tasks
    assert dealt.filter("fips = '01001'").select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize(("name", "label"), [("q44_area_export", "areas"), ("q58_area_array", "array"), ("q59_report_files", "reports")])
def test_files_hold_equal_records_once(spark, folder, name, label):
    got = QUERIES[name](spark, folder)
    path = next(p for p in reversed(storage._given) if p.rpartition("/")[2].startswith(f"{label}-"))
    held = spark.read.format("parquet" if label == "reports" else "text").load(path)
    assert got.distinct().count() == held.count() < got.count() / 100


def test_array_takes_little_room_where_lines_are_equal(spark, folder):
    lines = QUERIES["q53_json_array"](spark, folder)
    path = next(p for p in reversed(storage._given) if p.rpartition("/")[2].startswith("array-")).removeprefix("file://")
    on_disk = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path))
    assert 0 < on_disk < lines.agg(F.sum(F.octet_length("line"))).first()[0] / 50
