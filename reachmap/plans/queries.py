"""Every query: a function of (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import haversine_miles
from ..functions.keys import pad_key, pad_state, round_even
from ..operators import assign, dims, lookup, records, report, view
from ..operators.view import AreaQuery
from ..sources.writers import json_rows
from ..sources import readers
from ..storage import new_path, written
from ..streaming import landing
from . import files
from .atlas import CODES, SLOTS, Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Brands whose parts count as wanted in the long form of the code choice.
WANTED_BRANDS = ["Brand#1", "Brand#7", "Brand#13"]
FILTERS = {
    "q13a_filter_none": AreaQuery(),
    "q13b_filter_state": AreaQuery(state="ND"),
    "q13c_filter_rural": AreaQuery(rural_only=True),
    "q13d_filter_facility": AreaQuery(facility_only=True),
    "q13e_filter_shortage": AreaQuery(shortage_only=True),
    "q13f_filter_stacked": AreaQuery(state="ND", rural_only=True, shortage_only=True),
}


def query(name: str) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    def add(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        return f

    return add


query("q01_pick_code")(lambda i: i.providers())
query("q03_primary_area")(lambda i: i.primary())
query("q04_providers_by_area")(lambda i: i.providers_by_area())
query("q04b_total")(lambda i: i.providers_by_area().agg(F.sum("n_providers").alias("n_providers")))
query("q05_facilities_by_area")(lambda i: i.facilities_by_area())
query("q06_shortage_areas")(lambda i: dims.members(i.census().select("fips"), i.shortage(), "hpsa_primary_care"))
query("q06b_shortage_keys")(lambda i: i.shortage().orderBy("fips"))
query("q07_census_parse")(lambda i: i.census())
query("q08_rurality")(lambda i: i.rurality())
query("q09_measure")(lambda i: i.measure())
query("q10_merge_areas")(lambda i: i.merged())
query("q11_nearest_provider")(lambda i: i.nearest())
query("q12_area_atlas")(lambda i: records.expanded(i.counted_atlas().orderBy("fips")))  # sorted before the copies are made
for _name, _asked in FILTERS.items():
    query(_name)(lambda i, asked=_asked: view.apply_filters(i.atlas(), asked))
query("q14_national_stats")(lambda i: view.national_stats(i.counted_atlas(), "n"))
query("q15_state_stats")(lambda i: view.state_stats(i.counted_atlas(), "n"))
query("q16_density_histogram")(lambda i: view.histogram(i.counted_atlas(), "density", "n"))
query("q17_distance_histogram")(lambda i: view.histogram(i.counted_atlas(), "distance", "n"))
query("q18_map_layer")(lambda i: records.expanded(view.map_layer(records.grouped(i.census().select("fips")), i.counted_atlas(), AreaQuery(state="TX", rural_only=True, metric="distance"), "n"), dealt=True))
query("q19_area_report")(lambda i: records.expanded(report.area_reports(i.counted_atlas(), dims.states(i.spark), keep=("n",))))
query("q20_area_card")(lambda i: records.expanded(report.area_cards(i.counted_atlas(), dims.states(i.spark), keep=("n",))))
query("q21_state_extent")(lambda i: view.state_extent(i.area_points().select("fips", F.col("county_lat").alias("lat"), F.col("county_lng").alias("lng")), dims.states(i.spark)))
query("q24_pipeline_summary")(lambda i: view.pipeline_summary(i.counted_atlas(), "n"))
query("q25_json_rows")(lambda i: records.expanded(json_rows(i.counted_atlas(), "fips", keep=("n",))))
query("q28_provider_locations")(lambda i: i.assigned().distinct())


@query("q02_pick_code_long")
def _pick_code_long(i: Inputs) -> DataFrame:
    wanted = i.table("part").filter(F.col("p_brand").isin(*WANTED_BRANDS)).select(F.col("p_partkey").alias("l_partkey"))
    rows = i.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return assign.pick_code_long(rows, "l_orderkey", "l_partkey", wanted, F.col("l_returnflag") == "R", ["l_linenumber", "l_partkey", "l_suppkey"])


@query("q22_latest_artifact")
def _latest_artifact(i: Inputs) -> DataFrame:
    pages = i.table("pages").select("url", "html", F.regexp_extract("url", r"://([^/?#]*)", 1).alias("site"))
    number = F.coalesce(F.regexp_extract("url", r"/(\d+)", 1).try_cast("bigint"), F.lit(0))
    latest = pages.groupBy("site").agg(F.max(F.struct(number.alias("number"), "url")).alias("last"))
    counts = records.links(pages, "site", "html").groupBy("site").agg(F.count(F.lit(1)).alias("n_links"))
    return latest.join(counts, "site", "left").select("site", F.col("last.url").alias("latest_url"), F.col("last.number").alias("number"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


@query("q23_lineage_latest")
def _lineage_latest(i: Inputs) -> DataFrame:
    entries = i.table("events").select("user_id", "event_type", "ts", "event_id", F.sha2("props", 256).alias("sha256"), F.octet_length("props").alias("bytes"))
    return records.latest_per_key(entries, ["user_id", "event_type"], ["ts", "event_id"])


@query("q26_lookup")
def _lookup(i: Inputs) -> DataFrame:
    areas = written(i.counted_atlas(), "atlas")  # read twice
    keys = areas.agg(F.array(F.min("fips"), F.max("fips"), F.lit("99999")).alias("k")).select(F.explode("k").alias("fips"))
    return records.expanded(view.lookup(areas, keys))


@query("q60_lookup_by_key")
def _lookup_by_key(i: Inputs) -> DataFrame:
    """The lookup of q26 in a table written for lookups, and every key that ends in 7 besides."""
    path = new_path(i.spark, "lookup")
    areas = written(i.counted_atlas(), "atlas")  # read three times
    lookup.write_lookup(areas, "fips", path)
    ends = areas.agg(F.array(F.min("fips"), F.max("fips"), F.lit("99999")).alias("k")).select(F.explode("k").alias("fips"))
    return records.expanded(lookup.lookup(i.spark, path, ends.union(areas.select("fips").filter("fips like '%7'")).distinct(), "fips"))


query("q27_first_match")(lambda i: records.first_match_of_rows(i.table("conversations"), "conv_id", "turn", F.col("role") == "assistant", "text", "first_assistant", "n_turns"))


@query("q29_largest_match")
def _largest_match(i: Inputs) -> DataFrame:
    parts = i.table("part").select("p_brand", "p_partkey", "p_name", "p_retailprice")
    return records.largest_match(parts, "p_brand", F.col("p_name"), "widget", "small", "p_retailprice", "p_partkey")


@query("q30_union_sources")
def _union_sources(i: Inputs) -> DataFrame:
    party = lambda t, p: i.table(t).select(F.lit(t).alias("kind"), F.col(f"{p}_{'suppkey' if p == 's' else 'custkey'}").alias("party"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance"))
    return records.union_all([party("supplier", "s"), party("customer", "c")])


def _snapshots(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Parts before and after some went, came, or changed their price."""
    part = i.table("part").select("p_partkey", "p_name", "p_retailprice")
    old = part.filter("p_partkey % 10 <> 0")
    new = part.filter("p_partkey % 10 <> 1").withColumn("p_retailprice", F.when(F.col("p_partkey") % 7 == 0, F.col("p_retailprice") + 1.0).otherwise(F.col("p_retailprice")))
    return old, new


query("q31_snapshot_diff")(lambda i: records.snapshot_diff(*_snapshots(i), "p_partkey", ["p_name", "p_retailprice"]))


@query("q32_haversine")
def _haversine(i: Inputs) -> DataFrame:
    points = i.raw("fx_county_gaz")
    miles = haversine_miles(F.col("lat").cast("double"), F.col("lng").cast("double"), F.lit(39.8), F.lit(-98.6))
    return points.select(pad_key(F.col("geoid")).alias("fips"), round_even(miles, 3).alias("miles"))


@query("q33_latest_artifact_name")
def _latest_artifact_name(i: Inputs) -> DataFrame:
    """The latest of the archives that each site links to, by month, year and version in their names."""
    name = F.concat(F.lit("./dump_"), F.when(F.col("o_orderkey") % 7 == 0, "Weekly_").otherwise(""), F.date_format("o_orderdate", "MMMM"), F.lit("_"), F.year("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("_V"), (F.col("o_orderkey") % 12).cast("string"))), F.lit(".zip"))
    site = F.col("o_custkey") % 500
    pages = i.table("orders").select(site.alias("site"), F.concat(F.lit('<a href="'), name, F.lit('">get</a> <a href="./other.html">')).alias("html"))
    return records.latest_artifact(records.links(pages, "site", "html"), base="https://example.org/", group=("site",))


@query("q34_upsert")
def _upsert(i: Inputs) -> DataFrame:
    """Lineage rows of two runs, the later one in place of the keys that both have."""
    rows = i.table("events").select("user_id", "event_type", "event_id", "value")
    run = lambda k: rows.filter(F.col("event_id") % 2 == k)
    latest = lambda k: records.latest_per_key(run(k), ["user_id", "event_type"], ["event_id"])
    return records.upsert(latest(0), latest(1), ["user_id", "event_type"])


@query("q54_upsert_buckets")
def _upsert_buckets(i: Inputs) -> DataFrame:
    """The same in a table of buckets, of which the later run rewrites those it has keys of."""
    path, keys = new_path(i.spark, "buckets"), ["user_id", "event_type"]
    rows = i.table("events").select("user_id", "event_type", "event_id", "value")
    latest = lambda k: records.latest_per_key(rows.filter(F.col("event_id") % 2 == k), keys, ["event_id"])
    records.create_buckets(latest(0), path, keys, buckets=16)
    records.upsert_buckets(latest(1), path, keys, buckets=16)
    return records.read_buckets(i.spark, path)


@query("q55_subset_stats")
def _subset_stats(i: Inputs) -> DataFrame:
    """The statistics of every filter of the q13 queries, from one small table."""
    cube = written(view.stats_cube(i.counted_atlas(), "n"), "cube")
    return records.union_all([view.cube_stats(cube, asked).select(F.lit(name).alias("filter"), "*") for name, asked in FILTERS.items()])


@query("q56_diff_by_digests")
def _diff_by_digests(i: Inputs) -> DataFrame:
    """The comparison of q31 by digests of buckets."""
    old, new = _snapshots(i)
    return records.snapshot_diff_by_digests(old, new, "p_partkey", ["p_name", "p_retailprice"], levels=(4, 8))


query("q53_json_array")(files.json_lines_of_array)
query("q57_streamed_manifest")(files.streamed_manifest)
query("q58_area_array")(files.areas_of_array)
query("q59_report_files")(files.report_files)
query("q35_manifest")(files.manifest)
query("q36_registry_file")(files.registry)
query("q37_facility_file")(files.facilities)
query("q38_measure_file")(files.measure)
query("q39_census_file")(files.census)
query("q40_rurality_file")(files.rurality)
query("q41_shortage_file")(files.shortage)
query("q42_crosswalk_file")(files.crosswalk)
query("q43_gazetteer_file")(files.gazetteer)
query("q44_area_export")(files.areas)
query("q45_pushdown")(lambda i: readers.pushed(i.table("lineitem"), (F.col("l_quantity") > 40) & (F.col("l_returnflag") == "R"), ["l_orderkey", "l_linenumber", "l_quantity"]))
query("q49_state_codes")(lambda i: i.raw("fx_acs").select("c_custkey", pad_state(F.col("state")).alias("state_code")))
query("q50_nearest_by_wide_cubes")(lambda i: i.nearest(leaf=1, fan=2, top=8))  # a tree of many levels


@query("q46_counters")
def _counters(i: Inputs) -> DataFrame:
    """Rows of the raw facilities and those with an id or of the kind, counted while they are written."""
    places = assign.facilities(i.raw("fx_hospital"))
    df, seen = records.observed(places, "facilities", with_id=F.col("ccn").isNotNull(), of_kind=F.col("is_kind"))
    kept = written(df, "facilities").count()
    return i.spark.createDataFrame([(seen.get["rows"], seen.get["with_id"], seen.get["of_kind"], kept)], "n_rows long, with_id long, of_kind long, kept long")


@query("q47_state_view")
def _state_view(i: Inputs) -> DataFrame:
    """The view of every state that an area's key or a customer's segment names; those that are no state get the whole."""
    points = i.area_points().select("fips", F.col("county_lat").alias("lat"), F.col("county_lng").alias("lng"))
    asked = dims.states(i.spark).select("state").union(i.table("customer").select(F.col("c_mktsegment").alias("state")).distinct())
    return view.view_of(asked, view.state_extent(points, dims.states(i.spark)))


@query("q48_areas_within")
def _within(i: Inputs) -> DataFrame:
    """Areas with a designation, and those without."""
    areas, keys = i.census().select("fips"), i.shortage()
    sides = [dims.within(areas, keys, inside).withColumn("inside", F.lit(inside)) for inside in (True, False)]
    return records.union_all(sides)


@query("q51_stream_latest")
def _stream_latest(i: Inputs) -> DataFrame:
    """The last event of each user and type, landed by a stream over files and read over all of its batches."""
    path = new_path(i.spark, "stream")
    events = i.table("events").select("user_id", "event_type", "event_id", "value")
    events.write.parquet(f"{path}/in")
    stream = i.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/in")
    landing.land_latest(stream, f"{path}/table", f"{path}/progress", ["user_id", "event_type"], ["event_id"]).awaitTermination()
    return landing.latest(i.spark, f"{path}/table", ["user_id", "event_type"], ["event_id"])


@query("q52_stream_providers")
def _stream_providers(i: Inputs) -> DataFrame:
    """Chosen providers of registry files that a stream appends as they land."""
    path = new_path(i.spark, "stream")
    raw = i.raw("fx_provider")
    raw.write.parquet(f"{path}/in")
    landing.land(landing.stream_providers(i.spark, f"{path}/in", raw.schema, CODES, SLOTS), f"{path}/table", f"{path}/progress").awaitTermination()
    return i.spark.read.parquet(f"{path}/table")


__all__ = ["CODES", "QUERIES"]
