"""Functions and operators on literals: keys, numbers, classes, statistics, filters, distances, records."""

import hashlib
import itertools
import json
import math
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmap.functions import geo, keys, labels
from reachmap.operators import assign, dims, lookup, nearest, records, report, view
from reachmap.operators.view import AreaQuery
from reachmap.sources import digests, readers, writers


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def texts(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.v for r in df.select("i", f(F.col("s")).alias("v")).orderBy("i").collect()]


# ---- keys and numbers -----------------------------------------------------------------------


def test_pad_key(spark):
    values = ["1001", "1001.0", "48301", " 7\t", "1234567", "-12", "+3", None, "", "\n48301.0 ", "00001", "0", "1.0.0", "123456.0"]

    def python(v):
        if v is None:
            return None
        v = v.strip()
        return (v[:-2] if v.endswith(".0") else v).zfill(5)

    assert texts(spark, values, keys.pad_key) == [python(v) for v in values]
    assert texts(spark, ["1", "12"], lambda c: keys.pad_key(c, 2)) == ["01", "12"]


def test_pad_zip_and_parts(spark):
    assert texts(spark, ["123456789", "501", "501.0", None], keys.pad_zip) == ["12345", "00501", "00501", None]
    assert one(spark, keys.key_of_parts(F.lit("1"), F.lit("1"))) == "01001"
    assert texts(spark, ["1", "48"], keys.pad_state) == ["01", "48"]


def test_to_number(spark):
    values = ["12", " 1.5 ", "-2e3", "12d", "0x1p3", "abc", "", "*", "NaN", "inf", None, ".5", "5.", "+7"]
    assert texts(spark, values, keys.to_number) == [12.0, 1.5, -2000.0, None, None, None, None, None, None, None, None, 0.5, 5.0, 7.0]


def test_round_even_is_that_of_scaled_binary_values(spark):
    rng = random.Random(1)
    values = [rng.randrange(0, 10**6) / 10**rng.randrange(1, 5) for _ in range(2000)] + [0.25, 0.35, 2.675, 1.005, 30.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.r for r in df.select(keys.round_even(F.col("v"), 1).alias("r")).collect()]
    assert got == [round(v * 10.0) / 10.0 for v in values]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("x", 2), ("null", 3), ("", 4)], "a string, b int")
    assert [r.a for r in keys.null_tokens(df).orderBy("b").collect()] == [None, "x", None, None]


def test_contains_fold(spark):
    assert texts(spark, ["CRITICAL access x", "acute", None], lambda c: keys.contains_fold(c, "Critical Access")) == [True, False, False]


# ---- classes and texts ----------------------------------------------------------------------


@pytest.mark.parametrize(("n", "fill"), [(0, 0), (1, 1), (2, 1), (3, 2), (4, 2), (5, 4), (50, 4)])
def test_density_fill(spark, n, fill):
    assert one(spark, labels.fill_of("density", F.lit(n))) == f"var(--color-choro-{fill})"


@pytest.mark.parametrize(("miles", "fill"), [(5.0, "choro-4"), (10.0, "choro-3"), (99.9, "choro-1"), (150.0, "choro-0"), (None, "grid")])
def test_distance_fill(spark, miles, fill):
    assert one(spark, labels.fill_of("distance", F.lit(miles).cast("double"))) == f"var(--color-{fill})"


def test_legends():
    assert len(labels.DENSITY_LABELS) == len(labels.DENSITY_FILLS) == 4
    assert len(labels.DISTANCE_LABELS) == len(labels.DISTANCE_FILLS) == 5


def test_texts(spark):
    assert one(spark, labels.grouped(F.lit(1234567))) == "1,234,567"
    assert one(spark, labels.grouped(F.lit(None).cast("bigint"))) == "—"
    assert one(spark, labels.one_decimal(F.lit(None).cast("double"))) == "—"
    assert [one(spark, labels.whole(F.lit(x))) for x in (30.5, 30.4, 0.0)] == ["31", "30", "0"]
    assert one(spark, labels.percent(F.lit(0.5))) == "50.0%"
    assert [one(spark, labels.plural(F.lit(n), "provider")) for n in (0, 1, 2)] == ["0 providers", "1 provider", "2 providers"]


# ---- statistics, filters --------------------------------------------------------------------

AREA = {"fips": "00000", "state": "XX", "county": "A", "population": 100, "median_hh_income": 50000, "rucc_2023": 1, "rural": False, "n_providers": 0, "miles_to_nearest": None, "n_hospitals": 0, "n_cah": 0, "hpsa_primary_care": False, "disease_measure": None}


def areas(spark, *changes):
    return spark.createDataFrame([AREA | c for c in changes], readers.AREA_SCHEMA)


STATS = [
    {"n_providers": 0, "population": 500, "rural": True, "miles_to_nearest": 40.0},
    {"n_providers": 0, "population": 800, "rural": True, "miles_to_nearest": 60.0, "n_cah": 1},
    {"n_providers": 3, "population": 5000, "miles_to_nearest": 2.0},
    {"n_providers": 12, "population": 100000, "miles_to_nearest": 0.0},
]


def test_national_stats(spark):
    r = view.national_stats(areas(spark, *STATS)).first()
    assert (r.total, r.zero_providers, r.zero_share, r.median_rural_miles, r.facility_far, r.population_underserved, r.zero_share_text) == (4, 2, 0.5, 60.0, 1, 1300, "50.0%")
    r = view.national_stats(areas(spark, AREA).limit(0)).first()
    assert (r.total, r.zero_share, r.median_rural_miles, r.population_underserved) == (0, 0.0, 0.0, 0)


def test_two_medians(spark):
    assert view.pipeline_summary(areas(spark, *STATS)).first().median_rural_miles == 50.0


def test_state_stats_roll_up(spark):
    got = {r.state: r.total for r in view.state_stats(areas(spark, {"state": "TX"}, {"state": "TX"}, {"state": "NY"})).collect()}
    assert got == {"TX": 2, "NY": 1, None: 3}


FILTER_ROWS = [
    {"fips": "48301", "state": "TX", "rural": True, "n_cah": 1, "hpsa_primary_care": True},
    {"fips": "48201", "state": "TX"},
    {"fips": "36061", "state": "NY"},
    {"fips": "54047", "state": "WV", "rural": True, "hpsa_primary_care": True},
]


@pytest.mark.parametrize(
    ("asked", "n"),
    [({}, 4), ({"state": "TX"}, 2), ({"rural_only": True}, 2), ({"facility_only": True}, 1), ({"shortage_only": True}, 2), ({"state": "TX", "rural_only": True, "shortage_only": True}, 1), ({"state": ""}, 4)],
)
def test_filters(spark, asked, n):
    assert view.apply_filters(areas(spark, *FILTER_ROWS), AreaQuery(**asked)).count() == n


def test_query_parameters():
    assert AreaQuery.of({"state": "TX", "rural": "1", "metric": "x"}) == AreaQuery(state="TX", rural_only=True)
    assert AreaQuery.of({}) == AreaQuery()
    with pytest.raises(ValueError):
        AreaQuery(metric="none")


def test_map_layer(spark):
    ids = spark.createDataFrame([("48301",), ("48201",), ("36061",), ("48999",)], "fips string")
    got = {r.fips: (r.in_state, r.fill, r.opacity) for r in view.map_layer(ids, areas(spark, *FILTER_ROWS), AreaQuery(state="TX", rural_only=True)).collect()}
    assert got == {
        "48301": (True, "var(--color-choro-0)", 1.0), "48201": (True, "var(--color-grid)", 1.0), "36061": (False, "var(--color-panel-hi)", 0.35), "48999": (True, "var(--color-grid)", 1.0),
    }


def test_lookup(spark):
    keys_ = spark.createDataFrame([("48301",), ("99999",)], "fips string")
    assert {r.fips: (r.found, r.state) for r in view.lookup(areas(spark, *FILTER_ROWS), keys_).collect()} == {"48301": (True, "TX"), "99999": (False, None)}


def test_states(spark):
    rows = dims.states(spark).collect()
    assert len(rows) == 51
    by = {r.prefix: r.state for r in rows}
    assert (by["48"], by["11"], by.get("99")) == ("TX", "DC", None)
    assert len({r.state for r in rows}) == 51


def test_state_extent(spark):
    points = spark.createDataFrame([("48001", 30.0, -100.0), ("48003", 32.0, -96.0), ("02001", 60.0, -150.0), ("11001", 38.9, -77.0)], "fips string, lat double, lng double")
    got = {r.state: (r.center_lng, r.center_lat, r.zoom) for r in view.state_extent(points, dims.states(spark)).collect()}
    assert got["AK"] == (-150.0, 63.0, 3.2)
    assert got["DC"] == (-77.0, 38.9, 14.0)
    assert got["TX"] == pytest.approx((-98.0, 31.0, 0.9 * min(58 / 4, 24 / 2)))


# ---- assignment -----------------------------------------------------------------------------


def test_pick_code_wide_equals_long_and_brute(spark):
    rng = random.Random(4)
    rows = [(i, *[rng.choice([None, "A", "B", "C"]) for _ in range(3)], *[rng.choice([None, "Y", "y", "N"]) for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "npi int, code_1 string, code_2 string, code_3 string, switch_1 string, switch_2 string, switch_3 string")
    got = {r.npi: r.c for r in df.select("npi", assign.pick_code([(F.col(f"code_{k}"), F.col(f"switch_{k}")) for k in (1, 2, 3)], ["A", "B"]).alias("c")).collect()}

    def brute(r):
        wanted = [(c, s) for c, s in zip(r[1:4], r[4:7], strict=True) if c in ("A", "B")]
        return next((c for c, s in wanted if s and s.upper() == "Y"), wanted[0][0] if wanted else None)

    assert got == {r[0]: brute(r) for r in rows}
    slots = spark.createDataFrame([(r[0], k, r[1 + k], r[4 + k]) for r in rows for k in range(3)], "npi int, slot int, code string, switch string")
    codes = spark.createDataFrame([("A",), ("B",)], "code string")
    long = assign.pick_code_long(slots, "npi", "code", codes, F.upper("switch") == "Y", ["slot"])
    assert {r.npi: r.code for r in long.collect()} == {k: v for k, v in got.items() if v}


def test_primary_area(spark):
    rows = [("1", "10", "5"), ("1", "9", "5"), ("1", "8", "x"), ("2", "7", None), ("2", "6.0", "0"), (None, "5", "9")]
    got = assign.primary_area(spark.createDataFrame(rows, "z string, a string, w string"), "z", "a", "w")
    assert {(r.zcta, r.fips) for r in got.collect()} == {("00001", "00009"), ("00002", "00006")}
    assert assign.primary_area(spark.createDataFrame(rows, "z string, a string, w string"), "z", "a", None).count() == 2


def test_missing_postal_codes_match_nothing(spark):
    people = spark.createDataFrame([("1", "T", None), ("2", "T", "00001")], "npi string, code string, zip5 string")
    primary = spark.createDataFrame([(None, "99999"), ("00001", "10001")], "zcta string, fips string")
    assert [(r.npi, r.fips) for r in assign.provider_areas(people, primary).collect()] == [("2", "10001")]


def test_census_names(spark):
    raw = spark.createDataFrame([("Juneau City and Borough, Alaska", "1,2", "5", "2", "110"), ("X Parish, Y, Z", "7", "N/A", "22", "1")], "name string, pop string, income string, state string, county string")
    got = dims.census(raw).orderBy("fips").collect()
    assert [(r.fips, r.county_name, r.state_name, r.population, r.median_hh_income) for r in got] == [("02110", "Juneau", "Alaska", None, 5.0), ("22001", "X", "Y, Z", 7.0, None)]


def test_rurality_layouts(spark):
    long = spark.createDataFrame([("1001", "RUCC_2023", "4"), ("1001", "Pop", "9"), ("1003", "RUCC_2023", "x")], "fips string, attribute string, value string")
    wide = spark.createDataFrame([("1001", "4"), ("1003", None)], "fips string, rucc_2023 string")
    for raw in (long, wide):
        assert [tuple(r) for r in dims.rurality(raw).collect()] == [("01001", 4, True)]


def test_assert_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        dims.assert_unique(df, "k")
    assert dims.assert_unique(df.distinct(), "k").count() == 1


def test_repeated_keys_are_errors_in_the_plan(spark):
    df = spark.createDataFrame([("01001", 1, None), ("01003", 2, "x"), (None, 3, "y"), (None, 4, "z")], "fips string, a int, b string")
    assert sorted(map(tuple, dims.one_row_a_key(df, "fips").collect())) == [("01001", 1, None), ("01003", 2, "x")]
    checked = dims.one_row_a_key(df.union(df.filter("a = 2")), "fips")
    with pytest.raises(Exception, match="fips repeats: 01003"):
        checked.collect()
    assert dims.one_row_a_key(df.limit(0), "fips").collect() == []


# ---- distance -------------------------------------------------------------------------------


def test_chord_is_haversine(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    p, q = geo.unit_vector(F.col("a"), F.col("b")), geo.unit_vector(F.col("c"), F.col("d"))
    chord = F.sqrt(sum((F.pow(x - y, 2) for x, y in zip(p, q, strict=True)), F.lit(0.0)))
    for r in df.select(geo.arc_miles(chord).alias("x"), geo.haversine_miles(*map(F.col, "abcd")).alias("y")).collect():
        assert r.x == pytest.approx(r.y, abs=1e-3)


def test_grid_equals_brute_force(spark):
    rng = random.Random(3)
    area = spark.createDataFrame([(str(i), rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(150)] + [("n", None, 1.0)], "fips string, lat double, lng double")
    point = spark.createDataFrame([(rng.uniform(20, 50), rng.uniform(-120, -70)) for _ in range(300)] + [(None, 1.0)], "y double, x double")
    rows, places = ([tuple(r) for r in df.dropna().collect()] for df in (area, point))
    miles = lambda a, b, c, d: 2 * geo.EARTH_MILES * math.asin(math.sqrt(math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2))
    want = {k: min(miles(y, x, *p) for p in places) for k, y, x in rows}
    for tree in ({}, {"leaf": 0, "fan": 1, "top": 16}, {"leaf": 3, "fan": 2, "top": 4}):
        got = {r.fips: r.m for r in nearest.nearest_miles(area, point, "fips", "lat", "lng", "y", "x", "m", **tree).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 0.0501 for k in want)
    assert nearest.nearest_miles(area, point.limit(0), "fips", "lat", "lng", "y", "x", "m").count() == 0
    assert nearest.nearest_miles(area.limit(0), point, "fips", "lat", "lng", "y", "x", "m").count() == 0


def test_a_dense_far_city_is_compared_with_few_points(spark):
    """100,000 points within some miles, queries up to half the earth away: each goes to a few leaves, near ones too."""
    rng = random.Random(4)
    city = spark.range(100_000).select((40 + F.rand(1) / 20).alias("y"), (-100 + F.rand(2) / 20).alias("x"))
    far = [(str(i), rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(60)] + [(f"in{i}", 40 + rng.random() / 20, -100 + rng.random() / 20) for i in range(20)]
    area = spark.createDataFrame(far, "fips string, lat double, lng double")
    unit = lambda df, lat, lng, p: df.select("*", *[c.alias(f"{p}{a}") for a, c in zip("xyz", geo.unit_vector(F.col(lat), F.col(lng)), strict=True)])
    held = nearest.numbered(unit(city, "y", "x", "p").select("px", "py", "pz"))
    queries = unit(area, "lat", "lng", "q").select(F.struct("fips").alias("row"), "qx", "qy", "qz")
    n = nearest.candidates(queries, held).groupBy("row").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert n[0] * 2**nearest.LEAF <= 5000 and n[1] == 80  # of 100,000
    p = np.array([tuple(r) for r in held.select("px", "py", "pz").collect()])
    want = {r.row.fips: 2 * geo.EARTH_MILES * math.asin(min(1.0, np.sqrt(((p - [r.qx, r.qy, r.qz]) ** 2).sum(axis=1).min()) / 2)) for r in queries.collect()}
    got = {r.fips: r.m for r in nearest.nearest_miles(area, city, "fips", "lat", "lng", "y", "x", "m").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 0.0501 for k in want)


# ---- records --------------------------------------------------------------------------------


def test_latest_and_upsert(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert {tuple(r) for r in records.latest_per_key(rows, ["k"], ["t"]).collect()} == {("a", 2, "y"), ("b", 1, "z")}
    new = spark.createDataFrame([("a", 3, "w")], "k string, t int, v string")
    assert {tuple(r) for r in records.upsert(rows, new, ["k"]).collect()} == {("b", 1, "z"), ("a", 3, "w")}
    assert records.same_rows(rows, rows) and not records.same_rows(rows, new)


def test_counters_and_membership(spark):
    df, seen = records.counted(areas(spark, *FILTER_ROWS), "areas", rural=F.col("rural"))
    assert df.count() == 4 and seen.get == {"rows": 4, "rural": 2}
    keys_ = spark.createDataFrame([("48301",), ("48301",)], "fips string")
    assert [dims.within(df, keys_, inside).count() for inside in (True, False)] == [1, 3]
    assert dims.members(df.select("fips"), keys_.distinct(), "m").filter("m").count() == 1


def test_latest_artifact(spark):
    names = ["./dump_March_2024_V2.zip", "./dump_April_2023.zip", "./dump_March_2024.zip", "./dump_Weekly_December_2025.zip", "./other.zip", "./dump_May_2023_V9.zip"]
    found = spark.createDataFrame([(n,) for n in names], "link string")
    assert records.latest_artifact(found, base="https://example.org/").first()["link"] == "https://example.org/dump_March_2024_V2.zip"


def test_largest_match_and_first_match(spark):
    files = spark.createDataFrame([("z", "data_a.csv", 5), ("z", "data_b.csv", 9), ("z", "data_b_header.csv", 99), ("y", "other", 1)], "g string, name string, size int")
    assert [tuple(r) for r in records.largest_match(files, "g", F.col("name"), "data", "header", "size", "name").collect()] == [("z", "data_b.csv", 9)]
    items = F.array(*[F.struct(F.lit(m).alias("media"), F.lit(u).cast("string").alias("url"), F.lit(a).cast("string").alias("alt")) for m, u, a in (("json", "u1", "a1"), ("csv", None, "a2"), ("csv", "u3", "a3"))])
    assert one(spark, records.first_match(items, lambda d: d["media"] == "csv", lambda d: [d["url"], d["alt"]])) == "a2"


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    assert {tuple(r) for r in records.snapshot_diff(old, new, "k", ["v"]).collect()} == {(1, "removed"), (2, "changed"), (4, "added")}


def test_manifest(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello")
    files = digests.file_digests(spark, str(tmp_path / "a.txt"))
    r = records.manifest(files, "s", "src", str(tmp_path), F.lit("2024-01-01T00:00:00Z")).first()
    assert (r.local_path, r.sha256, r.bytes) == ("a.txt", hashlib.sha256(b"hello").hexdigest(), 5)


# ---- reports --------------------------------------------------------------------------------


def test_reports_and_cards(spark):
    rows = areas(spark, {"fips": "48301", "state": "TX", "county": "Loving", "miles_to_nearest": 60.5, "n_cah": 1}, {"fips": "48303", "state": "TX", "county": "B", "n_providers": 1, "hpsa_primary_care": True, "miles_to_nearest": 55.0, "population": None})
    r, s = report.area_reports(rows, dims.states(spark)).orderBy("fips").collect()
    assert (r.state_name, r.miles_text, r.population_text, r.income_text, r.warn_none, r.warn_miles_panel, r.warn_facility) == ("Texas", "60.5", "100", "$50,000", True, True, True)
    assert r.narrative.endswith("approximately 61 miles away.")
    assert (s.population_text, s.warn_miles_report, s.warn_miles_panel, s.narrative) == ("—", True, False, "B County has 1 provider with primary practice ZIPs inside the county.")
    a, b = report.area_cards(rows, dims.states(spark)).orderBy("fips").collect()
    assert (a.title, a.subtitle, a.tag) == ("Loving County, Texas", "0 providers · 61 mi to nearest", "ZERO PROVIDERS")
    assert (b.tag, b.spoken) == ("HPSA · PRIMARY CARE", "B, TX. 1 provider.")


# ---- files ----------------------------------------------------------------------------------


def test_text_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("FIPS, Name \n1001,Caf\xe9\n1003,NA\n1,2,3\n5\n\"q,x\",y\n".encode("latin-1"))
    got = readers.read_text_table(spark, str(tmp_path / "a.csv"), encoding="ISO-8859-1", skip_long_rows=True)
    assert got.columns == ["FIPS", "Name"]
    assert {tuple(r) for r in got.collect()} == {("1001", "Café"), ("1003", None), ("5", None), ("q,x", "y")}
    (tmp_path / "b.txt").write_text("GEOID_ZCTA5_20|GEOID_COUNTY_20|POPPT\n1|10|5\n")
    raw = readers.read_text_table(spark, str(tmp_path / "b.txt"), sep="|")
    names = readers.resolve_containing(raw.columns, {"zcta": ("ZCTA5", "GEOID"), "fips": ("COUNTY", "GEOID"), "pop": ("POP",), "none": ("Q",)})
    assert [tuple(r) for r in readers.renamed(raw, names, ("zcta", "fips")).collect()] == [("1", "10", "5")]
    (tmp_path / "c.txt").write_text("GEOID\tINTPTLAT\tINTPTLONG   \n1001\t32.5\t-86.6\n")
    assert readers.read_text_table(spark, str(tmp_path / "c.txt"), sep="\t").columns == ["GEOID", "INTPTLAT", "INTPTLONG"]


def test_json_rows_of_arrays(spark, tmp_path):
    (tmp_path / "acs.json").write_text(json.dumps([["NAME", "pop", "state"], ["A County, X", "5", "01"], ["B, Y", None, "02"]]))
    assert [tuple(r) for r in readers.read_json_rows(spark, str(tmp_path / "acs.json")).collect()] == [("A County, X", "5", "01"), ("B, Y", None, "02")]


def test_header_resolution(spark):
    assert readers.resolve(["facility id", "State"], {"ccn": ("Facility ID", "CCN"), "state": ("STATE",), "zip": ("ZIP Code",)}) == {"ccn": "facility id", "state": "State"}
    with pytest.raises(ValueError):
        readers.renamed(spark.createDataFrame([(1,)], "a int"), {}, ("fips",))


def test_registry(spark, tmp_path):
    (tmp_path / "r.csv").write_text("NPI,Kind,Zip,Extra,Tax_1,Tax_2,Sw_1,Sw_2\n1,1,123456789,x,T1,T2,N,Y\n2,2,1,x,T1,,Y,\n3,1,501.0,x,,T9,,Y\n")
    raw = readers.read_registry(spark, str(tmp_path / "r.csv"), {"npi": "NPI", "entity_type": "Kind", "postal": "Zip"}, {"code": "Tax", "switch": "Sw"}, 2)
    assert "Extra" not in raw.columns
    assert [tuple(r) for r in assign.providers(raw, ["T1", "T2"], 2).collect()] == [("1", "T2", "12345")]


def test_missing_source_is_an_empty_table(spark, tmp_path):
    schema = "fips string, v double"
    assert readers.read_or_empty(spark, lambda: spark.read.csv(str(tmp_path / "none")), schema, ()).columns == ["fips", "v"]
    other = spark.createDataFrame([(1,)], "x int")
    assert readers.read_or_empty(spark, lambda: other, schema, ("locationid",)).count() == 0
    with pytest.raises(ValueError):
        readers.not_empty(other.limit(0), "providers")
    assert readers.pushed(other, F.col("x") == 1, ["x"], 10).count() == 1


def test_area_export_and_import(spark, tmp_path):
    rows = areas(spark, *FILTER_ROWS).withColumn("disease_measure", F.lit(float("nan")))
    writers.write_json_array(rows, "fips", str(tmp_path / "array"))
    text = joined(tmp_path / "array")
    loaded = json.loads(text)
    assert [r["fips"] for r in loaded] == sorted(r["fips"] for r in FILTER_ROWS) and loaded[0]["disease_measure"] is None
    (tmp_path / "areas.json").write_text(text)
    back = readers.read_areas(spark, str(tmp_path / "areas.json"))
    assert back.count() == 4 and back.filter("fips = '48301'").first().n_cah == 1
    writers.write_table(rows, str(tmp_path / "t"))
    assert any("zstd" in p.name for p in (tmp_path / "t").iterdir())
    writers.write_reports(report.area_reports(rows, dims.states(spark)), str(tmp_path / "r"))
    assert {p.name for p in (tmp_path / "r").glob("state=*")} == {"state=TX", "state=NY", "state=WV"}


def test_stream_landing(spark, tmp_path):
    from reachmap.streaming import landing

    schema = "npi bigint, entity_type string, postal string, code_1 string, switch_1 string, updated string"
    batches = [[(1, "1", "501", "T1", "Y", "2024-02"), (1, "1", "7", "T1", "Y", "2024-01"), (2, "2", "1", "T1", "Y", "2024-01")], [(1, "1", "99", "T1", "N", "2024-03"), (3, "1", "7", "T9", "Y", "2024-01")], [(1, "1", "11", "T1", "N", "2023-12")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = landing.stream_providers(spark, str(tmp_path / "in"), schema, ["T1"], 1, keep=("updated",))
        landing.land(stream, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination(120)
        landing.land_latest(stream, str(tmp_path / "latest"), str(tmp_path / "c2"), ["npi"], ["updated"]).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).count() == k + 2
        got = landing.latest(spark, str(tmp_path / "latest"), ["npi"], ["updated"]).collect()
        assert [(r.npi, r.zip5) for r in got] == [(1, ["00501", "00099", "00099"][k])]  # the newest by time, whichever batch it came with


def test_compaction_and_cleared_runs(spark, tmp_path):
    from reachmap import storage
    from reachmap.streaming import landing

    path, schema = f"file://{tmp_path}/t", "k long, at string, v string"
    for epoch, rows in enumerate([[(1, "b", "x"), (2, "a", "y")], [(1, "a", "late"), (3, None, "n")], [(2, "c", "z")]]):
        writers.write_table(spark.createDataFrame(rows, schema), f"{path}/epoch={epoch}")
    want = sorted(map(tuple, landing.latest(spark, path, ["k"], ["at"]).collect()))
    for _ in range(2):
        with storage.run(spark):
            landing.compact(spark, path, ["k"], ["at"])
        assert [p.name for p in (tmp_path / "t").glob("epoch=*")] == ["epoch=2"]
        assert sorted(map(tuple, landing.latest(spark, path, ["k"], ["at"]).collect())) == want == [(1, "b", "x"), (2, "c", "z"), (3, None, "n")]
    folder = storage.shared_dir(spark).removeprefix("file:").replace("//", "/")
    with storage.run(spark):
        kept = storage.written(spark.range(3), "cleared")
        assert kept.count() == 3
    assert not list(pathlib.Path(folder).glob("cleared-*"))


def test_headers_of_all_files_must_agree(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("FIPS,Name\n1,x\n")
    (tmp_path / "t" / "b.csv").write_text("Name,FIPS\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_text_table(spark, str(tmp_path / "t")).collect()
    with pytest.raises(ValueError, match="header"):
        readers.read_text_table(spark, str(tmp_path / "t"), skip_long_rows=True)


def test_line_ends_within_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('FIPS,Name\n1,"x, ""q""\ny"\n2,z\n')
    for skip in (False, True):
        got = readers.read_text_table(spark, str(tmp_path / "a.csv"), skip_long_rows=skip).collect()
        assert {tuple(r) for r in got} == {("1", 'x, "q"\ny'), ("2", "z")}


def test_json_files_with_columns_in_another_order(spark, tmp_path):
    for name, rows in (("a", [["NAME", "pop"], ["A", "5"], ["B"]]), ("b", [["pop", "NAME"], ["6", "C"]]), ("c", [["NAME"], ["D"]])):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    got = readers.read_json_rows(spark, str(tmp_path)).select("NAME").collect()
    assert sorted(r.NAME for r in got) == ["A", "B", "C", "D"]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.json").write_text("")
    with pytest.raises(ValueError):
        readers.read_json_rows(spark, str(tmp_path / "empty"))


def test_centroids_of_texts(spark):
    raw = spark.createDataFrame([("1001", "32.5", " -86.6"), ("1003", "abc", "1"), ("1005", None, "1"), ("1007", "", "2")], "geoid string, lat string, lng string")
    assert [tuple(r) for r in dims.centroids(raw, "fips", "y", "x").collect()] == [("01001", 32.5, -86.6)]


def test_views(spark):
    points = spark.createDataFrame([("48001", 30.0, -100.0), ("48003", 32.0, -96.0)], "fips string, lat double, lng double")
    asked = spark.createDataFrame([("TX",), ("VT",), ("",), (None,), ("nowhere",)], "state string")
    got = [tuple(r) for r in view.view_of(asked, view.state_extent(points, dims.states(spark))).collect()]
    assert {g[0]: g[1:] for g in got if g[0] != "TX"} == {x: view.DEFAULT_VIEW for x in ("VT", "", None, "nowhere")}
    assert next(g for g in got if g[0] == "TX")[1:3] == (-98.0, 31.0)


def joined(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_one_sorted_array_of_any_size(spark, tmp_path):
    """Part files in a row are one array: repeated rows, null keys, no rows, one row."""
    ids = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"), F.when(F.col("id") % 10 > 0, "x,]\n").alias("v"))
    both = ids.unionByName(spark.createDataFrame([(None, "n"), (None, "n"), (999, "z"), (999, "z")], "k long, v string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, df in (("many", both), ("one", both.filter("v = 'z'")), ("none", both.limit(0))):
            writers.write_json_array(df, "k", str(tmp_path / name))
            got, want = json.loads(joined(tmp_path / name)), [r.asDict() for r in df.collect()]
            assert [x["k"] for x in got] == sorted((x["k"] for x in want), key=lambda k: (k is not None, k))
            assert sorted(map(str, got)) == sorted(map(str, want))
        assert len(list((tmp_path / "many").glob("part-*"))) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_streamed_digests(spark, tmp_path):
    """Files of many ranges, byte-order marks, line ends or none at the end, and bytes that are no text."""
    rng = random.Random(6)
    data = [b"\n", b"x", b"a\nb", b"a\nb\n", b"\n\n", b"\xef\xbb\xbfmark\n" * 40, b"\xef\xbb\xbf", b"\xff\x00\r\n" * 300, bytes(rng.randrange(256) for _ in range(9000))]
    (tmp_path / "d").mkdir()
    for k, b in enumerate(data):
        (tmp_path / "d" / f"{k}.bin").write_bytes(b)
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for large in (0, 4, 10**9):
            got = {int(r.path.rpartition("/")[2][:-4]): (r.length, r.sha256) for r in digests.file_digests(spark, f"file://{tmp_path}/d", "*.bin", large).collect()}
            assert got == {k: (len(b), hashlib.sha256(b).hexdigest()) for k, b in enumerate(data)}, large
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_upsert_rewrites_only_what_it_touches(spark, tmp_path):
    path, keys = f"{tmp_path}/table", ["k"]
    table = spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    records.create_buckets(table, path, keys, 16)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "table").glob("bucket=*/*.parquet")}
    before, new = files(), spark.createDataFrame([(5, "new"), (1000, "new"), (None, "null")], "k long, v string")
    for _ in range(2):  # a second run changes nothing
        records.upsert_buckets(new, path, keys, 16)
        got = {r.k: r.v for r in records.read_buckets(spark, path).collect()}
        assert got == {k: "old" for k in range(400) if k != 5} | {5: "new", 1000: "new"} | {None: "null"}
    assert records.read_buckets(spark, path).count() == 402
    kept = before.items() & files().items()
    assert len(kept) >= 13 and len(before) == 16
    records.upsert_buckets(new.limit(0), path, keys, 16)
    assert records.read_buckets(spark, path).count() == 402


def test_difference_by_digests(spark):
    old = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("v"))
    new = old.filter("k <> 17 and k <> 2999").withColumn("v", F.when(F.col("k") == 40, "x").when(F.col("k") == 49, "now a value").otherwise(F.col("v"))).unionByName(spark.createDataFrame([(9000, "n"), (None, "n")], "k long, v string"))
    want = {tuple(r) for r in records.snapshot_diff(old, new, "k", ["v"]).collect()}
    assert len(want) == 6
    for levels in ((2,), (3, 6, 12), records.LEVELS):
        assert {tuple(r) for r in records.snapshot_diff_by_digests(old, new, "k", ["v"], levels).collect()} == want
    same = records.snapshot_diff_by_digests(old, old.repartition(5), "k", ["v"])
    assert same.count() == 0
    assert {r.change for r in records.snapshot_diff_by_digests(old.limit(0), new, "k", ["v"]).collect()} == {"added"}


def rows_scanned(spark, df):
    """Rows that the scans of a plan give."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves, found = plan.collectLeaves(), []
    while not leaves.isEmpty():
        if leaves.head().nodeName().startswith("Scan parquet"):
            found.append(leaves.head().metrics().apply("numOutputRows").value())
        leaves = leaves.tail()
    return found


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    table = spark.range(40_000).select(F.format_string("%06d", F.col("id") * 7919 % 40_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), "id")
    path = f"file://{tmp_path}/t"
    lookup.write_lookup(table, "k", path, group_bytes=1 << 14)
    for keys_, most in ((["000123"], 3000), (["000123", "039999", "none", None, "000123"], 9000), ([f"{i:06d}" for i in range(20_000, 20_500)], 6000), ([], 0)):
        keys = spark.createDataFrame([(k,) for k in keys_], "k string")
        got = lookup.lookup(spark, path, keys, "k")
        held = {r.k: r.v for r in table.filter(F.col("k").isin([k for k in keys_ if k])).collect()}
        assert sorted((str(r.k), r.v, r.found) for r in got.collect()) == sorted((str(k), held.get(k), k in held) for k in keys_)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            scanned = rows_scanned(spark, lookup.rows_of_keys(spark, path, keys, "k"))
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        assert scanned or not held
        assert sum(scanned) <= most, (keys_[:3], scanned)
    many = table.select("k").filter("id % 2 = 0")
    assert lookup.rows_of_keys(spark, path, many, "k").count() == 20_000
    same = spark.range(5000).select(F.lit("k").alias("k"), "id")
    lookup.write_lookup(same, "k", path)
    assert lookup.rows_of_keys(spark, path, same.select("k").limit(1), "k").count() == 5000


def test_statistics_of_a_subset_from_the_cube(spark):
    rng = random.Random(9)
    rows = areas(spark, *[{"fips": f"{i:05d}", "state": rng.choice(["TX", "NY"]), "rural": rng.random() < 0.6, "n_providers": rng.choice([0, 0, 3]), "n_cah": rng.choice([0, 1]), "hpsa_primary_care": rng.random() < 0.5, "miles_to_nearest": rng.choice([None, 1.5, 20.0, 33.3, rng.randrange(900) / 10]), "population": rng.choice([None, 10, 2000])} for i in range(200)])
    half = F.col("fips") < "00100"
    cube = view.merged_cube(view.stats_cube(rows.filter(half)).unionByName(view.stats_cube(rows.filter(~half))))
    for asked in (view.AreaQuery(), view.AreaQuery(state="TX"), view.AreaQuery(rural_only=True, shortage_only=True), view.AreaQuery(state="NY", facility_only=True), view.AreaQuery(state="none")):
        want = view.national_stats(view.apply_filters(rows, asked)).drop("zero_share_text").first()
        assert view.cube_stats(cube, asked).first() == want


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from reachmap import storage

    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=context)

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://https://h"):
        with pytest.raises(RuntimeError):
            storage.shared_dir(session(master))
        assert storage.shared_dir(session(master, "s3a://b/c/")) == "s3a://b/c"
    assert storage.shared_dir(session("local[4]")).startswith("file:///")


def test_filters_commute(spark):
    df = areas(spark, *FILTER_ROWS)
    flags = ("rural_only", "facility_only", "shortage_only")
    for a, b in itertools.permutations(flags, 2):
        both = view.apply_filters(view.apply_filters(df, AreaQuery(**{a: True})), AreaQuery(**{b: True}))
        assert both.count() == view.apply_filters(df, AreaQuery(**{a: True, b: True})).count()
    assert math.isclose(sum(r.total for r in view.state_stats(df).collect()), 8)
