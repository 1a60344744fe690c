"""The queries as SQL for DuckDB, over the base tables only: inputs and shared steps are common table expressions."""

from __future__ import annotations

import re

from ..functions import labels
from ..functions.geo import EARTH_MILES
from ..operators import dims, view
from . import files
from .atlas import CODES, SLOTS
from .fixtures import VIEWS, duckdb_view


def _pad(x: str, width: int = 5) -> str:
    s = rf"regexp_replace(trim({x}), '\.0$', '')"
    return f"CASE WHEN length({s}) < {width} THEN lpad({s}, {width}, '0') ELSE {s} END"


def _zip(x: str) -> str:
    return f"substring({_pad(x)}, 1, 5)"


def _num(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$') THEN TRY_CAST({x} AS DOUBLE) END"


def _round(x: str, decimals: int) -> str:
    return f"round_even({x} * 1e{decimals}, 0) / 1e{decimals}"


def _step(x: str, thresholds: tuple, classes: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {x} < {most} THEN '{c}'" for most, c in zip(thresholds, classes, strict=False))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE '{classes[-1]}' END"


def _whole(x: str) -> str:
    return f"CAST(CAST(floor({x} + 0.5) AS BIGINT) AS VARCHAR)"


def _plural(n: str, noun: str = "provider") -> str:
    return f"concat({n}, ' {noun}', CASE WHEN {n} = 1 THEN '' ELSE 's' END)"


_codes = ", ".join(f"'{c}'" for c in CODES)
_slot = lambda i, extra="": f"WHEN code_{i} IN ({_codes}){extra} THEN code_{i}"
_picked = f"""coalesce(CASE {" ".join(_slot(i, f" AND upper(switch_{i}) = 'Y'") for i in range(1, SLOTS + 1))} END,
    CASE {" ".join(_slot(i) for i in range(1, SLOTS + 1))} END)"""
_states = ", ".join(f"('{a}', '{p}', '{n}')" for a, p, n in dims.STATE_ROWS)

STEPS: dict[str, str] = {name: duckdb_view(name) for name in VIEWS} | {
    "states": f"SELECT * FROM (VALUES {_states}) t(state, prefix, state_name)",
    "providers": f"SELECT * FROM (SELECT npi, {_picked} AS code, {_zip('postal')} AS zip5 FROM fx_provider WHERE entity_type = '1') WHERE code IS NOT NULL",
    "primary_area": f"""SELECT zcta, fips FROM (SELECT *, row_number() OVER (PARTITION BY zcta ORDER BY weight DESC, fips) AS place
  FROM (SELECT {_zip('zcta')} AS zcta, {_pad('county_geoid')} AS fips, coalesce({_num('poppt')}, 0) AS weight FROM fx_crosswalk)) WHERE place = 1""",
    "assigned": "SELECT npi, fips, zip5 FROM providers JOIN primary_area ON zip5 = zcta",
    "providers_by_area": "SELECT fips, count(DISTINCT npi) AS n_providers FROM assigned GROUP BY fips",
    "facilities_by_area": f"""SELECT fips, count(ccn) AS n_hospitals, count(*) FILTER (coalesce(lower(hospital_type) LIKE '%critical access%', false)) AS n_cah
  FROM (SELECT ccn, {_zip('zip')} AS zip5, hospital_type FROM fx_hospital) JOIN primary_area ON zip5 = zcta GROUP BY fips""",
    "shortage": f"SELECT DISTINCT {_pad('county_fips')} AS fips, true AS hpsa_primary_care FROM fx_hpsa WHERE lower(trim(status)) IN ('designated', 'proposed for withdrawal')",
    "census": rf"""SELECT concat(lpad(state, 2, '0'), lpad(county, 3, '0')) AS fips, substring(name, strpos(name, ', ') + 2) AS state_name,
    regexp_replace(substring(name, 1, strpos(name, ', ') - 1), '{dims.AREA_SUFFIX}', '') AS county_name,
    {_num('pop')} AS population, {_num('income')} AS median_hh_income FROM fx_acs""",
    "rurality": f"SELECT {_pad('fips')} AS fips, TRY_CAST(value AS INTEGER) AS rucc_2023, TRY_CAST(value AS INTEGER) >= 4 AS rural FROM fx_rucc WHERE attribute = 'RUCC_2023' AND value IS NOT NULL",
    "measured": f"SELECT {_pad('locationid')} AS fips, {_round(_num('data_value'), 2)} AS disease_measure, coalesce(year, '2024') AS data_years FROM fx_cdc WHERE {_num('data_value')} IS NOT NULL",
    "area_points": f"SELECT {_pad('geoid')} AS fips, lat::DOUBLE AS county_lat, lng::DOUBLE AS county_lng FROM fx_county_gaz",
    "zip_points": f"SELECT {_pad('geoid')} AS zcta, lat::DOUBLE AS lat, lng::DOUBLE AS lng FROM fx_zcta_gaz",
    "merged": f"""SELECT c.fips, s.state, c.county_name AS county, CAST(c.population AS BIGINT) AS population, CAST(c.median_hh_income AS BIGINT) AS median_hh_income,
    r.rucc_2023, coalesce(r.rural, false) AS rural, coalesce(p.n_providers, 0) AS n_providers, coalesce(f.n_hospitals, 0) AS n_hospitals, coalesce(f.n_cah, 0) AS n_cah,
    coalesce(h.hpsa_primary_care, false) AS hpsa_primary_care, {_round('m.disease_measure', 1)} AS disease_measure, g.county_lat, g.county_lng
  FROM census c JOIN states s ON substring(c.fips, 1, 2) = s.prefix LEFT JOIN rurality r ON c.fips = r.fips LEFT JOIN providers_by_area p ON c.fips = p.fips
    LEFT JOIN facilities_by_area f ON c.fips = f.fips LEFT JOIN shortage h ON c.fips = h.fips LEFT JOIN measured m ON c.fips = m.fips LEFT JOIN area_points g ON c.fips = g.fips""",
    "provider_points": "SELECT DISTINCT lat, lng FROM zip_points WHERE zcta IN (SELECT zip5 FROM providers)",
    "provider_xyz": "SELECT cos(radians(lat)) * cos(radians(lng)) AS px, cos(radians(lat)) * sin(radians(lng)) AS py, sin(radians(lat)) AS pz FROM provider_points",
    "area_xyz": "SELECT fips, cos(radians(county_lat)) * cos(radians(county_lng)) AS qx, cos(radians(county_lat)) * sin(radians(county_lng)) AS qy, sin(radians(county_lat)) AS qz FROM area_points",
    "nearest": f"""SELECT fips, {_round(f'(2 * {EARTH_MILES} * asin(least(2.0, sqrt(d2)) / 2))', 1)} AS miles_to_nearest
  FROM (SELECT fips, min(pow(qx - px, 2) + pow(qy - py, 2) + pow(qz - pz, 2)) AS d2 FROM area_xyz, provider_xyz GROUP BY fips)""",
    "atlas": """SELECT m.fips, state, county, population, median_hh_income, rucc_2023, rural, n_providers, miles_to_nearest, n_hospitals, n_cah, hpsa_primary_care, disease_measure
  FROM merged m LEFT JOIN nearest n ON m.fips = n.fips WHERE county_lat IS NOT NULL AND county_lng IS NOT NULL""",
    "pages_of_sites": "SELECT url, html, regexp_extract(url, '://([^/?#]*)', 1) AS site, coalesce(TRY_CAST(regexp_extract(url, '/(\\d+)', 1) AS BIGINT), 0) AS number FROM pages",
}

_stats = """count(*) AS total, count(*) FILTER (n_providers = 0) AS zero_providers, coalesce(count(*) FILTER (n_providers = 0) / nullif(count(*), 0)::DOUBLE, 0) AS zero_share,
  coalesce(percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN rural THEN miles_to_nearest END DESC), 0) AS median_rural_miles,
  count(*) FILTER (n_cah > 0 AND coalesce(miles_to_nearest, 0) >= 20) AS facility_far, CAST(coalesce(sum(population) FILTER (n_providers = 0), 0) AS BIGINT) AS population_underserved"""
_miles0, _none = "coalesce(miles_to_nearest, 0)", "n_providers = 0"
_without = "concat(county, ' County has no provider with a primary practice ZIP in the county.')"
_view = lambda i, otherwise: "CASE state " + " ".join(f"WHEN '{s}' THEN {v[i]}" for s, v in view.VIEW_OVERRIDES.items()) + f" ELSE {otherwise} END"
_one = lambda x: f"coalesce(format('{{:.1f}}', {x}), '—')"
_group = lambda x: f"format('{{:,}}', {x})"


def _histogram(metric: str, value: str) -> str:
    thresholds, names, fills = labels.SCALES[metric]
    legend = ", ".join(f"({i}, '{n}', '{f}')" for i, (n, f) in enumerate(zip(names, fills, strict=True)))
    return f"""SELECT l.place, l.label, l.fill, coalesce(c.n, 0) AS n FROM (VALUES {legend}) l(place, label, fill)
  LEFT JOIN (SELECT {_step(value, thresholds, names)} AS label, count(*) AS n FROM atlas GROUP BY 1) c ON l.label = c.label"""


FINAL: dict[str, str] = {
    "q01_pick_code": "SELECT * FROM providers",
    "q02_pick_code_long": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem WHERE l_partkey IN
  (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#13'))) WHERE place = 1""",
    "q03_primary_area": "SELECT * FROM primary_area",
    "q04_providers_by_area": "SELECT * FROM providers_by_area",
    "q04b_total": "SELECT CAST(sum(n_providers) AS BIGINT) AS n_providers FROM providers_by_area",
    "q05_facilities_by_area": "SELECT * FROM facilities_by_area",
    "q06_shortage_areas": "SELECT c.fips, h.fips IS NOT NULL AS hpsa_primary_care FROM census c LEFT JOIN shortage h ON c.fips = h.fips",
    "q06b_shortage_keys": "SELECT * FROM shortage ORDER BY fips",
    "q07_census_parse": "SELECT * FROM census",
    "q08_rurality": "SELECT * FROM rurality",
    "q09_measure": "SELECT * FROM measured",
    "q10_merge_areas": "SELECT * FROM merged",
    "q11_nearest_provider": "SELECT * FROM nearest",
    "q12_area_atlas": "SELECT * FROM atlas ORDER BY fips",
    "q13a_filter_none": "SELECT * FROM atlas",
    "q13b_filter_state": "SELECT * FROM atlas WHERE state = 'ND'",
    "q13c_filter_rural": "SELECT * FROM atlas WHERE rural",
    "q13d_filter_facility": "SELECT * FROM atlas WHERE n_cah <> 0",
    "q13e_filter_shortage": "SELECT * FROM atlas WHERE hpsa_primary_care",
    "q13f_filter_stacked": "SELECT * FROM atlas WHERE state = 'ND' AND rural AND hpsa_primary_care",
    "q14_national_stats": f"SELECT *, concat(format('{{:.1f}}', round_even(zero_share * 1000, 0) / 10), '%') AS zero_share_text FROM (SELECT {_stats} FROM atlas)",
    "q15_state_stats": f"SELECT state, {_stats} FROM atlas GROUP BY ROLLUP (state)",
    "q16_density_histogram": _histogram("density", "n_providers"),
    "q17_distance_histogram": _histogram("distance", "miles_to_nearest"),
    "q18_map_layer": f"""SELECT c.fips, c.fips LIKE '48%' AS in_state, CASE WHEN c.fips NOT LIKE '48%' THEN '{labels.DIM_FILL}' WHEN v IS NULL THEN '{labels.MISSING_FILL}'
    ELSE {_step('v', labels.DISTANCE_THRESHOLDS, labels.DISTANCE_FILLS)} END AS fill, CASE WHEN c.fips LIKE '48%' THEN 1.0 ELSE 0.35 END::DOUBLE AS opacity,
    CASE WHEN c.fips LIKE '48%' THEN label END AS label
  FROM census c LEFT JOIN (SELECT fips, miles_to_nearest AS v, county || ', ' || state AS label FROM atlas WHERE rural) a ON c.fips = a.fips""",
    "q19_area_report": f"""SELECT fips, a.state, coalesce(state_name, a.state) AS state_name, county, CAST(n_providers AS VARCHAR) AS providers_text,
    {_one('miles_to_nearest')} AS miles_text, coalesce({_group('population')}, '—') AS population_text, coalesce('$' || {_group('median_hh_income')}, '—') AS income_text,
    CASE WHEN hpsa_primary_care THEN 'Designated' ELSE '—' END AS shortage_text, {_one('disease_measure')} AS measure_text,
    coalesce(CAST(rucc_2023 AS VARCHAR) || ' · ' || CASE WHEN rural THEN 'Rural' ELSE 'Urban' END, '—') AS rurality_text, {_none} AS warn_none,
    {_miles0} >= 50 AS warn_miles_report, {_miles0} >= 50 AND {_none} AS warn_miles_panel, n_cah > 0 AS warn_facility, hpsa_primary_care AS warn_shortage,
    CASE WHEN {_none} AND {_miles0} >= 30 THEN concat({_without}, ' The nearest is approximately ', {_whole(_miles0)}, ' miles away.') WHEN {_none} THEN {_without}
      ELSE concat(county, ' County has ', {_plural('n_providers')}, ' with primary practice ZIPs inside the county.') END AS narrative
  FROM atlas a LEFT JOIN states s ON a.state = s.state""",
    "q20_area_card": f"""SELECT fips, concat(county, ' County, ', coalesce(state_name, a.state)) AS title,
    concat({_plural('n_providers')}, ' · ', coalesce({_whole('miles_to_nearest')} || ' mi to nearest', '—')) AS subtitle,
    CASE WHEN {_none} THEN 'ZERO PROVIDERS' WHEN hpsa_primary_care THEN 'HPSA · PRIMARY CARE' WHEN rural THEN 'RURAL COUNTY' ELSE 'COUNTY REPORT' END AS tag,
    concat(county, ' County access summary. ', n_providers, ' providers; ', coalesce(format('{{:.1f}}', miles_to_nearest), 'n/a'), ' miles to nearest.') AS description,
    concat(county, ', ', a.state, '. ', {_plural('n_providers')}, '.') AS spoken
  FROM atlas a LEFT JOIN states s ON a.state = s.state""",
    "q21_state_extent": f"""SELECT state, n_points, {_view(0, '(x0 + x1) / 2')}::DOUBLE AS center_lng, {_view(1, '(y0 + y1) / 2')}::DOUBLE AS center_lat,
    {_view(2, 'greatest(1.4, least(least(58.0::DOUBLE / greatest(0.5, x1 - x0), 24.0::DOUBLE / greatest(0.5, y1 - y0)) * 0.9::DOUBLE, 14.0))')}::DOUBLE AS zoom
  FROM (SELECT state, count(*) AS n_points, min(county_lng) AS x0, max(county_lng) AS x1, min(county_lat) AS y0, max(county_lat) AS y1
    FROM area_points JOIN states ON substring(fips, 1, 2) = prefix GROUP BY state)""",
    "q22_latest_artifact": """SELECT l.site, l.latest_url, l.number, coalesce(c.n_links, 0) AS n_links
  FROM (SELECT site, url AS latest_url, number FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY number DESC, url DESC) AS place FROM pages_of_sites) WHERE place = 1) l
  LEFT JOIN (SELECT site, count(DISTINCT link) AS n_links FROM (SELECT site, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages_of_sites) GROUP BY site) c ON l.site = c.site""",
    "q23_lineage_latest": """SELECT user_id, event_type, ts, event_id, sha256(props) AS sha256, octet_length(encode(props))::INTEGER AS bytes FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS place FROM events) WHERE place = 1""",
    "q24_pipeline_summary": """SELECT count(*) AS total, count(*) FILTER (n_providers = 0) AS zero_providers, count(*) FILTER (n_providers = 0) / nullif(count(*), 0)::DOUBLE AS zero_share,
  median(miles_to_nearest) FILTER (rural) AS median_rural_miles FROM atlas""",
    "q25_json_rows": """SELECT fips, CAST(to_json({'fips': fips, 'state': state, 'county': county, 'population': population, 'median_hh_income': median_hh_income, 'rucc_2023': rucc_2023,
    'rural': rural, 'n_providers': n_providers, 'miles_to_nearest': miles_to_nearest, 'n_hospitals': n_hospitals, 'n_cah': n_cah, 'hpsa_primary_care': hpsa_primary_care,
    'disease_measure': disease_measure}) AS VARCHAR) AS json FROM atlas""",
    "q26_lookup": """SELECT k.fips, a.* EXCLUDE (fips), a.fips IS NOT NULL AS found FROM (SELECT unnest([min(fips), max(fips), '99999']) AS fips FROM atlas) k LEFT JOIN atlas a ON k.fips = a.fips""",
    "q27_first_match": "SELECT conv_id, arg_min(text, turn) FILTER (role = 'assistant') AS first_assistant, count(*)::INTEGER AS n_turns FROM conversations GROUP BY conv_id",
    "q28_provider_locations": "SELECT DISTINCT * FROM assigned",
    "q29_largest_match": """SELECT p_brand, p_partkey, p_name, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place
  FROM part WHERE lower(p_name) LIKE '%widget%' AND lower(p_name) NOT LIKE '%small%') WHERE place = 1""",
    "q30_union_sources": """SELECT 'supplier' AS kind, s_suppkey AS party, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier
  UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
    "q31_snapshot_diff": """SELECT p_partkey, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM (SELECT p_partkey, p_partkey AS k, p_name, p_retailprice FROM part WHERE p_partkey % 10 <> 0) o
  FULL JOIN (SELECT p_partkey, p_partkey AS k, p_name, CASE WHEN p_partkey % 7 = 0 THEN p_retailprice + 1.0 ELSE p_retailprice END AS p_retailprice FROM part WHERE p_partkey % 10 <> 1) n USING (p_partkey)
  WHERE o.k IS NULL OR n.k IS NULL OR o.p_name IS DISTINCT FROM n.p_name OR o.p_retailprice IS DISTINCT FROM n.p_retailprice""",
    "q32_haversine": f"""SELECT {_pad('geoid')} AS fips, {_round(f'(2 * {EARTH_MILES} * asin(sqrt(pow(sin((radians(39.8::DOUBLE) - radians(lat::DOUBLE)) / 2), 2) + cos(radians(lat::DOUBLE)) * cos(radians(39.8::DOUBLE)) * pow(sin((radians(-98.6::DOUBLE) - radians(lng::DOUBLE)) / 2), 2))))', 3)} AS miles FROM fx_county_gaz""",
    "q33_latest_artifact_name": """SELECT site, concat('https://example.org/', ltrim(link, './')) AS link FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY y DESC, m DESC, v DESC, link DESC) AS place
  FROM (SELECT DISTINCT o_custkey % 500 AS site, year(o_orderdate) AS y, month(o_orderdate) AS m, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 12 END AS v,
    concat('./dump_', monthname(o_orderdate), '_', year(o_orderdate), CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('_V', o_orderkey % 12) END, '.zip') AS link
    FROM orders WHERE o_orderkey % 7 <> 0
    UNION ALL SELECT DISTINCT o_custkey % 500, 0, 0, 0, './other.html' FROM orders)) WHERE place = 1""",
    "q34_upsert": """WITH runs AS (SELECT user_id, event_type, event_id, value, event_id % 2 AS run FROM events),
  latest AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY run, user_id, event_type ORDER BY event_id DESC) AS place FROM runs) WHERE place = 1)
  SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY run DESC) AS newest FROM latest) WHERE newest = 1""",
    "q35_manifest": f"""SELECT 'land' AS script, 'customers' AS source, batch, sha256(value || chr(10)) AS sha256, octet_length(encode(value)) + 1 AS bytes, '2024-02-01T00:00:00Z' AS fetched_at
  FROM (SELECT c_custkey // {files.JSON_FILE_ROWS} AS batch, string_agg(c_name, ',' ORDER BY c_name) AS value FROM customer GROUP BY 1)""",
    "q36_registry_file": "SELECT * FROM providers",
    "q37_facility_file": "SELECT * FROM facilities_by_area",
    "q38_measure_file": "SELECT * FROM measured",
    "q39_census_file": "SELECT * FROM census",
    "q40_rurality_file": "SELECT * FROM rurality",
    "q41_shortage_file": "SELECT * FROM shortage",
    "q42_crosswalk_file": "SELECT * FROM primary_area",
    "q43_gazetteer_file": "SELECT * FROM area_points WHERE CAST(fips AS INTEGER) % 50 <> 0",
    "q44_area_export": "SELECT * FROM atlas",
    "q45_pushdown": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40 AND l_returnflag = 'R'",
    "q46_counters": """SELECT count(*) AS n_rows, count(ccn) AS with_id, count(*) FILTER (coalesce(lower(hospital_type) LIKE '%critical access%', false)) AS of_kind, count(*) AS kept FROM fx_hospital""",
    "q48_areas_within": """SELECT fips, true AS inside FROM census WHERE fips IN (SELECT fips FROM shortage)
  UNION ALL SELECT fips, false FROM census WHERE fips NOT IN (SELECT fips FROM shortage)""",
    "q49_state_codes": "SELECT c_custkey, lpad(trim(state), 2, '0') AS state_code FROM fx_acs",
    "q50_nearest_by_wide_cubes": "SELECT * FROM nearest",
    "q51_stream_latest": """SELECT user_id, event_type, event_id, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS place FROM events) WHERE place = 1""",
    "q52_stream_providers": "SELECT * FROM providers",
}
FINAL["q47_state_view"] = f"""SELECT a.state, coalesce(center_lng, {view.DEFAULT_VIEW[0]})::DOUBLE AS center_lng, coalesce(center_lat, {view.DEFAULT_VIEW[1]})::DOUBLE AS center_lat, coalesce(zoom, {view.DEFAULT_VIEW[2]})::DOUBLE AS zoom
  FROM (SELECT state FROM states UNION ALL SELECT DISTINCT c_mktsegment FROM customer) a LEFT JOIN ({FINAL["q21_state_extent"]}) e ON a.state = e.state"""
FINAL["q54_upsert_buckets"] = FINAL["q34_upsert"]
_wheres = {"q13a_filter_none": "true", "q13b_filter_state": "state = 'ND'", "q13c_filter_rural": "rural", "q13d_filter_facility": "n_cah <> 0", "q13e_filter_shortage": "hpsa_primary_care", "q13f_filter_stacked": "state = 'ND' AND rural AND hpsa_primary_care"}
FINAL["q55_subset_stats"] = " UNION ALL ".join(f"SELECT '{name}' AS filter, {_stats} FROM atlas WHERE {where}" for name, where in _wheres.items())
FINAL["q56_diff_by_digests"] = FINAL["q31_snapshot_diff"]
FINAL["q53_json_array"] = f"""SELECT concat(CASE WHEN place = 1 THEN '[' ELSE ',' END, json, CASE WHEN place = total THEN ']' ELSE '' END) AS line
  FROM (SELECT json, row_number() OVER (ORDER BY fips, json) AS place, count(*) OVER () AS total FROM ({FINAL["q25_json_rows"]}))"""
FINAL["q57_streamed_manifest"] = """SELECT c_nationkey::BIGINT AS nation, octet_length(encode(value)) AS bytes, sha256(value) AS sha256
  FROM (SELECT c_nationkey, string_agg(c_name || chr(10), '' ORDER BY c_custkey) AS value FROM customer GROUP BY 1)"""
FINAL["q60_lookup_by_key"] = """SELECT k.fips, a.* EXCLUDE (fips), a.fips IS NOT NULL AS found FROM (SELECT unnest([min(fips), max(fips), '99999']) AS fips FROM atlas
  UNION SELECT fips FROM atlas WHERE fips LIKE '%7') k LEFT JOIN atlas a ON k.fips = a.fips"""
FINAL["q58_area_array"] = "SELECT * FROM atlas"
FINAL["q59_report_files"] = FINAL["q19_area_report"]


def _needs(sql: str) -> set[str]:
    return {n for n in STEPS if re.search(rf"\b{n}\b", sql)}


def _with_steps(sql: str) -> str:
    """``sql`` with the steps it needs, directly or not, in their order."""
    needed, open_ = set(), _needs(sql)
    while open_:
        needed |= open_
        open_ = set().union(*(_needs(STEPS[n]) for n in open_)) - needed
    ctes = ",\n".join(f"{n} AS ({STEPS[n]})" for n in STEPS if n in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql


ORACLE_SQL = {name: _with_steps(sql) for name, sql in FINAL.items()}
