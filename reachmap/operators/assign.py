"""Providers and facilities, and the areas they belong to."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import contains_fold, pad_key, pad_zip, to_number


def pick_code(slots: list[tuple[Column, Column]], codes: list[str], primary: str = "Y") -> Column:
    """Code of a record with repeated (code, switch) slots.

    The first slot whose code is wanted and whose switch is ``primary`` in either
    case; else the first wanted code; else null.
    """
    pairs = F.array(*[F.struct(code.alias("code"), switch.alias("switch")) for code, switch in slots])
    wanted = F.filter(pairs, lambda s: s["code"].isin(*codes))
    ranked = F.transform(wanted, lambda s, i: F.struct(F.when(F.upper(s["switch"]) == primary.upper(), 0).otherwise(1).alias("rank"), i.alias("slot"), s["code"].alias("code")))
    return F.array_min(ranked)["code"]


def pick_code_long(rows: DataFrame, key: str, code: str, codes: DataFrame, preferred: Column, order: list[str]) -> DataFrame:
    """The same choice where slots are rows: per key the first wanted row, preferred ones before others."""
    wanted = rows.join(codes, code, "left_semi")
    rest = [c for c in rows.columns if c not in {key, *order}]
    # the least struct of each key: combined before the shuffle, no sort of a group
    first = F.min(F.struct(F.when(preferred, 0).otherwise(1).alias("rank"), *order, *rest)).alias("first")
    return wanted.groupBy(key).agg(first).select(*[F.col(c if c == key else f"first.{c}").alias(c) for c in rows.columns])


def providers(registry: DataFrame, codes: list[str], slots: int, individual: str = "1", keep: tuple[str, ...] = ()) -> DataFrame:
    """(npi, code, zip5, *keep): individuals with a wanted code.

    Whether any slot has one is asked first, in plain comparisons; the choice among
    slots is made for the rows that are left.
    """
    wanted = reduce(or_, [F.coalesce(F.col(f"code_{i}").isin(*codes), F.lit(False)) for i in range(1, slots + 1)])
    chosen = pick_code([(F.col(f"code_{i}"), F.col(f"switch_{i}")) for i in range(1, slots + 1)], codes)
    return registry.filter(F.col("entity_type") == individual).filter(wanted).select("npi", chosen.alias("code"), pad_zip(F.col("postal")).alias("zip5"), *keep)


def primary_area(crosswalk: DataFrame, zip_col: str, area_col: str, weight_col: str | None) -> DataFrame:
    """(zcta, fips): the area with the greatest weight of each postal area, the least key on ties; no weight counts 0."""
    weight = F.coalesce(to_number(F.col(weight_col)), F.lit(0.0)) if weight_col else F.lit(1.0)
    rows = crosswalk.select(pad_zip(F.col(zip_col)).alias("zcta"), pad_key(F.col(area_col)).alias("fips"), weight.alias("weight"))
    # least (-weight, fips) as one aggregate: combined before the shuffle, no sort of a group
    best = rows.filter("zcta is not null").groupBy("zcta").agg(F.min(F.struct((-F.col("weight")).alias("w"), "fips")).alias("best"))
    return best.select("zcta", F.col("best.fips").alias("fips"))


def provider_areas(providers: DataFrame, primary: DataFrame) -> DataFrame:
    """(npi, fips, zip5) of providers whose postal code has an area."""
    return providers.join(primary, providers["zip5"] == primary["zcta"]).select("npi", "fips", "zip5")


def providers_by_area(assigned: DataFrame) -> DataFrame:
    """(fips, n_providers): distinct providers."""
    return assigned.groupBy("fips").agg(F.count_distinct("npi").alias("n_providers"))


def facilities(raw: DataFrame, kind: str = "critical access") -> DataFrame:
    """(ccn, zip5, is_kind) of facilities; ``kind`` is looked for in the type in either case."""
    return raw.select("ccn", pad_zip(F.col("zip")).alias("zip5"), contains_fold(F.col("hospital_type"), kind).alias("is_kind"))


def facilities_by_area(places: DataFrame, primary: DataFrame) -> DataFrame:
    """(fips, n_hospitals, n_cah): facilities with an id, and those of the kind."""
    joined = places.join(primary, places["zip5"] == primary["zcta"])
    return joined.groupBy("fips").agg(F.count("ccn").alias("n_hospitals"), F.count_if("is_kind").alias("n_cah"))
