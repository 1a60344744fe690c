"""The area table, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import assign, dims, records
from ..operators.nearest import nearest_miles
from .fixtures import fixture

#: The specialty codes that count as the service.
CODES = ["T1", "T7", "T13", "T19", "T25", "T31", "T37"]
SLOTS = 5


class Inputs:
    """The parts of the area table over the tables of one folder; each call builds a plan, nothing runs."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name)

    def providers(self) -> DataFrame:
        return assign.providers(self.raw("fx_provider"), CODES, SLOTS)

    def primary(self) -> DataFrame:
        return assign.primary_area(self.raw("fx_crosswalk"), "zcta", "county_geoid", "poppt")

    def assigned(self) -> DataFrame:
        return assign.provider_areas(self.providers(), self.primary())

    def providers_by_area(self) -> DataFrame:
        return assign.providers_by_area(self.assigned())

    def facilities_by_area(self) -> DataFrame:
        return assign.facilities_by_area(assign.facilities(self.raw("fx_hospital")), self.primary())

    def shortage(self) -> DataFrame:
        return dims.shortage_areas(self.raw("fx_hpsa"))

    def census(self) -> DataFrame:
        return dims.census(self.raw("fx_acs"))

    def rurality(self) -> DataFrame:
        return dims.rurality(self.raw("fx_rucc"))

    def measure(self) -> DataFrame:
        return dims.measure(self.raw("fx_cdc"))

    def area_points(self) -> DataFrame:
        return dims.centroids(self.raw("fx_county_gaz"), "fips", "county_lat", "county_lng")

    def zip_points(self) -> DataFrame:
        return dims.centroids(self.raw("fx_zcta_gaz"), "zcta", "lat", "lng")

    def parts(self) -> tuple[DataFrame, ...]:
        return self.census(), self.rurality(), self.providers_by_area(), self.facilities_by_area(), self.shortage(), self.measure(), self.area_points()

    def merged(self) -> DataFrame:
        """The wide row of each area, equal ones counted in the joins."""
        return records.expanded(dims.merge_counted(*self.parts(), with_points=True))

    def provider_points(self) -> DataFrame:
        """Centroids of the postal codes that have a provider; one row a code, before the join."""
        zips = self.providers().select("zip5").dropna().distinct()
        return zips.join(self.zip_points().withColumnRenamed("zcta", "zip5"), "zip5").select("lat", "lng")

    def nearest(self, **tree) -> DataFrame:
        return nearest_miles(self.area_points(), self.provider_points(), "fips", "county_lat", "county_lng", "lat", "lng", "miles_to_nearest", required=True, **tree)

    def atlas(self) -> DataFrame:
        """Final record of each area with a centroid."""
        return records.expanded(self.counted_atlas())

    def counted_atlas(self) -> DataFrame:
        """The records of ``atlas`` with ``n``, how many equal ones there are; for what can be done before they are multiplied."""
        return dims.merge_counted(*self.parts()).join(self.nearest(), "fips", "left").select(
            "fips", "state", "county", "population", "median_hh_income", "rucc_2023", "rural", "n_providers", "miles_to_nearest", "n_hospitals", "n_cah", "hpsa_primary_care", "disease_measure", "n",
        )
