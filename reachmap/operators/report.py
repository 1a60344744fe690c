"""Report and card rows of each area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import grouped, one_decimal, plural, whole

# The wording of sentences, notes and tags in this module.


def area_reports(areas: DataFrame, states: DataFrame, noun: str = "provider", keep: tuple[str, ...] = ()) -> DataFrame:
    """Tiles, warning flags and the sentence of each area's report, and the columns to ``keep``."""
    named = areas.join(F.broadcast(states.select("state", "state_name")), "state", "left")  # 51 rows
    miles, none = F.coalesce("miles_to_nearest", F.lit(0.0)), F.col("n_providers") == 0
    without = F.concat("county", F.lit(f" County has no {noun} with a primary practice ZIP in the county."))
    sentence = (
        F.when(none & (miles >= 30), F.concat(without, F.lit(" The nearest is approximately "), whole(miles), F.lit(" miles away.")))
        .when(none, without)
        .otherwise(F.concat("county", F.lit(" County has "), plural(F.col("n_providers"), noun), F.lit(" with primary practice ZIPs inside the county.")))
    )
    return named.select(
        "fips", "state", F.coalesce("state_name", "state").alias("state_name"), "county",
        F.col("n_providers").cast("string").alias("providers_text"), one_decimal(F.col("miles_to_nearest")).alias("miles_text"),
        grouped(F.col("population")).alias("population_text"),
        F.coalesce(F.concat(F.lit("$"), F.format_number("median_hh_income", 0)), F.lit("—")).alias("income_text"),
        F.when(F.col("hpsa_primary_care"), "Designated").otherwise("—").alias("shortage_text"), one_decimal(F.col("disease_measure")).alias("measure_text"),
        F.coalesce(F.concat(F.col("rucc_2023").cast("string"), F.lit(" · "), F.when(F.col("rural"), "Rural").otherwise("Urban")), F.lit("—")).alias("rurality_text"),
        none.alias("warn_none"), (miles >= 50).alias("warn_miles_report"), ((miles >= 50) & none).alias("warn_miles_panel"), (F.col("n_cah") > 0).alias("warn_facility"),
        F.col("hpsa_primary_care").alias("warn_shortage"), sentence.alias("narrative"), *keep,
    )


def area_cards(areas: DataFrame, states: DataFrame, noun: str = "provider", keep: tuple[str, ...] = ()) -> DataFrame:
    """Title, subtitle, tag, and the sentences for metadata and screen readers of each area, and the columns to ``keep``."""
    named = areas.join(F.broadcast(states.select("state", "state_name")), "state", "left")  # 51 rows
    miles, n = F.col("miles_to_nearest"), plural(F.col("n_providers"), noun)
    tag = F.when(F.col("n_providers") == 0, f"ZERO {noun.upper()}S").when(F.col("hpsa_primary_care"), "HPSA · PRIMARY CARE").when(F.col("rural"), "RURAL COUNTY").otherwise("COUNTY REPORT")
    return named.select(
        "fips", F.concat("county", F.lit(" County, "), F.coalesce("state_name", "state")).alias("title"),
        F.concat(n, F.lit(" · "), F.coalesce(F.concat(whole(miles), F.lit(" mi to nearest")), F.lit("—"))).alias("subtitle"), tag.alias("tag"),
        F.concat("county", F.lit(" County access summary. "), F.col("n_providers").cast("string"), F.lit(f" {noun}s; "), F.when(miles.isNotNull(), F.format_string("%.1f", miles)).otherwise("n/a"), F.lit(" miles to nearest.")).alias("description"),
        F.concat("county", F.lit(", "), "state", F.lit(". "), n, F.lit(".")).alias("spoken"), *keep,
    )
