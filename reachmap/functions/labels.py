"""Classes, colours and texts for maps and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds (a value on a threshold is in the upper class), class labels, fill classes.
DENSITY_THRESHOLDS = (1, 3, 5)
DENSITY_LABELS = ("0", "1–2", "3–4", "5+")
DENSITY_FILLS = ("var(--color-choro-0)", "var(--color-choro-1)", "var(--color-choro-2)", "var(--color-choro-4)")
DISTANCE_THRESHOLDS = (10, 25, 50, 100)
DISTANCE_LABELS = ("<10 mi", "10–25", "25–50", "50–100", "100+")
DISTANCE_FILLS = ("var(--color-choro-4)", "var(--color-choro-3)", "var(--color-choro-2)", "var(--color-choro-1)", "var(--color-choro-0)")
MISSING_FILL, DIM_FILL = "var(--color-grid)", "var(--color-panel-hi)"

SCALES = {"density": (DENSITY_THRESHOLDS, DENSITY_LABELS, DENSITY_FILLS), "distance": (DISTANCE_THRESHOLDS, DISTANCE_LABELS, DISTANCE_FILLS)}


def step_of(value: Column, thresholds: tuple[float, ...], classes: tuple[str, ...]) -> Column:
    """Class of a value between left-closed thresholds; null for null."""
    found = F.when(value.isNull(), F.lit(None).cast("string"))
    for most, name in zip(thresholds, classes, strict=False):
        found = found.when(value < most, name)
    return found.otherwise(classes[-1])


def fill_of(metric: str, value: Column) -> Column:
    """Fill class of a map area; areas without a value get the missing fill."""
    thresholds, _, fills = SCALES[metric]
    return F.coalesce(step_of(value, thresholds, fills), F.lit(MISSING_FILL))


def grouped(value: Column) -> Column:
    """Integer with thousands separators, a dash for null."""
    return F.coalesce(F.format_number(value.cast("bigint"), 0), F.lit("—"))


def one_decimal(value: Column) -> Column:
    """One decimal, a dash for null; the value has been rounded to one decimal before."""
    return F.when(value.isNotNull(), F.format_string("%.1f", value)).otherwise("—")


def whole(value: Column) -> Column:
    """No decimals, halves up."""
    return F.floor(value + 0.5).cast("bigint").cast("string")


def percent(share: Column) -> Column:
    """Share as a percentage with one decimal."""
    return F.format_string("%.1f%%", F.rint(share * 1000) / 10)


def plural(n: Column, noun: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {noun}"), F.when(n == 1, "").otherwise("s"))
