"""Filters, statistics and map layers over the area table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import DIM_FILL, MISSING_FILL, SCALES, fill_of, percent, step_of
from ..storage import written
from .dims import STATE_ROWS

PREFIX_OF = {abbreviation: prefix for abbreviation, prefix, _ in STATE_ROWS}


@dataclass(frozen=True)
class AreaQuery:
    """What a user can ask of the area table; an empty state is no filter."""

    state: str | None = None
    rural_only: bool = False
    facility_only: bool = False
    shortage_only: bool = False
    metric: str = "density"
    selected: str | None = None

    def __post_init__(self) -> None:
        if self.metric not in SCALES:
            raise ValueError(f"no such metric: {self.metric}")

    @classmethod
    def of(cls, parameters: dict[str, str]) -> AreaQuery:
        """From text parameters, with defaults for what is absent or not understood."""
        on = lambda k: parameters.get(k) == "1"
        metric = parameters.get("metric")
        return cls(parameters.get("state") or None, on("rural"), on("cah"), on("hpsa"), metric if metric in SCALES else "density", parameters.get("fips") or None)

    def predicates(self, with_state: bool = True) -> list[Column]:
        asked = [
            (with_state and bool(self.state), F.col("state") == self.state),
            (self.rural_only, F.col("rural")),
            (self.facility_only, F.col("n_cah") != 0),
            (self.shortage_only, F.col("hpsa_primary_care")),
        ]
        return [p for wanted, p in asked if wanted]


def apply_filters(areas: DataFrame, query: AreaQuery, with_state: bool = True) -> DataFrame:
    """Rows that fit all that is asked; ``with_state=False`` gives the map's visibility mask."""
    for p in query.predicates(with_state):
        areas = areas.filter(p)
    return areas


def lookup(areas: DataFrame, keys: DataFrame) -> DataFrame:
    """The record of each key in ``keys`` (fips), nulls for keys without one, with ``found``."""
    return keys.join(areas.withColumn("found", F.lit(True)), "fips", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def _statistics() -> list[Column]:
    none = F.col("n_providers") == 0
    miles = F.when(F.col("rural"), F.col("miles_to_nearest"))
    # the upper of two middle values
    upper = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN rural THEN miles_to_nearest END DESC)")
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(none).alias("zero_providers"),
        F.coalesce(F.try_divide(F.count_if(none), F.count(F.lit(1))), F.lit(0.0)).alias("zero_share"),
        F.coalesce(F.when(F.count(miles) > 0, upper), F.lit(0.0)).alias("median_rural_miles"),
        F.count_if((F.col("n_cah") > 0) & (F.coalesce("miles_to_nearest", F.lit(0.0)) >= 20)).alias("facility_far"),
        F.coalesce(F.sum(F.when(none, F.col("population"))), F.lit(0)).alias("population_underserved"),
    ]


#: What the filters and statistics ask of an area.
CUBE_KEYS = ("state", "rural", "facility", "hpsa_primary_care", "none", "far", "miles")


def _copies(n: str | None) -> Column:
    """How many areas a row stands for: the column ``n``, or one."""
    return F.lit(1) if n is None else F.col(n)


def stats_cube(areas: DataFrame, n: str | None = None) -> DataFrame:
    """(CUBE_KEYS, n, population): areas by all that filters ask, and by distance, which has one decimal: an exact histogram.

    Its rows are bounded by 16 flags, states and tenths of miles, whatever the number of areas. Cubes of
    parts of the areas merge: ``merged_cube`` of their union is the cube of all. A row of ``areas`` stands for ``n`` of them if it has that column.
    """
    keyed = areas.select(
        "state", "rural", (F.coalesce("n_cah", F.lit(0)) > 0).alias("facility"), "hpsa_primary_care", (F.col("n_providers") == 0).alias("none"),
        (F.coalesce("miles_to_nearest", F.lit(0.0)) >= 20).alias("far"), F.when(F.col("rural"), F.col("miles_to_nearest")).alias("miles"), "population", _copies(n).alias("copies"),
    )
    return keyed.groupBy(*CUBE_KEYS).agg(F.sum("copies").alias("n"), F.sum(F.col("population") * F.col("copies")).alias("population"))


def merged_cube(cubes: DataFrame) -> DataFrame:
    """One cube of the rows of several."""
    return cubes.groupBy(*CUBE_KEYS).agg(F.sum("n").alias("n"), F.sum("population").alias("population"))


def cube_stats(cube: DataFrame, query: AreaQuery, by: tuple[str, ...] = ()) -> DataFrame:
    """The six numbers of ``national_stats`` for the areas that a query keeps, from their cube alone; for each group ``by`` some of its keys.

    The upper of two middle distances is the one at which the areas from the greatest on reach half.
    """
    kept = cube
    for asked, flag in ((query.state, F.col("state") == query.state), (query.rural_only, F.col("rural")), (query.facility_only, F.col("facility")), (query.shortage_only, F.col("hpsa_primary_care"))):
        kept = kept.filter(flag) if asked else kept
    # one row for each tenth of a mile (of a group), then one row
    parted = kept.withColumns({"none_n": F.when(F.col("none"), F.col("n")), "none_population": F.when(F.col("none"), F.col("population")), "far_n": F.when(F.col("facility") & F.col("far"), F.col("n"))})
    sums = parted.groupBy(*by, "miles").agg(*[F.sum(c).alias(c) for c in ("n", "none_n", "none_population", "far_n")])
    all_of = lambda c: F.coalesce(F.sum(c), F.lit(0))
    one = sums.groupBy(*by).agg(
        *[all_of(c).alias(c) for c in ("n", "none_n", "none_population", "far_n")],
        F.reverse(F.array_sort(F.collect_list(F.when(F.col("miles").isNotNull(), F.struct("miles", "n"))))).alias("falling"),
        all_of(F.when(F.col("miles").isNotNull(), F.col("n"))).alias("half"),
    )
    start = F.struct(F.lit(0).cast("long").alias("so_far"), F.lit(None).cast("double").alias("middle"))
    reached = lambda acc, x: 2 * (acc["so_far"] + x["n"]) >= F.col("half")
    step = lambda acc, x: F.struct((acc["so_far"] + x["n"]).alias("so_far"), F.coalesce(acc["middle"], F.when(reached(acc, x), x["miles"])).alias("middle"))
    return one.select(
        *by, F.col("n").alias("total"), F.col("none_n").alias("zero_providers"), F.coalesce(F.try_divide("none_n", "n"), F.lit(0.0)).alias("zero_share"),
        F.coalesce(F.aggregate("falling", start, step, lambda acc: acc["middle"]), F.lit(0.0)).alias("median_rural_miles"),
        F.col("far_n").alias("facility_far"), F.col("none_population").alias("population_underserved"),
    )


def national_stats(areas: DataFrame, n: str | None = None) -> DataFrame:
    """Six numbers over all rows, and the share as text; a row stands for ``n`` areas if it has that column."""
    stats = areas.agg(*_statistics()) if n is None else cube_stats(stats_cube(areas, n), AreaQuery())
    return stats.withColumn("zero_share_text", percent(F.col("zero_share")))


def state_stats(areas: DataFrame, n: str | None = None) -> DataFrame:
    """The same six for each state, and for all (state null)."""
    if n is None:
        return areas.rollup("state").agg(*_statistics()).filter(F.col("state").isNotNull() | (F.col("total") > 0))
    cube = written(stats_cube(areas, n), "cube")  # read twice
    whole = cube_stats(cube, AreaQuery()).filter(F.col("total") > 0)
    return cube_stats(cube, AreaQuery(), by=("state",)).unionByName(whole.withColumn("state", F.lit(None).cast("string")))


def pipeline_summary(areas: DataFrame, n: str | None = None) -> DataFrame:
    """Areas, those without providers, their share, and the interpolated median of rural distances; a row stands for ``n`` areas if it has that column."""
    copies = _copies(n)
    total, none = (F.coalesce(F.sum(c), F.lit(0)) for c in (copies, F.when(F.col("n_providers") == 0, copies)))
    return areas.agg(
        total.alias("total"), none.alias("zero_providers"), F.try_divide(none, total).alias("zero_share"),
        F.percentile(F.when(F.col("rural"), F.col("miles_to_nearest")), F.lit(0.5), copies).alias("median_rural_miles"),
    )


def histogram(areas: DataFrame, metric: str, n: str | None = None) -> DataFrame:
    """(place, label, fill, n): each class of the legend with its areas, empty classes too; a row stands for ``n`` areas if it has that column."""
    thresholds, labels, fills = SCALES[metric]
    value = F.col("n_providers" if metric == "density" else "miles_to_nearest")
    legend = areas.sparkSession.createDataFrame([(i, x, y) for i, (x, y) in enumerate(zip(labels, fills, strict=True))], "place int, label string, fill string")
    counts = areas.groupBy(step_of(value, thresholds, labels).alias("label")).agg(F.sum(_copies(n)).alias("n"))
    return legend.join(counts, "label", "left").select("place", "label", "fill", F.coalesce("n", F.lit(0)).alias("n"))


def map_layer(ids: DataFrame, areas: DataFrame, query: AreaQuery, n: str | None = None) -> DataFrame:
    """(fips, in_state, fill, opacity, label) for every area id; hidden and unknown areas get the missing fill.

    If a row of both tables stands for ``n``, so does one of the result, which has that column too.
    """
    value = "n_providers" if query.metric == "density" else "miles_to_nearest"
    seen = apply_filters(areas, query, with_state=False).select("fips", F.col(value).alias("v"), F.concat("county", F.lit(", "), "state").alias("label"), _copies(n).alias("copies"))
    if n is not None:
        seen = seen.groupBy("fips", "v", "label").agg(F.sum("copies").alias("copies"))
    inside = F.col("fips").startswith(PREFIX_OF.get(query.state, "-")) if query.state else F.lit(True)
    fill = F.when(F.col("v").isNull(), MISSING_FILL).otherwise(fill_of(query.metric, F.col("v")))
    layer = ids.join(seen, "fips", "left").select(
        "fips", inside.alias("in_state"), F.when(inside, fill).otherwise(DIM_FILL).alias("fill"), F.when(inside, 1.0).otherwise(0.35).alias("opacity"), F.when(inside, F.col("label")).alias("label"),
        *([] if n is None else [(F.col(n) * F.coalesce("copies", F.lit(1))).alias(n)]),
    )
    # areas that differ in their label or distance are alike outside of the state
    return layer if n is None else layer.groupBy("fips", "in_state", "fill", "opacity", "label").agg(F.sum(n).alias(n))


# Views of the two states that the projection moves, the view of the whole, and limits of the zoom.
VIEW_OVERRIDES = {"AK": (-150.0, 63.0, 3.2), "HI": (-157.5, 20.7, 4.5)}
DEFAULT_VIEW = (-96.9, 38.0, 1.0)
LEAST_ZOOM, MOST_ZOOM, LNG_SPAN, LAT_SPAN, LEAST_SPAN, FIT = 1.4, 14.0, 58.0, 24.0, 0.5, 0.9


def state_extent(points: DataFrame, states: DataFrame) -> DataFrame:
    """(state, n_points, center_lng, center_lat, zoom) of the area centroids (fips, lat, lng) of each state."""
    named = points.withColumn("prefix", F.substring("fips", 1, 2)).join(F.broadcast(states.select("prefix", "state")), "prefix")  # 51 rows
    box = named.groupBy("state").agg(F.count(F.lit(1)).alias("n_points"), *[f(c).alias(f"{n}_{c}") for c in ("lat", "lng") for f, n in ((F.min, "min"), (F.max, "max"))])
    span = lambda c: F.greatest(F.lit(LEAST_SPAN), F.col(f"max_{c}") - F.col(f"min_{c}"))
    zoom = F.greatest(F.lit(LEAST_ZOOM), F.least(F.least(LNG_SPAN / span("lng"), LAT_SPAN / span("lat")) * FIT, F.lit(MOST_ZOOM)))
    values = {"center_lng": (F.col("min_lng") + F.col("max_lng")) / 2, "center_lat": (F.col("min_lat") + F.col("max_lat")) / 2, "zoom": zoom}
    for i, name in enumerate(values):
        for state, fixed in VIEW_OVERRIDES.items():
            values[name] = F.when(F.col("state") == state, fixed[i]).otherwise(values[name])
    return box.select("state", "n_points", *[c.alias(n) for n, c in values.items()])


def view_of(asked: DataFrame, extents: DataFrame) -> DataFrame:
    """(state, center_lng, center_lat, zoom) for each state asked for; the view of the whole where it is empty, unknown or without areas."""
    joined = asked.join(F.broadcast(extents), "state", "left")  # a row for each state
    return joined.select("state", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in zip(("center_lng", "center_lat", "zoom"), DEFAULT_VIEW, strict=True)])
