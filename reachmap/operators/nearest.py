"""Distance to the nearest point on the sphere, by a tree that splits by count.

Points are sorted by a space-filling curve through the cube around the sphere, and
numbered in that order. A node of the tree is a run of numbers with the same leading
bits, with the box around its points: a leaf has 2^LEAF points at most however dense they are, and
each level above holds 2^FAN nodes in one. For a query a box gives two distances: no point
of it is nearer than the box itself, and, as each face of the box has a point on it, one is at
most so far away as the farthest corner of the nearest face. A node goes on only if its least distance
is within the smallest of the others, so a dense far city leaves the few leaves of its near side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import arc_miles, unit_vector
from ..functions.keys import round_even
from ..storage import written

#: Bits of the number of a point within its leaf, and of a node within the one above.
LEAF, FAN = 5, 5
#: Nodes of the level that all tasks get (56 bytes each), at most.
TOP = 4096
#: Bits of a coordinate in the curve.
CURVE_BITS = 20
#: Relative slack of the comparison of distances, for rounding.
SLACK = 1e-9

_BOX = [f"{side}{a}" for side in ("lo", "hi") for a in "xyz"]


def _spread(x: Column) -> Column:
    """The bits of a number of CURVE_BITS bits, two zeros between any two."""
    # fixed values: the masks that keep the groups of bits apart at each halving of the shift
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask))
    return x


def curve(x: Column, y: Column, z: Column) -> Column:
    """Place of a point of the cube [-1, 1]^3 on the curve."""
    step = lambda v: F.greatest(F.lit(0), F.least(F.floor((v + 1) * (1 << (CURVE_BITS - 1))), F.lit((1 << CURVE_BITS) - 1))).cast("long")
    return _spread(step(x)).bitwiseOR(F.shiftleft(_spread(step(y)), 1)).bitwiseOR(F.shiftleft(_spread(step(z)), 2))


def numbered(points: DataFrame) -> DataFrame:
    """(id, px, py, pz): points in the order of the curve; ids of one partition are consecutive, and rise with the partitions."""
    placed = points.withColumn("at", curve(F.col("px"), F.col("py"), F.col("pz")))
    order = ["at", "px", "py", "pz"]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    # written once: another run might number them otherwise
    return written(dealt.select(F.monotonically_increasing_id().alias("id"), "px", "py", "pz"), "points")


def boxes(rows: DataFrame, node: Column, low: dict[str, str], high: dict[str, str]) -> DataFrame:
    """(node, box): the box around the rows of each node."""
    return rows.groupBy(node.alias("node")).agg(*[F.min(low[a]).alias(f"lo{a}") for a in "xyz"], *[F.max(high[a]).alias(f"hi{a}") for a in "xyz"])


def _least(q, lo, hi, greatest, zero):
    """Squared distance to a box; the arguments are columns or arrays, by axis."""
    gaps = [greatest(lo[a] - q[a], q[a] - hi[a], zero) for a in "xyz"]
    return sum(g * g for g in gaps)


def _surely(q, lo, hi, greatest, least):
    """Squared distance within which a box surely has a point: that of the farthest corner of the best face."""
    near = {a: least((q[a] - lo[a]) * (q[a] - lo[a]), (q[a] - hi[a]) * (q[a] - hi[a])) for a in "xyz"}
    far = {a: greatest((q[a] - lo[a]) * (q[a] - lo[a]), (q[a] - hi[a]) * (q[a] - hi[a])) for a in "xyz"}
    return least(*[near[a] + sum(far[b] for b in "xyz" if b != a) for a in "xyz"])


def _columns(prefix: str) -> dict[str, Column]:
    return {a: F.col(f"{prefix}{a}") for a in "xyz"}


def _from_top(queries: DataFrame, top: DataFrame) -> DataFrame:
    """(key, qx, qy, qz, node) of the nodes of the top level that go on; ``top`` has TOP rows at most."""
    held = top.toArrow()
    shared = queries.sparkSession.sparkContext.broadcast({c: held[c].to_numpy() for c in ("node", *_BOX)})
    names = queries.columns

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = shared.value
        lo, hi = ({a: box[f"{side}{a}"][None] for a in "xyz"} for side in ("lo", "hi"))
        most = lambda *xs: np.maximum.reduce(np.broadcast_arrays(*xs))
        fewest = lambda *xs: np.minimum.reduce(np.broadcast_arrays(*xs))
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                q = {a: batch.column(names.index(f"q{a}")).to_numpy()[:, None] for a in "xyz"}
                bound = _surely(q, lo, hi, most, fewest).min(axis=1, initial=np.inf)
                row, node = np.nonzero(_least(q, lo, hi, most, 0.0) <= (bound * (1 + SLACK))[:, None])
                yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in batch.columns], pa.array(box["node"][node])], [*names, "node"])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in queries.dtypes), "node long"])
    return queries.mapInArrow(descend, schema)


def _down(found: DataFrame, level: DataFrame, fan: int) -> DataFrame:
    """The candidates one level down: the nodes in each that go on."""
    inner = found.withColumnRenamed("node", "above").join(level.withColumn("above", F.shiftright("node", fan)), "above")
    q, lo, hi = _columns("q"), _columns("lo"), _columns("hi")
    inner = inner.withColumns({"least": _least(q, lo, hi, F.greatest, F.lit(0.0)), "surely": _surely(q, lo, hi, F.greatest, F.least)})
    bound = F.min("surely").over(Window.partitionBy("row"))
    return inner.withColumn("bound", bound).filter(F.col("least") <= F.col("bound") * (1 + SLACK)).select(*found.columns[:-1], "node")


def candidates(queries: DataFrame, points: DataFrame, leaf: int = LEAF, fan: int = FAN, top: int = TOP) -> DataFrame:
    """(row, qx, qy, qz, node) of the leaves in which a query's nearest point may be; ``points`` as ``numbered`` gives them."""
    low, high = ({a: f"{side}{a}" for a in "xyz"} for side in ("lo", "hi"))
    levels = [written(boxes(points, F.shiftright("id", leaf), *[{a: f"p{a}" for a in "xyz"}] * 2), "leaves")]
    while levels[-1].count() > top:
        levels.append(written(boxes(levels[-1], F.shiftright("node", fan), low, high), "nodes"))
    found = _from_top(queries, levels[-1])
    for level in reversed(levels[:-1]):
        found = _down(found, level, fan)
    return found


def nearest_miles(areas: DataFrame, points: DataFrame, key: str, lat: str, lng: str, point_lat: str, point_lng: str, out: str, leaf: int = LEAF, fan: int = FAN, top: int = TOP, required: bool = False) -> DataFrame:
    """(key, out): miles to the nearest point, to one decimal. Without any point there are no rows, or an error if points are ``required``.

    Points are made distinct first, as only the distance counts; areas without coordinates
    are left out. The tree is built here; the search runs with the result.
    """
    x, y, z = unit_vector(F.col(lat), F.col(lng))
    queries = areas.dropna(subset=[lat, lng]).select(F.col(key).alias("key"), x.alias("qx"), y.alias("qy"), z.alias("qz"))
    queries = queries.select(F.struct("key", "qx", "qy", "qz").alias("row"), "qx", "qy", "qz")
    x, y, z = unit_vector(F.col(point_lat), F.col(point_lng))
    held = numbered(points.select(point_lat, point_lng).dropna().distinct().select(x.alias("px"), y.alias("py"), z.alias("pz")))
    if required and held.isEmpty():
        raise ValueError(f"no point has {point_lat} and {point_lng}")
    found = candidates(queries, held, leaf, fan, top)
    q, p = _columns("q"), _columns("p")
    square = sum(((q[a] - p[a]) * (q[a] - p[a]) for a in "xyz"), start=F.lit(0.0))
    # one leaf has 2^leaf points, so no key of this join holds more on that side
    near = found.join(held.withColumn("node", F.shiftright("id", leaf)), "node").groupBy(F.col("row.key").alias("key")).agg(F.min(square).alias("d2"))
    return near.select(F.col("key").alias(key), round_even(arc_miles(F.sqrt("d2")), 1).alias(out))
