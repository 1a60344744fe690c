"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are halved; each half has its own codebook, and the product of the
two is the grid of cells. A vector lies in the cell of its nearest centroids and
visits the other cells nearest first, by the sum of the two squared distances: the
multi-sequence rule on the two sorted lists of distances, up to a margin over the
vector's own cell. The margin is the one at which neighbours that lie exactly at
the similarity asked for are reached with the target recall, as measured on a
bounded sample. Cells (of one label and one length of vectors) hold their vectors
in blocks of bounded size. Blocks of cells that one vector at least visits are
joined, and each pair of vectors of which one visits the other's cell is verified
in double precision, once. A pair of blocks gives counts of links and a spanning
forest, never its pairs.

The commonest lengths of vectors have grids of their own, fitted on samples; the
vectors of any other length are one cell for each label, so all of their pairs are
compared.

Defined cases: vectors that are null, zero or hold a null or non-finite component,
and rows with a null label, link with nothing and are their own component. Vectors
of different lengths link with nothing of each other. Equal vectors of a label are
one node with a weight. Rows that repeat an id are vectors of their own, each with
the links of its own vector. A null id gets the least id of its component (null if
that has none), and is never kept.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, named_by_least
from ..storage import written

#: Vectors, and components of vectors, that the codebooks and the margin of a length are fitted on at most, about.
SAMPLE, SAMPLE_VALUES = 20_000, 5_000_000
#: Lengths of vectors that have a fitted grid, commonest first.
GRIDS = 8
RECALL = 0.999
BLOCK, OCCUPANCY, MAX_CENTROIDS = 1024, 256, 256


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # by a power of two first, which is exact, so that no square is too great or too small
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0.0)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = squared(x, c).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest_first(a: np.ndarray, b: np.ndarray, margin: float) -> Iterator[tuple[int, int]]:
    """Places (i, j) of two sorted lists by rising ``a[i] + b[j]``, as long as the sum is within ``margin``.

    The heap holds the next place of every row that has begun; a row begins when the
    first place of the row before it is taken.
    """
    heap = [(a[0] + b[0], 0, 0)]
    while heap and heap[0][0] <= margin:
        _, i, j = heapq.heappop(heap)
        yield i, j
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


@dataclass
class Grid:
    """Codebooks of the halves, and how far beyond its own cell a vector goes."""

    first: np.ndarray
    second: np.ndarray
    margin: float = np.inf

    @classmethod
    def single(cls, d: int) -> Grid:
        """One cell for all vectors of ``d`` components."""
        return cls(np.zeros((1, d // 2)), np.zeros((1, d - d // 2)))

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        return squared(x[:, :h], self.first), squared(x[:, h:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def excess(self, x: np.ndarray, cells: np.ndarray | int) -> np.ndarray:
        """How much farther a cell is than the vector's own."""
        a, b = self.halves(x)
        rows, k = np.arange(len(x)), len(self.second)
        return a[rows, cells // k] + b[rows, cells % k] - a.min(axis=1) - b.min(axis=1)

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """Cells that each vector visits, nearest first."""
        a, b = self.halves(x)
        order_a, order_b, k = a.argsort(axis=1), b.argsort(axis=1), len(self.second)
        out = []
        for own_a, own_b, at_a, at_b in zip(a, b, order_a, order_b, strict=True):
            da, db = own_a[at_a] - own_a[at_a[0]], own_b[at_b] - own_b[at_b[0]]
            near_a, near_b = at_a.tolist(), at_b.tolist()
            out.append([near_a[i] * k + near_b[j] for i, j in nearest_first(da.tolist(), db.tolist(), self.margin)])
        return out


def fit(sample: np.ndarray, k: int, cosine: float, recall: float, seed: int = 7) -> Grid:
    """Codebooks of ``k`` centroids, and the margin at which neighbours at ``cosine`` are reached."""
    rng, x = np.random.default_rng(seed), unit(sample)
    h, k = x.shape[1] // 2, min(k, len(x))
    grid = Grid(kmeans(x[:, :h], k, rng), kmeans(x[:, h:], k, rng))
    y = x + 0.0
    noise = rng.normal(size=y.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    y = cosine * x + np.sqrt(1 - cosine**2) * noise / np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    # a pair is found if either end visits the other
    reach = np.minimum(grid.excess(x, grid.cells(y)), grid.excess(y, grid.cells(x)))
    grid.margin = float(np.quantile(reach, recall)) + 1e-9
    return grid


def linked(x: np.ndarray, y: np.ndarray, cell_x: int, cell_y: int, grid: Grid, cosine: float, same: bool) -> np.ndarray:
    """Boolean matrix of the pairs that one end visits and whose cosine is high enough; ``same``: x is y, above the diagonal only."""
    hits = x @ y.T >= cosine
    if cell_x != cell_y:
        hits &= (grid.excess(x, cell_y) <= grid.margin)[:, None] | (grid.excess(y, cell_x) <= grid.margin)[None]
    return np.triu(hits, 1) if same else hits


def forest(hits: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a spanning forest of the links; ``same``: rows and columns are the same vectors."""
    n = 0 if same else len(hits)
    label = np.arange(n + hits.shape[1])
    rows, cols = [], []
    for i in np.flatnonzero(hits.any(axis=1)).tolist():
        j = np.flatnonzero(hits[i])
        kinds, first = np.unique(label[j + n], return_index=True)
        new = kinds != label[i]
        if new.any():
            rows += [i] * int(new.sum())
            cols += j[first[new]].tolist()
            label[np.isin(label, kinds[new])] = label[i]
    return np.array(rows, np.int64), np.array(cols, np.int64)


def fitted(nodes: DataFrame, cosine: float, recall: float, sample: int, occupancy: int) -> dict[int, Grid]:
    """Grids of the commonest lengths, from a sample of each; nodes: (label, d, v)."""
    sizes = nodes.groupBy("label", "d").agg(F.count(F.lit(1)).alias("n")).groupBy("d").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    sizes = {r["d"]: r for r in sizes.orderBy(F.desc("n"), "d").limit(GRIDS).collect() if r["d"] > 1}
    counts = {d: int(min(MAX_CENTROIDS, np.ceil(np.sqrt(r["most"] / occupancy)))) for d, r in sizes.items()}
    shares = {d: int(1_000_000 * min(1.0, min(sample, SAMPLE_VALUES // d) / r["n"])) for d, r in sizes.items() if counts[d] > 1}
    if not shares:
        return {}
    place, share = F.xxhash64("label", "v"), F.element_at(F.create_map(*[F.lit(x) for item in shares.items() for x in item]), F.col("d"))
    chosen = nodes.filter(F.pmod(place, F.lit(1_000_000)) <= share).select("d", "v", place.alias("place")).orderBy("place").toArrow()
    by: dict[int, list] = {}
    for d, v in zip(chosen["d"].to_pylist(), chosen["v"].to_pylist(), strict=True):
        by.setdefault(d, []).append(v)
    return {d: fit(np.array(x, np.float64), counts[d], cosine, recall) for d, x in by.items()}


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93, recall: float = RECALL, sample: int = SAMPLE, occupancy: int = OCCUPANCY) -> DataFrame:
    """(id, n_links, component_id, kept) for each row."""
    spark = vectors.sparkSession
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = F.coalesce(v.isNotNull() & finite & F.exists(v, lambda e: e != 0) & F.col("label").isNotNull(), F.lit(False))
    nodes = rows.filter(usable).groupBy("label", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"))
    # numbered as they are written, once: ids may be null or repeat
    nodes = written(nodes.select("label", F.size("v").alias("d"), "v", "least", "weight", F.monotonically_increasing_id().alias("node")), "nodes")
    shared = spark.sparkContext.broadcast(fitted(nodes, cosine, recall, sample, occupancy))
    kind, label = dict(nodes.dtypes)["v"], dict(nodes.dtypes)["label"]
    grid_of = lambda d: shared.value.get(d) or Grid.single(d)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for d in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == d))
                x, grid = unit(own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)), grid_of(d)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(grid.cells(x).astype(np.int32)), pa.array(grid.visits(x), pa.list_(pa.int32()))], ["label", "d", "v", "node", "weight", "cell", "visits"])

    placed = written(nodes.select("label", "d", "v", "node", "weight").mapInArrow(place, f"label {label}, d int, v {kind}, node long, weight long, cell int, visits array<int>"), "placed")
    cell = ["label", "d", "cell"]
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    # dealt out anew: the join's partitions hold whole cells, which may be large
    dealt = placed.drop("visits").join(blocks, cell).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).repartition(*cell, "block")
    packed = dealt.groupBy(*cell, "block").agg(F.collect_list(F.struct("node", "weight", "v")).alias("held"))
    packed = packed.select(*cell, "block", F.transform("held", lambda s: s["node"]).alias("node"), F.transform("held", lambda s: s["weight"]).alias("weight"), F.flatten(F.transform("held", lambda s: s["v"])).alias("v"))
    packed = written(packed, "cells")
    visited = placed.select(*cell, F.explode("visits").alias("other")).select("label", "d", F.least("cell", "other").alias("a"), F.greatest("cell", "other").alias("b")).distinct()
    side = lambda c: packed.select("label", "d", F.col("cell").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("block", "node", "weight", "v")])
    pairs = visited.join(side("a"), ["label", "d", "a"]).join(side("b"), ["label", "d", "b"]).filter("a <> b or block_a <= block_b")
    pairs = pairs.select("d", "a", "b", (F.col("a").eqNullSafe(F.col("b")) & (F.col("block_a") == F.col("block_b"))).alias("same"), "node_a", "weight_a", "v_a", "node_b", "weight_b", "v_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                d, a, b, same = (batch.column(c)[r].as_py() for c in range(4))
                node_a, weight_a, x, node_b, weight_b, y = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(4, 10))
                hits = linked(unit(x.reshape(-1, d)), unit(y.reshape(-1, d)), a, b, grid_of(d), cosine, same)
                if not hits.any():
                    continue
                rows, columns = forest(hits, same)
                n_a, n_b = hits @ weight_b, weight_a @ hits
                out_a, out_b = np.concatenate([node_a, node_b, node_a[rows]]), np.concatenate([np.full(len(node_a) + len(node_b), -1), node_b[columns]])
                n = np.concatenate([n_a, n_b, np.full(len(rows), -1)])
                keep = n != 0
                yield pa.RecordBatch.from_arrays([pa.array(out_a[keep]), pa.array(np.where(n[keep] < 0, out_b[keep], 0)), pa.array(n[keep])], ["node", "to", "n"])

    found = written(pairs.mapInArrow(compare, "node long, `to` long, n long"), "links")
    counts = found.filter("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    parts = components(found.filter("n < 0").select(F.col("node").alias("a"), F.col("to").alias("b")))
    # the id of a component is the least of its rows' ids, whatever number its nodes have
    named = named_by_least(nodes.select(F.col("node").alias("id"), "least", "label", "v", "weight"), parts)
    summed = named.join(counts, named["id"] == counts["node"], "left").select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    known = rows.filter(usable).join(summed, ["label", "v"]).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
    rest = rows.filter(~usable).select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    return known.unionByName(rest)


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
