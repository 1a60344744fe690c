"""SimHash near-duplicates by tiled exact comparison.

Every document gets a fingerprint of one or more 64-bit words. Equal
fingerprints are one node. Nodes are laid into tiles by population counts (of
the four 16-bit quarters, or by text size), a tile holding a bounded number of
them; only tile pairs whose counts allow a distance within the radius are
joined, and each joined pair is compared with numpy exclusive-or and bit counts.
A pair of tiles gives the edges of a spanning forest of its links, those of a
text nearest first: that keeps every component and never writes all pairs of a
group.

For near-duplicates by similarity these forests give candidate groups, in which
the texts decide, by the similarity of their shingle sets. A group of bounded size
is one cell, whose texts are all compared in one task. In a larger group the
forest's edges are verified first, and what holds makes parts; then all texts of
different parts are compared, cell by cell. So no true link within a group is lost
to a false one that lies nearer, and texts in no group are never compared.

Defined cases: a null text is the empty text; texts without words have
fingerprint zero and are nodes like others; a null id takes no part in the
numbering of a component, but its row gets the component of its fingerprint (null
if no row with an id has it). Rows that repeat an id are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, named_by_least
from .names import unused
from ..storage import written

#: Nodes of a tile at most, about.
TILE = 8192
#: Ids that are broadcast at most (16 bytes each); beyond that the join is a shuffle.
FEW_IDS = 2_000_000
#: Words of the fingerprints for near-duplicates by similarity; texts, and shingles, of a cell of exact comparison, about.
WORDS, CELL, CELL_SHINGLES = 4, 256, 500_000
#: Shingles up to which sets that lack one shingle are looked up exactly: bits of so few tell little.
SHORT = 16
#: Hashes turned into bits at once.
BLOCK = 1 << 15


def shingle_bytes(text: str | None, width: int) -> list[bytes]:
    """Shingles of ``width`` words, repeats included; the whole sequence if it is shorter, none without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [joined[s:e] for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]


def remixed(h: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th further 64 bits of a hash."""
    h = h + np.uint64((k * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(shingles: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles))


def set_hash(h: np.ndarray) -> int:
    """Hash of hashes in any order, signed."""
    return int(remixed(h, WORDS).sum(dtype=np.uint64).view(np.int64))


def fingerprint(h: np.ndarray, words: int = 1) -> list[int]:
    """Signed 64-bit words from hashes (XXH64 of seed 42): a bit is 1 if it is set in over half of them."""
    n, counts = len(h), np.zeros((words, 64), np.int64)
    for at in range(0, n, BLOCK):
        part = h[at : at + BLOCK]
        for k in range(words):
            bits = remixed(part, k) if k else part
            counts[k] += np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n, axis=1, bitorder="little").view(np.int64)[:, 0].tolist()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int, words: int = 1, distinct: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, f0, f1, .., n_shingles, norm, less) for each row; norm: a hash of the shingles in any order.

    ``distinct``: repeated shingles count once, and ``less`` has, for 2 to SHORT shingles, the
    hashes of the sets that lack one; null otherwise.
    """
    names = [f"f{i}" for i in range(words)]
    kinds = [*[pa.int64()] * (len(names) + 2), pa.list_(pa.int64())]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *keep, F.col(text_col).cast("string").alias("text"))
    kept = rows.dtypes[:-1]

    def row(text: str | None) -> tuple[int, ...]:
        h = hashes(shingle_bytes(text, width))
        h = np.unique(h) if distinct else h
        less = [set_hash(np.delete(h, k)) for k in range(len(h))] if distinct and 2 <= len(h) <= SHORT else None
        return (*fingerprint(h, words), len(h), set_hash(h), less)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [row(t) for t in batch.column(len(kept)).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[]] * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*(n for n, _ in kept), *names, "n_shingles", "norm", "less"])

    return rows.mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in kept), *(f"{n} long" for n in names), "n_shingles long", "norm long", "less array<long>"]))


class Forest:
    """Union-find over the values met so far."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def tile_edges(a: np.ndarray, b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Rows (distance, id, id) of a spanning forest of the links between two tiles; ``same``: the tiles are one.

    a, b: fingerprints (nodes, words). A node joins every part of the forest that it is near to, by its nearest node there.
    """
    pops_a, pops_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    if pops_a.min() - pops_b.max() > radius or pops_b.min() - pops_a.max() > radius:
        return np.empty((0, 3), np.int64)
    n = 0 if same else len(a)
    label, found = np.arange(n + len(b)), [np.empty((0, 3), np.int64)]
    step = max(1, (1 << 18) // len(b))
    for at in range(0, len(a), step):
        d = np.bitwise_count(a[at : at + step, None, 0] ^ b[None, :, 0]).astype(np.uint8 if a.shape[1] < 4 else np.uint16)
        for k in range(1, a.shape[1]):
            d += np.bitwise_count(a[at : at + step, None, k] ^ b[None, :, k])
        near = d <= radius
        if same:
            near &= np.arange(len(b)) > np.arange(at, at + len(near))[:, None]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            j, own = np.flatnonzero(near[i]), label[at + i]
            j = j[label[n + j] != own]
            if len(j):
                j = j[np.lexsort((d[i, j], label[n + j]))]
                parts = label[n + j]
                j = j[np.flatnonzero(np.diff(parts, prepend=-1))]
                found.append(np.stack([d[i, j].astype(np.int64), np.full(len(j), ids_a[at + i]), ids_b[j]], axis=1))
                label[label == parts[0] if len(j) == 1 else np.isin(label, label[n + j])] = own
    return np.concatenate(found)


def near_edges(nodes: DataFrame, words: int, radius: int, dims: list[Column], offsets: list[tuple[int, ...]], tile: int = TILE) -> DataFrame:
    """Edges (a, b, distance) of nodes (id, f0, ..) within ``radius`` bits: a forest by tile pair.

    Each id is once in ``nodes``.

    ``dims``: integer tile coordinates. ``offsets``: the coordinate steps to tiles
    that can hold partners, one of each two opposite ones, and the zero step.
    """
    names, fs = [f"d{i}" for i in range(len(dims))], [f"f{i}" for i in range(words)]
    placed = nodes.select("id", *fs, *[d.cast("int").alias(n) for d, n in zip(dims, names, strict=True)])
    # a row for each tile coordinate: the sizes' logarithms, or 17 to the fourth at most
    blocks = F.broadcast(written(placed.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("blocks")), "blocks"))
    placed = placed.join(blocks, names).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tiles = placed.groupBy(*names, "block").agg(F.collect_list(F.struct("id", *fs)).alias("held"))
    tiles = tiles.select(*names, "block", F.transform("held", lambda x: x["id"]).alias("ids"), F.flatten(F.transform("held", lambda x: F.array(*[x[f] for f in fs]))).alias("bits"))
    tiles = written(tiles, "tiles")
    steps = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(o, names, strict=True)]) for o in offsets])
    left = tiles.withColumn("o", F.explode(steps)).select(*[(F.col(n) + F.col(f"o.{n}")).alias(n) for n in names], F.concat(*[F.col(f"o.{n}").cast("string") for n in names]).rlike("[1-9]").alias("other"), F.col("block").alias("l_block"), F.col("ids").alias("l_ids"), F.col("bits").alias("l_bits"))
    # a row for each pair of tiles, dealt by both coordinates and block of the one that is looked up
    left = left.join(blocks, names).withColumn("block", F.explode(F.sequence(F.when(F.col("other"), 0).otherwise(F.col("l_block")), F.col("blocks") - 1)))
    pairs = left.join(tiles, [*names, "block"]).select((~F.col("other") & (F.col("l_block") == F.col("block"))).alias("same"), "l_ids", "l_bits", "ids", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column(0).to_pylist()
            flat = [(batch.column(k).offsets.to_pylist(), batch.column(k).values.to_numpy(zero_copy_only=False)) for k in range(1, 5)]
            for row, own in enumerate(same):
                ids_a, bits_a, ids_b, bits_b = (v[o[row] : o[row + 1]] for o, v in flat)
                found = tile_edges(bits_a.view(np.uint64).reshape(-1, words), bits_b.view(np.uint64).reshape(-1, words), ids_a, ids_b, radius, own)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 1]), pa.array(found[:, 2]), pa.array(found[:, 0])], ["a", "b", "distance"])

    return pairs.mapInArrow(run, "a long, b long, distance long")


def quarter_dims(radius: int) -> tuple[list[Column], list[tuple[int, ...]]]:
    """Tiles by the population counts of f0's quarters: those of two nodes differ by ``radius`` in all at most."""
    dims = [F.bit_count(F.shiftrightunsigned("f0", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(4)]
    steps = [o for o in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, o)) <= radius and o >= (0, 0, 0, 0)]
    return dims, steps


def size_dims(similarity: float) -> tuple[list[Column], list[tuple[int, ...]]]:
    """Tiles by shingle count: sets that alike differ in size by no more than 1 / similarity."""
    return [F.floor(F.log(F.greatest(F.col("n_shingles"), F.lit(1))) / F.log(F.lit(1 / similarity)))], [(0,), (1,)]


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) for each row: fingerprints that differ in ``radius`` bits at most are linked."""
    prints = written(fingerprints(docs, id_col, text_col, width).select("id", "f0"), "fingerprints")
    # a fingerprint is its own node
    nodes = written(prints.groupBy("f0").agg(F.min("id").alias("least")).select(F.col("f0").alias("id"), "f0", "least"), "nodes")
    dims, steps = quarter_dims(radius)
    parts = components(near_edges(nodes, 1, radius, dims, steps))
    named = named_by_least(nodes, parts).select("f0", "component_id")
    shown = prints.join(named, "f0", "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
    return shown


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets of hashes; two texts without words are alike."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def overlaps(a: list[np.ndarray], b: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """How many values each array of ``a`` shares with each of ``b``; the values of an array are distinct."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    sides = []
    for sets, flat in ((a, flat_a), (b, flat_b)):
        at = np.searchsorted(shared, flat)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == flat[hit]
        rows, cols = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[hit], at[hit]
        order = np.argsort(cols, kind="stable")
        sides.append((len(sets), rows[order], cols[order]))
    total = np.zeros((len(a), len(b)))
    for lo in range(0, len(shared), step):
        parts = []
        for n, rows, cols in sides:
            own = slice(*np.searchsorted(cols, [lo, lo + step]))
            m = np.zeros((n, min(step, len(shared) - lo)), np.float32)  # exact: a step's counts are below 2 ** 24
            m[rows[own], cols[own] - lo] = 1
            parts.append(m)
        total += parts[0] @ parts[1].T
    return total


def cell_links(a: list[np.ndarray], b: list[np.ndarray], parts_a: np.ndarray, parts_b: np.ndarray, similarity: float) -> np.ndarray:
    """Rows (part, part): a spanning forest of the parts that two alike sets, one of each cell, link."""
    shared = overlaps(a, b)
    either = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None] - shared
    alike = np.divide(shared, either, out=np.ones_like(shared), where=either > 0) >= similarity
    i, j = np.nonzero(alike & (parts_a[:, None] != parts_b[None]))
    forest = Forest()
    pairs = np.unique(np.stack([parts_a[i], parts_b[j]], axis=1), axis=0)
    return pairs[[forest.join(x, y) for x, y in pairs.tolist()]] if len(pairs) else pairs


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(hashes(shingle_bytes(text, width)))


def _arrays(batch: pa.RecordBatch, r: int, *places: int) -> Iterator[np.ndarray]:
    for k in places:
        yield batch.column(k)[r].values.to_numpy(zero_copy_only=False)


def _sets(batch: pa.RecordBatch, r: int, place: int) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in batch.column(place)[r]]


def exact_links(texts: DataFrame, width: int, similarity: float, cell: int = CELL) -> DataFrame:
    """Links (a, b) of parts by the exact comparison of all texts of different parts of a group.

    texts: (grp, part, n_shingles, text). Texts of a group that fits into one cell are compared
    in one task. In a larger one, a part of ``cell`` texts or more has cells of its own, which
    are not compared with each other; all other pairs of cells are.
    """
    parts = texts.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    several = parts.groupBy("grp").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all_n"), F.sum("w").alias("all_w")).filter("parts > 1")
    whole = (F.col("all_n") <= cell) & (F.col("all_w") <= CELL_SHINGLES)
    sizes = parts.join(several.select("grp", whole.alias("whole")), "grp")
    # ids of parts may be any number: a pool of small parts is marked apart
    sizes = sizes.withColumn("own", ~F.col("whole") & (F.col("n") >= cell)).withColumn("pool", F.when(F.col("own"), F.col("part")).otherwise(0))
    sizes = written(sizes, "sizes")
    blocks = sizes.groupBy("grp", "own", "pool").agg(F.when(F.bool_and("whole"), 1).otherwise(F.ceil(F.greatest(F.sum("n") / cell, F.sum("w") / CELL_SHINGLES, F.lit(1.0)))).alias("blocks"))
    key = ["grp", "own", "pool", "block"]
    dealt = sizes.join(blocks, ["grp", "own", "pool"]).select("grp", "part", "whole", "own", "pool", "blocks")
    # a group may be large, and a part of it too: rows are dealt out by their cells
    placed = texts.join(dealt, ["grp", "part"]).select(*key[:3], F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int").alias("block"), "whole", "part", "text")
    cells = written(placed.groupBy(*key, "whole").agg(F.collect_list(F.struct("part", "text")).alias("held")), "text-cells")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[shingle_set(x["text"], width).view(np.int64) for x in held] for held in batch.column(4).to_pylist()]
            parts = [[x["part"].as_py() for x in held] for held in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(parts, pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.list_(pa.int64())))], [*key, "parts", "sets"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column(0).to_pylist():
                sets, parts = [shingle_set(x["text"], width) for x in held], np.array([x["part"] for x in held], np.int64)
                yield _links(cell_links(sets, sets, parts, parts, similarity))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                yield _links(cell_links(_sets(batch, r, 1), _sets(batch, r, 3), *_arrays(batch, r, 0, 2), similarity))

    small = cells.filter("whole").select("held").mapInArrow(within, "a long, b long")
    large = written(cells.filter("not whole").select(*key, "held").mapInArrow(hashed, "grp long, own boolean, pool long, block int, parts array<long>, sets array<array<long>>"), "exact-cells")
    side = lambda t, x: t.select(*[F.col(c).alias(c if c == "grp" else f"{c}_{x}") for c in t.columns])
    keys = large.select(*key)
    pairs = side(keys, "a").join(side(keys, "b"), "grp").filter("struct(own_a, pool_a, block_a) <= struct(own_b, pool_b, block_b) and not (own_a and own_b and pool_a = pool_b)")
    pairs = pairs.join(side(large, "a"), ["grp", "own_a", "pool_a", "block_a"]).join(side(large, "b"), ["grp", "own_b", "pool_b", "block_b"])
    return small.union(pairs.select("parts_a", "sets_a", "parts_b", "sets_b").mapInArrow(between, "a long, b long"))


def _links(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64())], ["a", "b"])


def short_links(nodes: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of nodes (id, n_shingles, norm, less) of which one's few shingles are the other's but one.

    Of two different sets that are alike to 0.8 and of which one has seven shingles at most, all
    are such. A set is one node, so a row of ``less`` meets one node at most.
    """
    lacking = nodes.filter(F.try_divide(F.col("n_shingles") - 1, F.col("n_shingles")) >= similarity).select(F.col("id").alias("a"), (F.col("n_shingles") - 1).alias("n_shingles"), F.explode("less").alias("norm"))
    return lacking.join(nodes.select(F.col("id").alias("b"), "n_shingles", "norm"), ["n_shingles", "norm"]).select("a", "b")


def broadcast_if_few(ids: DataFrame, most: int = FEW_IDS) -> DataFrame:
    """``ids``, a narrow written table, marked for broadcast if it has ``most`` rows at most."""
    return F.broadcast(ids) if ids.count() <= most else ids


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, radius: int = 66, cell: int = CELL) -> DataFrame:
    """(id, text_hash, component_id) for each distinct id and text: texts whose shingle sets are alike to ``similarity`` are linked.

    Fingerprints of 256 bits find the candidate groups; the texts decide, for all pairs
    of a group that are not linked already. At 0.8 the bits of two texts differ by
    39 in the mean (deviation 6), by 128 (deviation 8) if unrelated; radius 66 is past
    four deviations of the one and seven before the other. Sets of few shingles, whose
    bits differ more, are also looked up with one shingle less. Repeats of a shingle count
    nowhere, and texts of equal shingle sets are one node.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).filter("id is not null")
    words = [f"f{k}" for k in range(WORDS)]
    prints = fingerprints(rows, "id", "text", width, WORDS, distinct=True, keep=("text_hash",))
    prints = written(prints.withColumn("key", F.xxhash64(*words, "n_shingles", "norm")), "fingerprints")
    # equal sets are a node; its least row lends it the text
    nodes = prints.groupBy("key").agg(F.min(F.struct("id", "text_hash")).alias("least"), *[F.first(c).alias(c) for c in (*words, "n_shingles", "norm", "less")])
    nodes = written(nodes.withColumnRenamed("key", "id"), "nodes")
    dims, steps = size_dims(similarity)
    near = written(near_edges(nodes, WORDS, radius, dims, steps).select("a", "b"), "near")
    groups = components(near).withColumnRenamed("component", "grp")
    wanted = nodes.join(groups, "id").select(F.col("least.id").alias("id"), F.col("least.text_hash").alias("text_hash"), F.col("id").alias("node"), "grp", "n_shingles")
    wanted = broadcast_if_few(written(wanted, "members"))
    texts = written(rows.join(wanted, ["id", "text_hash"]).dropDuplicates(["node"]).select("node", "grp", "n_shingles", "text"), "texts")
    sizes = texts.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    large = texts.join(sizes.filter((F.col("n") > cell) | (F.col("w") > CELL_SHINGLES)).select("grp"), "grp", "left_semi")
    side = lambda c: large.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [jaccard(shingle_set(x, width), shingle_set(y, width)) >= similarity for x, y in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    links = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(verified, "a long, b long")
    parts = components(links.union(short_links(nodes, similarity)))
    parts = written(nodes.select("id").join(parts, "id", "left").select("id", "component", F.coalesce("component", "id").alias("part")), "parts")
    divided = texts.join(parts.select(F.col("id").alias("node"), "part"), "node").select("grp", "part", "n_shingles", "text")
    whole = components(exact_links(divided, width, similarity, cell)).select(F.col("id").alias("part"), F.col("component").alias("joined"))
    linked = parts.join(whole, "part", "left").select("id", F.coalesce("joined", "component").alias("component")).filter("component is not null")
    named = named_by_least(nodes.select("id", "least"), written(linked, "linked")).select(F.col("id").alias("key"), F.col("component_id").alias("stays"))
    return prints.groupBy("id", "text_hash", "key").agg(F.count(F.lit(1)).alias("copies")).join(named, "key").select(F.col("id").alias(id_col), "text_hash", "copies", "stays", F.col("stays.id").alias("component_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` of each group, that with its least id, all columns as they are.

    Rows that repeat an id with the same text count as one row, with different texts as several,
    of which the groups decide. Rows with a null id stay.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, **options).select(F.col(id_col).alias("id"), "text_hash", "copies", "stays")
    groups = written(groups.withColumn("kept", F.col("stays") == F.struct("id", "text_hash")), "groups")
    own_id, own_hash = unused(docs.columns, "own_id"), unused(docs.columns, "own_hash")
    own = [F.col("id").alias(own_id), F.col("text_hash").alias(own_hash)]
    gone = broadcast_if_few(written(groups.filter("not kept").select(*own), "gone"))
    again = written(groups.filter("kept and copies > 1").select(*own), "again")
    marked = docs.withColumns({own_id: F.col(id_col).cast("long"), own_hash: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))})
    kept = marked.join(gone, [own_id, own_hash], "left_anti")
    if not again.isEmpty():
        again = broadcast_if_few(again)
        repeated = kept.join(again, [own_id, own_hash], "left_semi").dropDuplicates([own_id, own_hash])
        kept = kept.join(again, [own_id, own_hash], "left_anti").unionByName(repeated)
    return kept.drop(own_id, own_hash)
