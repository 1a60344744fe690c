"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become token sequences. A window of five tokens
that both have is a seed, found from the Karp-Rabin hashes of the windows;
documents without a seed are done. Seeds that follow each other on one diagonal
are one run. Of the runs the longest is marked, in both sequences, and what the
others lose to it is cut away, until no unmarked run of five is left. An item is
in a document if the marked tiles cover enough of the item, in any order: moved
sentences count as much as copied ones.

A benchmark of at most ``max_tokens`` tokens is broadcast. A larger one is
neither collected nor broadcast: the windows of documents and items meet in a
shuffle, pairs whose seeds can't cover enough of the item are dropped there, and
the texts of the pairs that are left are tiled.

Defined cases: null and empty texts, and items without a token, match nothing; an
item of fewer than five tokens is one window of its own length; equal rows are
reported once each. Runs of equal length go by their place in the item, then in
the text.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import written
from .names import unused

WINDOW, COVERAGE = 5, 0.5
#: Tokens of a benchmark that is broadcast at most.
MAX_TOKENS = 4_000_000
#: Pairs of places that are laid out at once.
PAIRS = 1 << 20
TOKEN = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``width`` codes; 0 where a code is 0."""
    if len(codes) < width:
        return np.empty(0, np.uint64)
    h, ok = np.zeros(len(codes) - width + 1, np.uint64), np.ones(len(codes) - width + 1, bool)
    for k in range(width):
        part = codes[k : len(codes) - width + 1 + k]
        h = h * _BASE + part.astype(np.uint64)
        ok &= part > 0
    return np.where(ok, h ^ (h >> np.uint64(29)), np.uint64(0))


def runs_of(seeds: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """Rows (item, diagonal, place in text, length): maximal runs of seeds (item, place in item, place in text).

    The places in the text rise from one block of seeds to the next; the runs that reach a
    block's end are taken up by the next one, so memory goes by the runs and a block.
    """
    done, open_ = [], np.empty((0, 4), np.int64)
    for item, i, t in seeds:
        rows = np.stack([item, t - i, t, np.ones_like(t)], axis=1)
        rows = np.concatenate([open_, rows])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1) | (rows[1:, 2] != rows[:-1, 2] + rows[:-1, 3])
        first = np.flatnonzero(new)
        rows = np.column_stack([rows[first, :3], np.add.reduceat(rows[:, 3], first)])
        last = t.max()
        still = rows[:, 2] + rows[:, 3] > last
        done.append(rows[~still])
        open_ = rows[still]
    rows = np.concatenate([*done, open_])
    rows[:, 3] += width - 1
    return rows


def greedy_tiles(n_item: int, n_text: int, runs: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, length) of maximal runs: longest first, none overlapping, none below ``least``."""
    used_i, used_t = np.zeros(n_item, bool), np.zeros(n_text, bool)
    heap = [(-n, i, t) for i, t, n in runs if n >= least]
    heapq.heapify(heap)
    tiles = []
    while heap:
        n, i, t = heapq.heappop(heap)
        n = -n
        taken = used_i[i : i + n] | used_t[t : t + n]
        if not taken.any():
            tiles.append((i, t, n))
            used_i[i : i + n] = used_t[t : t + n] = True
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(heap, (a - b, i + a, t + a))
    return tiles


@dataclass
class Benchmark:
    """Items as codes, and for each window length the sorted hashes with their (item, place)."""

    ids: list[int | None]
    codes: dict[str, int]
    items: list[list[int]]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Benchmark:
        ids, codes, items = [], {}, []
        for item_id, text in rows:
            if tokens := tokens_of(text):
                ids.append(item_id)
                items.append([codes.setdefault(t, len(codes) + 1) for t in tokens])
        seeds = {}
        for width in {min(WINDOW, len(x)) for x in items}:
            own = [(k, windows(np.array(x), width)) for k, x in enumerate(items) if min(WINDOW, len(x)) == width]
            h = np.concatenate([w for _, w in own])
            order = np.argsort(h, kind="stable")
            owner = np.concatenate([np.full(len(w), k) for k, w in own])
            place = np.concatenate([np.arange(len(w)) for _, w in own])
            seeds[width] = h[order], owner[order], place[order]
        return cls(ids, codes, items, seeds)

    def _seeds(self, own: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of seeds (item, place in item, place in text) by rising place in the text; own: the text's windows."""
        h, owner, place = self.seeds[width]
        lo, hi = np.searchsorted(h, own), np.searchsorted(h, own, "right")
        hit = np.flatnonzero((own != 0) & (hi > lo))
        many = np.cumsum(hi[hit] - lo[hit])
        at = 0
        while at < len(hit):
            end = max(at + 1, int(np.searchsorted(many, (many[at - 1] if at else 0) + PAIRS)))
            t, n = hit[at:end], (hi - lo)[hit[at:end]]
            flat = np.repeat(lo[t] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield owner[flat], place[flat], np.repeat(t, n)
            at = end

    def search(self, text: str | None, coverage: float = 0.0) -> Iterator[tuple[int | None, int, int, int]]:
        """(item id, item tokens, covered tokens, tiles) of every item of which tiles in the text cover ``coverage``."""
        get = self.codes.get
        codes = np.array([get(t, 0) for t in tokens_of(text)], np.int64)
        for width in sorted(self.seeds):
            seeds = self._seeds(windows(codes, width), width)
            if (head := next(seeds, None)) is None:
                continue
            rows = runs_of(_chain(head, seeds), width)
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            ends = np.flatnonzero(np.diff(rows[:, 0], append=-1)) + 1
            for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                k = int(rows[a, 0])
                size, t, n = len(self.items[k]), rows[a:b, 2], rows[a:b, 3]
                i = t - rows[a:b, 1]
                # no more than the runs cover together
                reach = np.bincount(i, minlength=size + 1) - np.bincount(i + n, minlength=size + 1)
                if (np.cumsum(reach) > 0).sum() < coverage * size:
                    continue
                tiles = greedy_tiles(size, len(codes), list(zip(i.tolist(), t.tolist(), n.tolist(), strict=True)), width)
                covered = sum(x for _, _, x in tiles)
                if covered >= coverage * size:
                    yield self.ids[k], size, covered, len(tiles)


def _chain(head: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield head
    yield from rest


FOUND = ["item_id", "item_tokens", "covered", "tiles"]


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))


def _broadcast(items: DataFrame, max_tokens: int) -> Broadcast | None:
    """The benchmark for the executors, if it surely has ``max_tokens`` tokens at most: two tokens have a character between them."""
    most = items.agg(F.sum(F.floor((F.length("text") + 1) / 2) + 1)).first()[0] or 0
    if most > max_tokens:
        return None
    return items.sparkSession.sparkContext.broadcast(Benchmark.of([(r["item_id"], r["text"]) for r in items.collect()]))


def probes(seeds: DataFrame, texts_of: DataFrame, coverage: float) -> DataFrame:
    """The rows of ``seeds`` (seed, width, item, size), a row for each place of an item, that texts are looked up by; texts_of: (seed, width, texts).

    A text that covers enough of an item has the windows of so many of its places (``need``) that it has
    one of any other set of places but need - 1. Those that fewest texts have are taken; so a window
    that all texts have is asked for only if nearly all of the item is such windows.
    """
    of_item = Window.partitionBy("item")
    need = F.ceil(F.lit(coverage) * F.col("size") / F.col("width"))
    place = F.row_number().over(of_item.orderBy(F.coalesce("texts", F.lit(0)), "seed"))
    # an item's places are bounded by its own length
    ranked = seeds.join(texts_of, ["seed", "width"], "left").withColumns({"place": place, "places": F.count(F.lit(1)).over(of_item)})
    return ranked.filter(F.col("place") <= F.col("places") - need + 1).select("seed", "width", "item").distinct()


def _pairs_by_shuffle(texts: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """(key, item_id, item_tokens, covered, tiles) for texts (key, no, text), each once, where windows meet by a join.

    A pair goes on if the text has one of the item's rarest windows, of as many as show that it may cover enough.
    """
    items = written(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "items")

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tokens := tokens_of(text):
                    width = min(WINDOW, len(tokens))
                    h = hashed_windows(tokens, width)
                    full = lambda x, n=len(h): pa.array(np.full(n, x, np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(h), full(width), full(item), full(len(tokens))], ["seed", "width", "item", "size"])

    ours = written(items.select("item", "text").mapInArrow(item_seeds, "seed long, width long, item long, size long"), "item-seeds")
    widths = [r[0] for r in ours.select("width").distinct().collect()]  # WINDOW values at most

    def text_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = tokens_of(text)
                found = [(np.unique(hashed_windows(tokens, w)), w) for w in widths if w <= len(tokens)]
                if found:
                    h, w = np.concatenate([x for x, _ in found]), np.concatenate([np.full(len(x), w) for x, w in found])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), no)), pa.array(h), pa.array(w)], ["no", "seed", "width"])

    theirs = texts.select("no", "text").mapInArrow(text_seeds, "no long, seed long, width long")
    # counted before they meet the items: a window of all texts is one row a task in the shuffle
    counts = theirs.groupBy("seed", "width").agg(F.count(F.lit(1)).alias("texts"))
    texts_of = written(counts.join(ours.select("seed", "width").distinct(), ["seed", "width"], "left_semi"), "seed-counts")
    asked = written(probes(ours, texts_of, coverage), "probes")
    pairs = written(theirs.join(asked, ["seed", "width"]).select("no", "item").distinct(), "pairs")
    both = pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item").join(texts, "no").select("key", "item_id", "item_text", "text")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, *x) for key, item_id, item_text, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in Benchmark.of([(item_id, item_text)]).search(text, coverage)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 0 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))], ["key", *FOUND])

    return both.mapInArrow(tile, ", ".join(["key string", *(f"{n} long" for n in FOUND)]))


def hashed_windows(tokens: list[str], width: int) -> np.ndarray:
    """Window hashes, signed, of tokens that have no common list of codes."""
    codes = np.fromiter((xxhash.xxh64_intdigest(t.encode(errors="surrogatepass")) >> 1 | 1 for t in tokens), np.uint64, len(tokens))
    return windows(codes, width).view(np.int64)


def _keyed(docs: DataFrame, text: Column, key: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a key of their text, and the distinct texts (key, no, text)."""
    keyed = docs.withColumn(key, F.sha2(text, 256))
    texts = docs.select(F.sha2(text, 256).alias("key"), text.alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    return keyed, written(texts.select("key", F.monotonically_increasing_id().alias("no"), "text"), "texts")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they are; nothing is shuffled if the benchmark is broadcast."""
    items, place = _items(benchmark, item_col, item_text_col), docs.columns.index(text_col)
    if (shared := _broadcast(items, max_tokens)) is None:
        key = unused(docs.columns, "key")
        keyed, texts = _keyed(docs, F.coalesce(F.col(f"`{text_col}`"), F.lit("")), key)
        gone = _pairs_by_shuffle(texts, items, coverage).select(F.col("key").alias(key)).distinct()
        return keyed.join(gone, key, "left_anti").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [next(shared.value.search(t, coverage), None) is None for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(id, item_id, item_tokens, covered, tiles, coverage) for each document row and item that it contains."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    items = _items(benchmark, item_col, item_text_col)
    if (shared := _broadcast(items, max_tokens)) is None:
        keyed, texts = _keyed(rows, F.col("text"), "key")
        found = keyed.select("id", "key").join(_pairs_by_shuffle(texts, items, coverage), "key").drop("key")
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(doc, *x) for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in shared.value.search(text, coverage)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["id", *FOUND])

        found = rows.mapInArrow(run, ", ".join(f"{n} long" for n in ("id", *FOUND)))
    return found.withColumn("coverage", F.col("covered") / F.col("item_tokens")).withColumnRenamed("id", id_col)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark)
