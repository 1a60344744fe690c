"""Quality classifier: averaged subword embeddings and a softmax.

Words, pairs of words and character 3- to 5-grams (a word's edge counts as a
character) are hashed into buckets, each with a vector. A document is the mean of
its vectors; a softmax over two classes gives the score. Vectors and weights are
trained by stochastic gradient descent in numpy over a bounded sample of labelled
documents: their features are counted in all tasks, and one task takes the steps.
Scoring needs one number a bucket, the share of the bucket's vector in the log
odds, so that table is what is broadcast.

Defined cases: a null text is the empty text, whose score is that of the bias;
with labels of one class only the score is 1 or 0 for all, with none 0.5;
documents labelled both ways are not learned from; null ids are held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written

BUCKETS_LOG2, DIM, EPOCHS, RATE = 18, 16, 4, 0.5
#: Labelled documents of each class that the model is fitted on at most, about, and distinct features of theirs in all.
MAX_DOCS, MAX_FEATURES = 2500, 40_000_000
#: Characters that are hashed at once.
SLICE = 1 << 20

#: Bucket of the pair of a word and itself.
REPEATED = 1

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POW = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


def _buckets(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return (h >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)


def features(text: str) -> Iterator[np.ndarray]:
    """Buckets of all features of a text, repeats included, by slices.

    A word or gram that goes over a cut is the same feature as without the cut: the hash of
    the open word and the last word's hash are carried on, and grams look back.
    """
    text = f" {text} "
    open_hash, open_size, before = np.uint64(0), 0, np.empty(0, np.uint64)
    for at in range(0, len(text), SLICE):
        back = min(at, 4)
        u = np.frombuffer(text[at - back : at + SLICE].encode("utf-32-le"), np.uint32)
        space = (u == 32) | ((u >= 9) & (u <= 13))
        u, inside = np.where(space, 32, u).astype(np.uint64), ~space
        words, open_hash, open_size = _words(u[back:], inside[back:], open_hash, open_size)
        words = np.concatenate([before, words])
        fresh = words[len(before) :]
        yield _buckets(fresh)
        yield _buckets(words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[1:])
        # a word said twice in a row is the same feature for all words
        yield np.full(int((words[:-1] == words[1:]).sum()), REPEATED)
        before = words[-1:]
        # every character of a gram but the first and last is inside the word; the last one is of this slice
        gram, ok = u[:-1] * _POW[0] + u[1:] * _POW[1], np.ones(max(0, len(u) - 1), bool)
        for n in (3, 4, 5):
            if len(u) < n:
                break
            gram = gram[: len(u) - n + 1] + u[n - 1 :] * _POW[n - 1]
            ok = ok[: len(u) - n + 1] & inside[n - 2 : len(u) - 1]
            first = max(0, back - n + 1)
            yield _buckets(gram[first:][ok[first:]] + np.uint64(n))


def _words(u: np.ndarray, inside: np.ndarray, open_hash: np.uint64, open_size: int) -> tuple[np.ndarray, np.uint64, int]:
    """Hashes of the words that end in a slice, and hash and size of the one that is open at its end; ``open_``: that of the slice before."""
    at = np.flatnonzero(inside)
    begins = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    done = [np.array([open_hash], np.uint64)] if open_size and not inside[:1].any() else []
    if not len(at):
        return np.concatenate([np.empty(0, np.uint64), *done]), np.uint64(0), 0
    goes_on = bool(open_size and inside[0])
    run = np.searchsorted(at, begins)
    place = at - np.repeat(begins, np.diff(np.append(run, len(at))))
    if goes_on:
        place[: (run[1] if len(run) > 1 else len(at))] += open_size
    hashes = np.add.reduceat(u[at] * _POW[place & 63], run)
    if goes_on:
        hashes[:1] += open_hash  # an array: sums go round at 64 bits
    if inside[-1]:
        return np.concatenate([*done, hashes[:-1]]), hashes[-1], int(place[-1]) + 1
    return np.concatenate([*done, hashes]), np.uint64(0), 0


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and each one's share of its features."""
    ids, counts = np.unique(np.concatenate(list(features(text or ""))), return_counts=True)
    return ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    """``share``: each bucket's part in the log odds of class 1; ``bias``: the log odds of an empty text."""

    share: np.ndarray
    bias: float

    def log_odds(self, text: str | None) -> float:
        total, n = 0.0, 0
        for f in features(text or ""):
            total, n = total + float(self.share[f].sum(dtype=np.float64)), n + len(f)
        return self.bias + (total / n if n else 0.0)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Stochastic gradient descent over documents (buckets, shares); a step moves the mean vector as far in long texts as in short ones."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BUCKETS_LOG2, DIM)).astype(np.float32)
    out = rng.uniform(-1 / DIM, 1 / DIM, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, share = docs[i]
            mean = share @ vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            g = (p * min(1.0, weights[i])).astype(np.float32)
            if len(ids):
                vectors[ids] -= np.outer(share * np.float32(rate / (share @ share)), g @ out)
            out -= rate * np.outer(g, mean)
            bias -= rate * 0.1 * g
    lean = out[1] - out[0]
    return Model((vectors @ lean).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column, max_docs: int = MAX_DOCS) -> Model | float:
    """A model from the labelled rows for which ``learn`` holds, or the one score that all texts get."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & learn)
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").select("id", "y")
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes), 0.5))
    place = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000))
    share = {y: min(1.0, max_docs / n) for y, n in sizes.items()}
    within = lambda s: F.col("place") < F.when(F.col("y") == 1, int(1e6 * s[1])).otherwise(int(1e6 * s[0]))
    sample = known.withColumn("place", place).filter(within(share))
    # about 2 * max_docs ids, so the documents are not shuffled
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    texts = texts.select("y", "place", F.xxhash64("id", "text").alias("tie"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [counted(t) for t in batch.column(3).to_pylist()]
            ids, shares = (pa.array([x[k] for x in done], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.float32())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], ids, shares], ["y", "place", "tie", "ids", "shares"])

    rows = written(texts.mapInArrow(count, "y int, place long, tie long, ids array<int>, shares array<float>"), "labelled")
    held = rows.agg(F.sum(F.size("ids"))).first()[0] or 0
    if held > MAX_FEATURES:
        share = {y: s * MAX_FEATURES / held for y, s in share.items()}
        rows = rows.filter(within(share))
    most = max(1 / s for s in share.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        order = np.lexsort((table["tie"].to_numpy(), table["place"].to_numpy()))
        y = table["y"].to_numpy()[order]
        if len(set(y.tolist())) == 2:
            ids, shares = ([x.values.to_numpy() for x in table[c]] for c in ("ids", "shares"))  # views: the features are held once
            model = fit([(ids[i], shares[i]) for i in order.tolist()], y, np.where(y == 1, 1 / share[1], 1 / share[0]) / most)
            yield pa.RecordBatch.from_arrays([pa.array([model.share.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], ["share", "bias"])

    row = rows.repartition(1).mapInArrow(run, "share binary, bias double").first()
    if row is None:
        return sizes.get(1, 0) / sum(sizes.values())
    return Model(np.frombuffer(row["share"], np.float32), row["bias"])


def score(docs: DataFrame, model: Model | float, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` and the score of each row."""
    if isinstance(model, float):
        return docs.select(*keep, F.lit(model).alias("score"))
    rows = docs.select(*keep, F.col(text_col).alias("text_to_score"))  # by place: a clash of names does no harm
    shared, kept = docs.sparkSession.sparkContext.broadcast(model), rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            odds = np.array([model.log_odds(t) for t in batch.column(len(kept)).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], [*kept, "score"])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes[:-1]), "score double"])
    return rows.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model | float, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is ``threshold`` or more, all columns as they are."""
    if isinstance(model, float):
        return docs if model >= threshold else docs.limit(0)
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)
    least = math.log(threshold / (1 - threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield batch.filter(pa.array([model.log_odds(t) >= least for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def quality_scores(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` (columns of documents), held_out and score for each document."""
    model = train(docs, labels, "doc_id", "text", "quality", ~held_out("id"))
    return score(docs, model, "text", [*map(F.col, keep), held_out().alias("held_out")])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_scores(docs, labels, ["doc_id"]).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
