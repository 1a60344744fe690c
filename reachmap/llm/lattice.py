"""Language-model scores: word counts, and a subword lattice.

The base score of a text is the add-one unigram probability of its tokens under
counts of all training texts. The lattice score takes the pieces of an existing
vocabulary, weighted by its own scores, and sums over all segmentations of every
word by the forward recursion in log space. A word that training has counted is
one edge more in its lattice, from end to end, weighted by its count; WORD_SHARE
of the probability goes to these edges; ``pieces_score`` is what the lattice gives without them. Pieces don't go on over a space, so the
lattice of a text is the product of the lattices of its words, and each distinct
word of the corpus is worked out once.

Counts of a whole corpus are too large to be broadcast. So one pass over the texts
cuts the input into blocks of some megabytes; a block's texts become arrays of
places in the block's own word list. Word lists are counted and joined with the
corpus counts by shuffles, come back to their block, and texts are scored by
looking up the places. Blocks are written once, so a re-run task can't renumber;
they are dealt out in turn, so that no task gets more of them than another.

A vocabulary whose scores are log probabilities is used as it is; one whose scores
are merge ranks gets p ~ 1 / (rank + 2.7), Zipf's law. An end token closes every
text, with its probability from the training counts; the pieces share the rest.

Defined cases: a null text is the empty text (one token, the end); null ids are
held out; without training texts N and V are 0, and without training words the
pieces have all of the probability; repeated rows are scored and counted as often
as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vocab as vocabs
from ..storage import written
from .vocab import Vocab

#: Probability of the edges that are whole words of the training texts.
WORD_SHARE = 0.5
#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20
BLOCKS = "block long, word binary, place int, n long, id long, held_out boolean, places binary"


class Places(dict):
    """Word to its place, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def packed(places: np.ndarray) -> bytes:
    """Places byte plane by byte plane: the upper planes are nearly empty and cost little once compressed."""
    return places.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4")[:, 0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of BLOCKS: for each block its texts, then its words with their training counts."""
    schema = pa.schema([("block", pa.int64()), ("word", pa.binary()), ("place", pa.int32()), ("n", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("places", pa.binary())])

    def rows(size: int, **given: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

    block, size, words, counted = TaskContext.get().partitionId() << 32, 0, Places(), []

    def close() -> Iterator[pa.RecordBatch]:
        n = np.bincount(np.concatenate(counted), minlength=len(words)) if counted else np.zeros(len(words), np.int64)
        held = list(words)
        for at in range(0, len(held), 50_000):
            part = held[at : at + 50_000]
            yield rows(len(part), block=pa.array(np.full(len(part), block)), word=pa.array(part, pa.binary()), place=pa.array(np.arange(at, at + len(part), dtype=np.int32)), n=pa.array(n[at : at + len(part)]))

    for batch in batches:
        ids, outs, texts = (c.to_pylist() for c in batch.columns)
        start, places = 0, []
        for k, text in enumerate(texts):
            raw = text.encode().lower()
            own = np.fromiter(map(words.__getitem__, raw.split()), np.int32)
            places.append(packed(own))
            if not outs[k]:
                counted.append(own)
            size += len(raw)
            if size >= BLOCK_BYTES or k + 1 == len(texts):
                m = k + 1 - start
                yield rows(m, block=pa.array(np.full(m, block)), id=pa.array(ids[start : k + 1], pa.int64()), held_out=pa.array(outs[start : k + 1], pa.bool_()), places=pa.array(places, pa.binary()))
                start, places = k + 1, []
            if size >= BLOCK_BYTES:
                yield from close()
                block, size, words, counted = block + 1, 0, Places(), []
    if len(words):
        yield from close()


def piece_weights(vocab: Vocab) -> tuple[dict[str, float], float]:
    """Natural log weight of each piece, and of one byte of a character without a piece; in all they make 1."""
    scores = np.array([s for _, s in vocab.pieces.values()])
    if 0.5 < np.exp(np.minimum(scores, 0.0)).sum() < 1.5:
        logs, byte = scores, scores.min() - 10
    else:
        order = np.argsort(-scores, kind="stable")
        logs = np.empty(len(scores))
        logs[order] = -np.log(np.arange(len(scores)) + 2.7)
        byte = -math.log(len(scores) + 2.7)
    total = math.log(np.exp(logs).sum() + 256 * math.exp(byte))
    return dict(zip(vocab.pieces, (logs - total).tolist(), strict=True)), byte - total


def log_marginal(word: str, weights: dict[str, float], byte: float, longest: int) -> float:
    """Natural log of the summed weight of all segmentations of ``word``."""
    n, get, log, exp = len(word), weights.get, math.log, math.exp
    ends: list[list[float]] = [[] for _ in range(n + 1)]
    ends[0].append(0.0)
    for i in range(n):
        found = ends[i]
        if not found:
            continue
        if len(found) == 1:
            here = found[0]
        else:
            top = max(found)
            here = top + log(sum([exp(x - top) for x in found]))
        ends[i] = found[:0]
        first = get(word[i])
        ends[i + 1].append(here + (byte * len(word[i].encode()) if first is None else first))
        for j in range(i + 2, min(n, i + longest) + 1):
            w = get(word[i:j])
            if w is not None:
                ends[j].append(here + w)
    top = max(ends[n])
    return top + log(sum([exp(x - top) for x in ends[n]]))


def with_words(z: np.ndarray, c: np.ndarray, tokens: int) -> np.ndarray:
    """Log10 weights of words from those of their pieces' segmentations and from their counts among ``tokens`` training words."""
    if not tokens:
        return z
    with np.errstate(divide="ignore"):
        return np.logaddexp(z * math.log(10) + math.log(1 - WORD_SHARE), np.log(c) + math.log(WORD_SHARE / tokens)) / math.log(10)


def lattice_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", path: str = vocabs.DEFAULT_PATH) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, pieces_score) for each row; scores in log10, the last one by the vocabulary's pieces and the end alone."""
    spark = docs.sparkSession
    vocab = vocabs.load(path)
    weights, byte = piece_weights(vocab)
    shared = spark.sparkContext.broadcast((weights, byte, vocab.longest))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = written(texts.mapInArrow(_blocks, BLOCKS), "blocks")
    words, rows = blocks.filter("word is not null").select("block", "word", "place", "n"), blocks.filter("word is null").select(F.col("block").alias("own"), "id", "held_out", "places")

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, byte, longest = shared.value
        for batch in batches:
            z = [log_marginal(" " + w.decode(), weights, byte, longest) / math.log(10) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(z, pa.float64())], ["word", "c", "z"])

    counts = words.groupBy("word").agg(F.sum("n").alias("c"))
    known = written(counts.mapInArrow(marginals, "word binary, c long, z double"), "words")
    ends, last = rows.agg(F.count_if(~F.col("held_out")), F.coalesce(F.max("own"), F.lit(0))).first()
    tokens, distinct = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, kinds = tokens + ends, distinct + (ends > 0)
    whole = math.log10(total + kinds + 1)
    end = math.log10(ends + 1) - whole
    inside = math.log10(1 - 10**end) if ends and end < 0 else 0.0

    def scores(own: pa.RecordBatch, logs: np.ndarray, seen: np.ndarray, z: np.ndarray, pieces: np.ndarray) -> pa.RecordBatch:
        places = [unpacked(p) for p in own["places"].to_pylist()]
        return pa.RecordBatch.from_pydict({
            "id": own["id"], "held_out": own["held_out"], "n_tokens": pa.array([len(p) + 1 for p in places], pa.int64()),
            "n_known": pa.array([int(seen[p].sum()) + (ends > 0) for p in places], pa.int64()),
            "base_score": pa.array([float(logs[p].sum()) - len(p) * whole + end for p in places], pa.float64()),
            "score": pa.array([float(z[p].sum()) + len(p) * inside + end for p in places], pa.float64()),
            "pieces_score": pa.array([float(pieces[p].sum()) + len(p) * inside + end for p in places], pa.float64()),
        })

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block, the block's words before its texts."""
        block, table, looked_up = None, [], None
        for batch in batches:
            blocks, texts = batch["block"].to_numpy(), batch["is_text"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(texts) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                part = batch.slice(a, b - a)
                if not len(part):
                    continue
                if block != blocks[a]:
                    block, table, looked_up = blocks[a], [], None
                if not texts[a]:
                    table.append([part[n].to_numpy() for n in ("place", "c", "z")])
                    continue
                if looked_up is None:
                    place, c, z = (np.concatenate([x[k] for x in table]) for k in range(3)) if table else (np.empty(0, np.int32), np.empty(0), np.empty(0))
                    by = np.argsort(place)  # every place of the list once
                    looked_up = np.log10(c[by] + 1), c[by] > 0, with_words(z[by], c[by], tokens), z[by]
                yield scores(part, *looked_up)

    table = words.join(known, "word").select("block", F.lit(False).alias("is_text"), "place", "c", "z")
    both = table.unionByName(rows.select(F.col("own").alias("block"), F.lit(True).alias("is_text"), "id", "held_out", "places"), allowMissingColumns=True)
    # the k-th block of an input task: in turn over the tasks, then over k
    task, k = F.shiftright("block", 32), F.col("block").bitwiseAND(F.lit(0xFFFFFFFF))
    deal = F.pmod(task + k * ((last >> 32) + 1), F.lit(1 << 30)).cast("int")
    dealt = both.repartitionById(int(spark.conf.get("spark.sql.shuffle.partitions")), deal).sortWithinPartitions("block", "is_text")
    scored = dealt.mapInArrow(score, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, pieces_score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "pieces_score")


def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return lattice_scores(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True)))
