"""SentencePiece encoding and decoding as a max-plus scan.

A text, with one space put before it, is cut into the vocabulary's pieces so that
the sum of the piece scores is greatest (the Viterbi path over the model file's
own scores, as for a unigram model). Characters without a piece fall back to their
UTF-8 bytes, so decoding gives back the text exactly.

A long text is split into chunks. A chunk's transfer matrix M[i, j] is the best
score if the chunk before reaches i characters into this one and this one j
characters into the next. Matrices combine by max-plus products, an associative
operation; the tree of products gives the best state at every boundary, and with
these each chunk is traced on its own. Equal long texts are worked on once.

Defined cases: null text gives null ids and decodes to null; the empty text has no
ids; repeated rows stay repeated; of paths of equal score any one is taken, the
same in each run.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vocab as vocabs
from ..storage import written
from .names import unused
from .vocab import Vocab

#: Characters in a chunk; longer texts are split.
CHUNK = 1 << 15
#: Stretches that a worker remembers.
CACHE = 250_000
#: Characters of text whose new stretches are traced together, the fewest of these, and the longest.
TOGETHER, FEWEST, LONGEST = 1 << 20, 64, 48


class Walk:
    """The beginnings of pieces as numbered nodes, 0 being none; many walks take a step by one search in the sorted (node, character) pairs."""

    def __init__(self, vocab: Vocab) -> None:
        number = {b: k for k, b in enumerate(vocab.begins, 1)}
        steps = sorted((number.get(b[:-1], 0) << 21 | ord(b[-1]), k) for b, k in number.items())
        self.keys, self.nodes = np.array(steps, np.int64).T.copy()
        hits = [None, *vocab.begins.values()]
        self.piece = np.array([h[0] if h else -1 for h in hits], np.int32)
        self.score = np.array([h[1] if h else vocab.unk_score for h in hits])

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        keys = nodes << 21 | chars
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.nodes[at], 0)


class Encoder(dict):
    """Best path of independent stretches of text, remembered: stretch to packed int32 ids."""

    def __init__(self, vocab: Vocab) -> None:
        super().__init__()
        self.vocab, self.walk = vocab, Walk(vocab)
        self.parts = re.compile(r"\n| *[^ \n]+| +" if vocab.cuts_at_line else r" *[^ ]+| +") if vocab.cuts_at_space else re.compile(r"(?s).+")

    def __missing__(self, text: str) -> bytes:
        ids = self.trace(text)
        # common stretches come early; what is met after that is mostly met once
        if len(self) < CACHE and len(text) <= 64:
            self[text] = ids
        return ids

    def trace(self, text: str) -> bytes:
        v, n = self.vocab, len(text)
        begins, worst = v.begins, v.unk_score
        best, back = [-math.inf] * (n + 1), [(0, 0)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            so_far, j = best[i], i + 1
            hit = begins.get(text[i], 0)
            single = so_far + (hit[1] if hit else worst)
            if single > best[j]:
                best[j], back[j] = single, (i, hit[0] if hit else -1)
            while hit != 0 and j < n:  # 0: no piece begins like this
                j += 1
                hit = begins.get(text[i:j], 0)
                if hit and so_far + hit[1] > best[j]:
                    best[j], back[j] = so_far + hit[1], (i, hit[0])
        ids: list[int] = []
        while n:
            i, piece = back[n]
            if piece >= 0:
                ids.append(piece)
            elif v.byte_ids:
                ids += [v.byte_ids[b] for b in reversed(text[i:n].encode())]
            else:
                ids.append(v.unk_id)
            n = i
        ids.reverse()
        return array("i", ids).tobytes()

    def trace_all(self, words: list[str]) -> list[bytes]:
        """``trace`` of many non-empty stretches at once: the same sums in the same order, so the same paths."""
        walk, sizes = self.walk, np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1  # states: one more than characters in each stretch
        inner = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = np.repeat(sizes, sizes) - inner
        walking, node, length = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        found = []
        while len(walking):
            node = walk.step(node, chars[walking + length])
            length += 1
            hit = walk.piece[node] >= 0 if length > 1 else slice(None)  # a character without a piece is an edge too
            found.append((walking[hit], np.full(len(walking[hit]), length), node[hit]))
            on = (node > 0) & (left[walking] > length)
            walking, node = walking[on], node[on]
        begin, length, node = (np.concatenate(x) for x in zip(*found, strict=True))
        group = inner[begin] << 32 | length
        order = np.argsort(group, kind="stable")
        begin, length, node, group = begin[order], length[order], node[order], group[order]
        source, piece, score = inner[begin] + np.repeat(starts, sizes)[begin], walk.piece[node], walk.score[node]
        best, back = np.full(len(chars) + len(words), -np.inf), np.zeros(len(chars) + len(words), np.int64)
        best[starts] = 0.0
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # edges of one begin and one length: each stretch has one at most
            to, total = source[a:b] + length[a], best[source[a:b]] + score[a:b]
            better = np.flatnonzero(total > best[to])
            best[to[better]], back[to[better]] = total[better], better + a
        who, at, taken = np.arange(len(words)), starts + sizes, []
        while len(who):
            edge = back[at]
            taken.append((who, piece[edge]))
            at = at - length[edge]
            on = at > starts[who]
            who, at = who[on], at[on]
        count = np.bincount(np.concatenate([w for w, _ in taken]), minlength=len(words))
        ends, ids, by_bytes = np.cumsum(count), np.empty(count.sum(), np.int32), np.zeros(len(words), bool)
        for k, (w, p) in enumerate(taken, 1):  # from the end of each stretch
            ids[ends[w] - k] = p
            by_bytes[w[p < 0]] = True
        packed, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [self.trace(w) if odd else packed[a:b] for w, odd, a, b in zip(words, by_bytes.tolist(), cuts[:-1], cuts[1:], strict=True)]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that already have their leading space."""
        out, begin, held = [], 0, 0
        for k, text in enumerate(texts, 1):
            held += len(text)
            if held < TOGETHER and k < len(texts):
                continue
            parts = [self.parts.findall(t) for t in texts[begin:k]]
            new = [p for p in set(chain.from_iterable(parts)) - self.keys() if len(p) <= LONGEST]
            if len(new) >= FEWEST:
                self.update(zip(new, self.trace_all(new), strict=True))
            out += [np.frombuffer(b"".join(map(self.__getitem__, p)), np.int32) for p in parts]
            if len(self) > CACHE:
                for p in new:
                    self.pop(p, None)
            begin, held = k, 0
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of one such text."""
        return self.encode_all([text])[0]

    def score(self, text: str) -> float:
        """Score of the best path."""
        v, total = self.vocab, 0.0
        for part in self.parts.findall(text):
            total += self.forward(part, len(part), 1)[0, len(part)]
        return float(total)

    def forward(self, text: str, n: int, entries: int) -> np.ndarray:
        """[i, p]: best score from i to p, for i below ``entries``, by pieces that start before ``n``."""
        v, reach = self.vocab, len(text)
        best = np.full((entries, reach + 1), -np.inf)
        for i in range(min(entries, reach + 1)):
            best[i, i] = 0.0
        for i in range(n):
            so_far = best[:, i].copy()
            for j in range(i + 1, min(reach, i + v.longest) + 1):
                hit = v.pieces.get(text[i:j])
                score = hit[1] if hit else v.unk_score if j == i + 1 else None
                if score is not None:
                    np.maximum(best[:, j], so_far + score, out=best[:, j])
        return best

    def transfer(self, chunk: str, n: int) -> np.ndarray:
        """Transfer matrix of a chunk of ``n`` characters; what follows them in ``chunk`` is the start of the next."""
        s, ahead = self.vocab.longest, len(chunk) - n
        out = np.full((s, s), -np.inf)
        cuts = [m.start() for m in self.parts.finditer(chunk[:n]) if m.start() >= s] if n > s else []
        if len(cuts) < 2:
            best = self.forward(chunk, n, s)
            for j in range(min(s - 1, ahead) + 1):
                out[:, j] = best[:, n + j]
            return out
        first, last = cuts[0], cuts[-1]
        head = self.forward(chunk[:first], first, s)[:, first]
        middle = self.encode(chunk[first:last])
        tail = self.forward(chunk[last:], n - last, 1)[0, n - last :]
        out[:, : len(tail[:s])] = head[:, None] + self.path_score(middle) + tail[None, :s]
        return out

    def path_score(self, ids: np.ndarray) -> float:
        """Score of ids: those of one character's bytes count as one unknown character."""
        scores = self.vocab.scores[ids]
        if self.vocab.byte_ids:
            is_byte = np.isin(ids, self.vocab.byte_ids)
            if is_byte.any():
                lead = np.array([self.vocab.bytes_of[i][0] & 0xC0 != 0x80 for i in ids[is_byte].tolist()])
                return float(scores[~is_byte].sum() + lead.sum() * self.vocab.unk_score)
        return float(scores.sum())


_kept: list[Encoder] = []


def encoder_of(vocab: Vocab) -> Encoder:
    """The encoder of this worker: tasks that run in it one after the other share what it remembers."""
    if not _kept or _kept[0].vocab is not vocab:
        _kept[:] = [Encoder(vocab)]
    return _kept[0]


def text_of(ids: np.ndarray, vocab: Vocab) -> str:
    """The text that ids stand for, with the leading space."""
    return b"".join(map(vocab.bytes_of.__getitem__, ids.tolist())).decode(errors="replace")


def boundaries(matrices: list[np.ndarray]) -> list[int]:
    """States before the first chunk, between chunks and after the last one, on the best path from 0 to 0."""
    levels = [matrices]
    while len(levels[-1]) > 1:  # upwards: max-plus products of neighbours
        m = levels[-1]
        levels.append([(a[:, :, None] + b[None]).max(axis=1) for a, b in zip(m[::2], m[1::2])] + m[len(m) - len(m) % 2 :])  # noqa: B905
    ends = [0, 0]
    for m in reversed(levels[:-1]):  # downwards: the state between two factors
        out = [ends[0]]
        for k in range(0, len(m), 2):
            after = ends[k // 2 + 1]
            if k + 1 < len(m):
                out.append(int((m[k][out[-1]] + m[k + 1][:, after]).argmax()))
            out.append(after)
        ends = out
    return ends


def _long_ids(texts: DataFrame, shared, chunk: int) -> DataFrame:
    """(key, ids, exact) for texts (key, text), each key once."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = shared.value.longest - 1
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = " " + text
                for no, at in enumerate(range(0, len(text), chunk)):
                    own = text[at : at + chunk + ahead]
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([no], pa.int32()), pa.array([min(chunk, len(text) - at)], pa.int32()), pa.array([own])], ["key", "no", "n", "part"])

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            m = [encoder.transfer(p, n).ravel() for n, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(m, pa.list_(pa.float64()))], ["key", "no", "m"])

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        size = shared.value.longest
        ends = boundaries([np.array(m).reshape(size, size) for m in table["m"].to_pylist()])
        return pa.table({"key": table["key"], "no": table["no"], "begin": pa.array(ends[:-1], pa.int32()), "over": pa.array(ends[1:], pa.int32())})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            parts = [p[b : n + o] for n, p, b, o in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)]
            ids = encoder.encode_all(parts)
            exact = [text_of(i, encoder.vocab) == p for p, i in zip(parts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(exact)], ["key", "no", "ids", "exact"])

    chunks = written(texts.mapInArrow(split, "key string, no int, n int, part string"), "chunks")
    placed = chunks.mapInArrow(transfers, "key string, no int, m array<double>").groupBy("key").applyInArrow(states, "key string, no int, begin int, over int")
    traced = chunks.join(placed, ["key", "no"]).select("key", "no", "n", "part", "begin", "over").mapInArrow(trace, "key string, no int, ids array<int>, exact boolean")
    return traced.groupBy("key").agg(F.bool_and("exact").alias("exact"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))), lambda x: x["ids"])).alias("ids"))


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", exact_col: str = "exact", path: str = vocabs.DEFAULT_PATH, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the ids (array of int), and whether they decode to the text; both take the place of columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabs.load(path))
    chunk = max(chunk, shared.value.longest)
    docs = docs.drop(ids_col, exact_col)
    names = docs.columns
    whole = docs.filter(F.col(text_col).isNull() | (F.length(text_col) < chunk))
    own_key, own_ids, own_exact = (unused(names, n) for n in ("own_key", "own_ids", "own_exact"))
    long = docs.filter(F.length(text_col) >= chunk).withColumn(own_key, F.sha2(text_col, 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = encoder_of(shared.value), names.index(text_col)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = encoder.encode_all([" " + t if t else "" for t in texts])
            ids = [None if t is None else i for t, i in zip(texts, found, strict=True)]
            exact = [t is None or text_of(i, encoder.vocab)[1:] == t for t, i in zip(texts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(exact, pa.bool_())], [*names, ids_col, exact_col])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), f"`{ids_col}` array<int>", f"`{exact_col}` boolean"])
    short = whole.mapInArrow(run, schema)
    ids = _long_ids(long.select(F.col(own_key).alias("key"), F.col(text_col).alias("text")).dropDuplicates(["key"]), shared, chunk)
    joined = long.join(ids.select(F.col("key").alias(own_key), F.col("ids").alias(own_ids), F.col("exact").alias(own_exact)), own_key).select(*[F.col(f"`{n}`") for n in names], F.col(own_ids).alias(ids_col), F.col(own_exact).alias(exact_col))
    return short.unionByName(joined)


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str = vocabs.DEFAULT_PATH) -> DataFrame:
    """``encoded`` with the text of its ids in ``text_col`` (it takes the place of a column of that name)."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabs.load(path))
    encoded = encoded.drop(text_col)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, place = shared.value.bytes_of.__getitem__, names.index(ids_col)
        for batch in batches:
            column = batch.column(place)
            offsets, values = column.offsets.to_pylist(), column.values.to_pylist()
            texts = [None if null else b"".join(map(piece, values[a:b]))[1:].decode(errors="replace") for null, a, b in zip(column.is_null().to_pylist(), offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, text_col])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in encoded.dtypes), f"`{text_col}` string"])
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = vocabs.DEFAULT_PATH) -> DataFrame:
    """(id, n_chars, n_tokens, ids_hash, exact) for each row: exact if decoding gave the text back."""
    done = encode(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), path=path)
    return done.select(F.col("id").alias(id_col), F.length("text").alias("n_chars"), F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "exact")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
