"""Language identification by prediction by partial matching.

One byte context tree for each language, contexts of three bytes down to none,
escape method C, counts frozen after training. The code length of a text is exact:
each byte costs what the longest context that a language has seen gives it, plus
the escapes passed on the way down; a byte no context knows costs eight bits more.
The language with the shortest code wins; the score is its share of the
probability under equal priors.

The counts are gathered by Spark jobs over a bounded sample of labelled documents
(``max_docs`` a language and MAX_BYTES of text in all, chosen by hash), so that the
grams, which are collected, and the trees, which are broadcast, are bounded by it.
Texts are scored whole, in slices of a megabyte. Tables of several languages have a
column for each; where that would be too large, languages go into several tables,
in the end one for each language, with its own grams only.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and
so is every text if nothing is labelled; null ids count as held out; equal code
lengths go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ORDER = 3
#: Labelled documents of each language that the trees are built from at most, about.
MAX_DOCS = 3000
#: Bytes of text of all languages that the trees are built from at most, about; a byte adds one gram at most.
MAX_BYTES = 64 << 20
SLICE = 1 << 20
#: Code lengths (grams times languages) beyond which the languages are dealt out to several tables.
MAX_LENGTHS = 1 << 27

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def folded(text: str) -> np.ndarray:
    """UTF-8 bytes with A-Z lower-cased."""
    return _FOLD[np.frombuffer(text.encode(), np.uint8)]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of up to ORDER + 1 bytes, packed with their length on top, and how often each ends a position's context."""
    grams = []
    for text in texts:
        b = folded(text).astype(np.int64)
        for n in range(1, ORDER + 2):
            # the full length everywhere, shorter ones at the start of a text only
            ends = np.arange(n - 1, len(b)) if n == ORDER + 1 else np.arange(n - 1, min(n, len(b)))
            code = np.full(len(ends), n, np.int64)
            for k in range(n):
                code = code << 8 | b[ends - (n - 1) + k]
            grams.append(code)
    return np.unique(np.concatenate(grams) if grams else np.empty(0, np.int64), return_counts=True)


@dataclass
class Trees:
    """Context trees of all languages over one set of states.

    Level k: ``state`` maps the k-byte context to its state or -1, ``row`` maps
    (state, byte) to a row of ``bits`` (code lengths by language) or -1, and
    ``escape`` has the cost of leaving the state, by language.
    """

    langs: list[str]
    classes: np.ndarray
    n_classes: int
    state: list[np.ndarray]
    row: list[np.ndarray]
    bits: list[np.ndarray]
    escape: list[np.ndarray]


def build(langs: list[str], lang_no: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> Trees:
    """Trees from summed gram counts; lang_no: the place of each gram's language in ``langs``."""
    sizes = grams >> 8 * np.array([1, 2, 3, 4])[:, None]
    length = sum((sizes[n - 1] == n) * n for n in range(1, ORDER + 2))
    used = np.unique(np.concatenate([grams >> 8 * k & 255 for k in range(ORDER + 1)])) if len(grams) else np.empty(0, np.int64)
    a = len(used) + 1
    classes = np.full(256, a - 1, np.int64)  # the last class: bytes that training has not seen
    classes[used] = np.arange(a - 1)
    state, row, bits, escape = [], [], [], []
    n_langs = len(langs)
    lower = np.full((a, n_langs), 8.0)  # before level 0: one of 256 bytes
    for k in range(ORDER + 1):
        # a gram of at least k + 1 bytes counts at level k through its last k + 1 bytes
        at = length > k
        ctx = np.zeros(at.sum(), np.int64)
        for j in range(k, 0, -1):
            ctx = ctx * a + classes[grams[at] >> 8 * j & 255]
        sym = classes[grams[at] & 255]
        keys, inverse = np.unique(ctx * a + sym, return_inverse=True)
        n = np.zeros((len(keys), n_langs))
        np.add.at(n, (inverse, lang_no[at]), counts[at])
        owners, owner = np.unique(keys // a, return_inverse=True)
        total, kinds = np.zeros((len(owners), n_langs)), np.zeros((len(owners), n_langs))
        np.add.at(total, owner, n)
        np.add.at(kinds, owner, n > 0)
        known = total > 0
        whole = np.where(known, total + kinds, 1.0)
        left = np.where(known, -np.log2(np.where(known, kinds, 1.0) / whole), 0.0)
        if k == 0:
            below = lower[keys % a]
        else:  # the same byte one level down: it has a row there, as its shorter gram was counted too
            short = (keys // a) % a ** (k - 1)
            below = bits[k - 1][row[k - 1][state[k - 1][short] * a + keys % a]]
        own = np.where(n > 0, -np.log2(np.where(n > 0, n, 1.0) / whole[owner]), left[owner] + below)
        table = np.full(a**k, -1, np.int32)
        table[owners] = np.arange(len(owners))
        places = np.full(len(owners) * a, -1, np.int32)
        places[owner * a + keys % a] = np.arange(len(keys))
        state.append(table), row.append(places), bits.append(own), escape.append(left)
    return Trees(langs, classes, a, state, row, bits, escape)


def code_lengths(text: str, trees: Trees) -> np.ndarray:
    """Bits of the whole text by language."""
    total, b = np.zeros(len(trees.langs)), folded(text)
    for at in range(0, len(b), SLICE):
        before = min(at, ORDER)
        c = trees.classes[b[at - before : at + SLICE]]
        places = np.arange(before, len(c))
        for k in range(ORDER, -1, -1):
            here = places[places >= k] if k > before else places
            rest = places[places < k] if k > before else places[:0]
            ctx = np.zeros(len(here), np.int64)
            for j in range(k, 0, -1):
                ctx = ctx * trees.n_classes + c[here - j]
            s = trees.state[k][ctx]
            if (s < 0).any():
                rest = np.concatenate([rest, here[s < 0]])
                here, s = here[s >= 0], s[s >= 0]
            r = trees.row[k][s * trees.n_classes + c[here]]
            new = r < 0
            if new.any():
                total += trees.escape[k].take(s[new], axis=0).sum(axis=0)
                rest = np.concatenate([rest, here[new]])
                r = r[~new]
            total += trees.bits[k].take(r, axis=0).sum(axis=0)
            places = rest
            if not len(places):
                break
        total += 8.0 * len(places)
    return total


@dataclass
class Forest:
    """Trees of groups of languages, which are in order of their names."""

    groups: list[Trees]

    @property
    def langs(self) -> list[str]:
        return [lang for trees in self.groups for lang in trees.langs]

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text by language: a language's do not depend on the others in its table."""
        return np.concatenate([code_lengths(text, trees) for trees in self.groups])


def grow(langs: list[str], lang_no: np.ndarray, grams: np.ndarray, counts: np.ndarray, most: int) -> Forest:
    """Trees in as few tables as have ``most`` code lengths together; one for each language if no others do."""
    size = lambda a, b: len(np.unique(grams[(lang_no >= a) & (lang_no < b)])) * (b - a)
    parts = [(size(0, len(langs)), 0, len(langs))]
    while sum(n for n, _, _ in parts) > most and any(b - a > 1 for _, a, b in parts):
        largest = max((p for p in parts if p[2] - p[1] > 1), key=lambda p: p[0])
        parts.remove(largest)
        _, a, b = largest
        middle = (a + b) // 2
        parts += [(size(a, middle), a, middle), (size(middle, b), middle, b)]
    out = []
    for _, a, b in sorted(parts, key=lambda p: p[1]):
        own = (lang_no >= a) & (lang_no < b)
        out.append(build(langs[a:b], lang_no[own] - a, grams[own], counts[own]))
    return Forest(out)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, max_docs: int, max_lengths: int = MAX_LENGTHS) -> Forest | None:
    """Trees from a sample of the rows for which ``learn`` holds; None if there are none."""
    labelled = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r for r in labelled.groupBy(F.col(lang_col).alias("l")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("b")).collect()}  # one row a language
    if not sizes:
        return None
    langs = sorted(sizes)
    shares = {l: min(1.0, max_docs / r["n"], MAX_BYTES / len(sizes) / max(1, r["b"])) for l, r in sizes.items()}  # noqa: E741
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(3)), F.lit(1_000_000))
    share = F.element_at(F.create_map(*[F.lit(x) for l in langs for x in (l, int(1_000_000 * shares[l]))]), F.col(lang_col))  # noqa: E741
    sample = labelled.filter(place <= share).select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                grams, n = gram_counts(texts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["l", "gram", "n"])

    summed = sample.mapInArrow(count, "l string, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n")).toArrow()
    no = pc.index_in(summed["l"], pa.array(langs, pa.string())).to_numpy().astype(np.int64)
    return grow(langs, no, summed["gram"].to_numpy(), summed["n"].to_numpy().astype(np.float64), max_lengths)


def predict(docs: DataFrame, trees: Forest | None, keep: list[Column], text_col: str) -> DataFrame:
    """``keep`` and lang_pred, score for each row."""
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if trees is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(*keep, F.when(lettered, F.col(text_col)).alias("text_to_score"))  # by place: a clash of names does no harm
    model, kept = docs.sparkSession.sparkContext.broadcast(trees), rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        names = trees.langs
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(len(kept)).to_pylist():
                if text is None:
                    langs.append("und"), scores.append(0.0)
                    continue
                bits = trees.code_lengths(text)
                best = int(bits.argmin())
                langs.append(names[best]), scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes[:-1]), "lang_pred string", "score double"])
    return rows.mapInArrow(run, schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    return predict(docs, train(docs, "doc_id", "text", "lang", ~held_out, MAX_DOCS), [F.col("doc_id"), held_out.alias("held_out")], "text")
