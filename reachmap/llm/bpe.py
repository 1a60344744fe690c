"""Byte-level BPE encoding and decoding by ranks, with a segment tree over the bytes.

A pattern cuts a text into matches, each encoded alone. A match that is a token is
that token. Any other starts as its bytes; of all neighbouring pairs whose joined
bytes are a token, the one of least rank, the leftmost among equals, is joined, until
none is left. A segment tree over the byte positions holds for each stretch of
positions the least (rank, position) of the pairs that begin there, so its root is
the pair to join, and a join changes three leaves: a match of n bytes takes
O(n log n) steps, whatever is in it.

Defined cases: a null text counts as empty; an empty one has no ids; characters that
no match holds (patterns may leave some out) are in no token; bytes that are not
UTF-8 are read as U+FFFD; repeated rows stay repeated; an empty table gives no rows;
further columns stay, but for those of the output's names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .names import unused

DEFAULT_FILE = "byte_bpe_multi_50k.tiktoken"
#: No pair of these positions can be joined.
NONE = (1 << 63) - 1
#: Positions have so many bits below the rank in a leaf.
PLACE_BITS = 36
#: Matches that a worker remembers, and the most characters of each.
CACHE, CACHED_LENGTH = 300_000, 48
#: From this many bytes on, trees are packed arrays.
PACKED = 1 << 12


def default_path() -> str:
    """Where the vocabulary file of the installed package is."""
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, which is the id, of a file with a base64 token and a rank on each line. Read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class PairTree:
    """The least (rank << PLACE_BITS | position) over byte positions, by a segment tree: the root is ``tree[1]``."""

    def __init__(self, leaves: list[int]) -> None:
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        many = 2 * self.size
        self.tree = array("q", [NONE]) * many if many >= PACKED else [NONE] * many
        self.tree[self.size : self.size + len(leaves)] = array("q", leaves) if many >= PACKED else leaves
        for k in range(self.size - 1, 0, -1):
            a, b = self.tree[2 * k], self.tree[2 * k + 1]
            self.tree[k] = a if a < b else b

    def put(self, place: int, key: int) -> None:
        """Point update; it ends where a stretch's least stays what it was."""
        tree, k = self.tree, self.size + place
        tree[k] = key
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                break
            tree[k] = least


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    # token i covers the bytes from i to after[i]; before[i] is where the token on its left begins
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = ranks.get
    tree = PairTree([NONE if (r := rank(piece[i : i + 2])) is None else r << PLACE_BITS | i for i in range(n - 1)])
    root, mask = tree.tree, (1 << PLACE_BITS) - 1
    while n > 1 and (least := root[1]) != NONE:
        i = least & mask
        j = after[i]
        end = after[j]
        after[i] = end
        tree.put(j, NONE) if j < n - 1 else None
        if end < n:
            before[end] = i
            r = rank(piece[i : after[end]])
            tree.put(i, NONE if r is None else r << PLACE_BITS | i)
        else:
            tree.put(i, NONE)
        if (left := before[i]) >= 0:
            r = rank(piece[left:end])
            tree.put(left, NONE if r is None else r << PLACE_BITS | left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Encoder(dict):
    """Packed little-endian 32-bit ids of matches, remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        super().__init__()
        self.ranks, self.pattern = ranks, pattern
        self.matches = regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}

    def __missing__(self, match: str) -> bytes:
        ids = merge(match.encode(), self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < CACHE and len(match) <= CACHED_LENGTH:
            self[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.matches.findall(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_kept: list[Encoder] = []


def encoder_of(shared) -> Encoder:
    """The encoder of this worker: the tasks that run in it share what it remembers."""
    ranks, pattern = shared.value
    if not _kept or _kept[0].ranks is not ranks or _kept[0].pattern != pattern:
        _kept[:] = [Encoder(ranks, pattern)]
    return _kept[0]


def _shared(spark: SparkSession, path: str | None, pattern: str | None):
    return spark.sparkContext.broadcast((load_ranks(path or default_path()), pattern or default_pattern()))


def _packed_list(packed: list[bytes]) -> pa.Array:
    """A list of ids for each packed text, without a Python number for any id."""
    offsets = [0]
    for p in packed:
        offsets.append(offsets[-1] + len(p) // 4)
    values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _pieces(batch: pa.RecordBatch, column: int, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes in one column, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with the ids of the whole text (array of int); they take the place of a column of that name."""
    shared = _shared(docs.sparkSession, path, pattern)
    docs = docs.drop(ids_col)
    names, raw = docs.columns, unused(docs.columns, "utf8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        for whole in batches:
            for batch in _pieces(whole, len(names)):
                packed = [encoder.encode((t or b"").decode(errors="replace")) for t in batch.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _packed_list(packed)], [*names, ids_col])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), f"`{ids_col}` array<int>"])
    return docs.withColumn(raw, F.col(text_col).cast("binary")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` with the bytes that the ids stand for; a null list has none. An unknown id is an error."""
    shared = _shared(encoded.sparkSession, path, pattern)
    encoded = encoded.drop(bytes_col)
    names, place = encoded.columns, encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        for batch in batches:
            out = [encoder.decode(ids or []) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*names, bytes_col])

    return encoded.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in encoded.dtypes), f"`{bytes_col}` binary"]))


def round_trip(docs: DataFrame, keys: list[str], text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(*keys, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded, in one pass; only digests leave the task."""
    shared = _shared(docs.sparkSession, path, pattern)
    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text_col).cast("binary").alias(unused(keys, "utf8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        for whole in batches:
            for batch in _pieces(whole, len(keys)):
                n, ids_sha, text_sha = [], [], []
                for text in batch.column(len(keys)).to_pylist():
                    packed = encoder.encode((text or b"").decode(errors="replace"))
                    ids = memoryview(packed).cast("I").tolist() if packed else []  # native order is little-endian on all supported machines
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(packed).hexdigest())
                    text_sha.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], [*keys, "n_tokens", "ids_sha256", "decoded_sha256"])

    types = dict(docs.dtypes)
    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n_tokens long, ids_sha256 string, decoded_sha256 string"]))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
