"""Byte-level BPE against the tiktoken library and exact round trips."""

import hashlib
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reachmap.llm import bpe

RANKS = bpe.load_ranks(bpe.default_path())


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=RANKS, special_tokens={})


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def plain_merge(piece):
    if piece in RANKS:
        return [RANKS[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = min(((RANKS[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in RANKS), default=None)
        if found is None:
            return [RANKS[p] for p in parts]
        k = found[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text("ab ", max_size=60).map(str.encode), st.text(max_size=30).map(str.encode)))
def test_merge_is_the_plain_one(piece):
    if piece:
        assert bpe.merge(piece, RANKS) == plain_merge(piece)


def test_long_matches_use_packed_trees(library):
    rng = random.Random(3)
    for text in ("x" * 20_001, "ab" * 9000, "".join(rng.choice("aeiou") for _ in range(15_000)), " " * 9000, "漢字" * 3000):
        encoder = bpe.Encoder(RANKS, bpe.default_pattern())
        assert ids_of(encoder.encode(text)) == library.encode_ordinary(text)


def test_point_updates():
    rng = random.Random(1)
    for n in (1, 2, 3, 17, 5000):
        leaves = [rng.randrange(1 << 20) << bpe.PLACE_BITS | i for i in range(n)]
        tree = bpe.PairTree(leaves)
        for _ in range(50):
            i = rng.randrange(n)
            leaves[i] = bpe.NONE if rng.random() < 0.3 else rng.randrange(100) << bpe.PLACE_BITS | i
            tree.put(i, leaves[i])
            assert tree.tree[1] == min(leaves)


ODD = [None, "", " ", "one", "It's  a 12345 test's\n\n end ", "Äpfel ▁ 漢字 \U0001f600 é", "<|endoftext|> stays text", "\x00\x01\t", "a" * 5000, "w " * 20_000, "one", "one"]


def test_columns_rows_and_round_trip(spark, library):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").withColumns({n: F.lit(f"clash {n}") for n in ("ids", "utf8", "decoded", "n_tokens")})
    encoded = bpe.encode(df)
    assert encoded.columns == ["doc_id", "text", "utf8", "decoded", "n_tokens", "ids"]
    got = {r.doc_id: r for r in bpe.decode(encoded).collect()}
    for i, text in enumerate(ODD):
        assert got[i].ids == library.encode_ordinary(text or "") and got[i].decoded == (text or "").encode() and got[i].utf8 == "clash utf8" and got[i].text == text
    digests = {r.doc_id: r for r in bpe.round_trip(df, ["doc_id"]).collect()}
    for i, text in enumerate(ODD):
        ids = library.encode_ordinary(text or "")
        assert tuple(digests[i]) == (i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert bpe.encode(df.limit(0)).count() == 0 and bpe.round_trip(df.limit(0), ["doc_id"]).count() == 0


def test_invalid_bytes_are_replaced(spark, library):
    df = spark.sql("select 1L as doc_id, cast(unhex('61FF62') as string) as text")
    assert bpe.encode(df).first().ids == library.encode_ordinary("a�b")


def test_another_pattern_and_file(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    df = spark.createDataFrame([(1, "Hello, world 42")], "doc_id long, text string")
    encoded = bpe.encode(df, path=path, pattern=r"\w+|\W+")
    assert bytes(bpe.decode(encoded, path=path).first().decoded) == b"Hello, world 42"
    assert bytes(bpe.decode(bpe.encode(df, pattern=r"\p{L}+")).first().decoded) == b"Helloworld"


def test_query_on_the_table(spark, library):
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = bpe.op12_byte_bpe(spark, path).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
