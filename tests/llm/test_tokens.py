"""Byte-level BPE and token counts against the public libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import bpe, pretokens, queries, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", "'s", "'", "'re", "'l", " ", "  ", "\n", "\t", "1", "٣", "é", "!", " ", "漢", "🙂", "'ll", "xyz", "\x00", "́",
          "\r\n", "²", "​", "\x85", "\x1c", "<|endoftext|>", "<|endof"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges.from_ranks(RANKS)


def mixed_texts(n):
    pick = random.Random(5)
    return ["".join(pick.choice(PIECES) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def test_encoder_equals_library(library, merges):
    texts = ["", "a" * 300, " " * 90, "x" + " " * 50 + "y", "'" * 30, "ab" * 700, *mixed_texts(600)]
    for text, (ids, offsets) in zip(texts, bpe.Encoder(merges, 50).texts(texts)):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        ends = np.cumsum([0, *(len(merges.pieces[i]) for i in ids)])
        assert np.frombuffer(offsets, "<u4").tolist() == ends[:-1].tolist()
        assert b"".join(merges.pieces[i] for i in ids) == text.encode()


def test_every_code_point_is_classed_as_in_the_pattern(library, merges):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1" for c in points[i:i + 2000]) for i in range(0, len(points), 8000)]
    for text, (ids, _) in zip(texts, bpe.Encoder(merges, 10_000).texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_pretokens_cover_each_text(texts):
    data, offsets, firsts = pretokens.split(texts)
    assert data == "".join(texts).encode() and offsets[-1] == len(data)
    for text, a, b in zip(texts, firsts, firsts[1:]):
        assert data[offsets[a]:offsets[b]] == text.encode()


def test_long_words_merge_like_short_ones(merges):
    word = b"abcabcaabbcc" * 5
    assert merges.encode_long(word) == merges.encode([word[:60]])[0].tolist()


def test_query_round_trip(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 9), (None, "", 9), (3, "Same row", 9), (3, "Same row", 9), (4, "y" * 200_000, 9)], "doc_id long, text string, n_tokens int")
    encoded = bpe.encode_documents(df, RANKS)
    assert encoded.columns == ["doc_id", "n_tokens", "token_ids", "token_offsets"]
    rows = bpe.decode_documents(encoded, RANKS).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in rows) == [(0, b""), (1, b""), (3, b"Same row"), (3, b"Same row"), (4, b"y" * 200_000)]
    assert bpe.encode_documents(df.limit(0), RANKS).count() == 0
    counted = {r.doc_id: r for r in token_counts.count_tokens(df, JSON).collect()}
    assert counted[1].n_tokens == 0 and counted[None].n_bytes == 0 and counted[4].over_limit
    assert token_counts.count_tokens(df.limit(0), JSON).count() == 0


def test_token_counts_equal_library(spark):
    texts = [*mixed_texts(500), "it's <|endoftext|> here", "plain words again and again " * 50]
    library = Tokenizer.from_file(JSON)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in token_counts.count_tokens(df, JSON, limit=50, table_entries=64, cache_entries=20).collect()}
    assert [rows[i].n_tokens for i in range(len(texts))] == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in rows.values())
    assert [rows[i].n_bytes for i in range(len(texts))] == [len(t.encode()) for t in texts]
    assert sum(r.n_frequent for r in rows.values()) > 500


def test_frequent_table_is_exact():
    data, offsets, _ = pretokens.split(["the cat and the dog sat; antidisestablishmentarianism"])
    low, high, fits = token_counts.keys_of(data, offsets)
    assert (~fits).sum() == 1
    table = token_counts.FrequentTable.of(low[fits], high[fits], np.arange(1, fits.sum() + 1).astype(np.uint8))
    found = table.look_up(low, high)
    assert all(found[fits] > 0)
    assert table.look_up(low[:1] + np.uint64(1), high[:1])[0] == 0
