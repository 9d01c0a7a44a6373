"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.llm import bpe

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = bpe.Coder(RANKS, P.PATTERN)


def encode(text):
    return next(CODER.encode([text]))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    ids = encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


@pytest.mark.parametrize("letters", ["a", "ab", "aab ", "the and ", "éèà", "日本語", "\U0001f600\u200d", "0123456789", "\t\n \u00a0"])
def test_long_pieces(letters):
    random.seed(len(letters))
    for size in (1, 2, 3, 17, 400, 20_000):
        text = "".join(random.choice(letters) for _ in range(size))
        assert encode(text) == REFERENCE.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab th\u00e9\n", max_size=80), max_size=20))
def test_texts_together(texts):
    assert list(bpe.Coder.encode(CODER, texts)) == [REFERENCE.encode_ordinary(text) for text in texts]


def test_one_very_long_pre_token():
    random.seed(1)
    text = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    ids = encode(text)
    assert CODER.decode(ids) == text.encode()
    assert ids[:20_000] == REFERENCE.encode_ordinary(text[:100_000])[:20_000]


@pytest.mark.parametrize("special", ["<|endoftext|>", "'s 'T don't", "", "\x1c\x85\u180e", "a  b   \n\n c "])
def test_special_strings_are_text(special):
    assert encode(special) == REFERENCE.encode_ordinary(special)


def test_frames(spark):
    rows = [(1, "Hello wörld", "x"), (1, "Hello wörld", "x"), (None, None, None), (3, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    vocabulary = bpe.Vocabulary(spark, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    coded = bpe.encode(df, vocabulary)
    assert coded.columns == ["doc_id", "text", "ids"]
    want = REFERENCE.encode_ordinary("Hello wörld")
    assert sorted((row.doc_id or 0, row.ids) for row in coded.collect()) == [(0, []), (1, want), (1, want), (3, [])]
    assert all(bytes(row.decoded) == (row.text or "").encode() for row in bpe.decode(coded, vocabulary).collect())
    digests = bpe.round_trip(df, vocabulary, keep=["doc_id"])
    assert all(row.round_trip_ok for row in digests.collect())
    assert bpe.round_trip(df.limit(0), vocabulary).count() == 0
    assert bpe.token_counts(digests, ["doc_id"]).count() == 3


def test_too_large_a_vocabulary(spark):
    with pytest.raises(ValueError):
        bpe.Vocabulary(spark, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, limit=1000)
