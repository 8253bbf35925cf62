"""Encoding against the public library, and round trips."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from dimweave.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENS = bpe.read_ranks(PATH)
PERFECT = bpe.PerfectHash.build(TOKENS)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={}
)


@pytest.fixture(scope="module")
def encoder():
    by_slot = np.empty(len(TOKENS), np.int64)
    by_slot[PERFECT.slots(TOKENS)] = np.arange(len(TOKENS))
    return bpe.Encoder(TOKENS, PERFECT, by_slot, public_tokenizers.PATTERN)


def test_hash_is_minimal_and_perfect():
    assert sorted(PERFECT.slots(TOKENS).tolist()) == list(range(len(TOKENS)))


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n\u0085 éß日😀12", max_size=80)))
def test_ids_as_the_library(encoder, text):
    assert np.frombuffer(encoder.encode(text), np.int32).tolist() == LIBRARY.encode_ordinary(text)


def test_a_long_word(encoder):
    word = "abcde" * 20_000
    ids = np.frombuffer(encoder.encode(word), np.int32)
    assert bpe.Arena(TOKENS).join(ids).decode() == word
    assert ids[:50].tolist() == LIBRARY.encode_ordinary("abcde" * 200)[:50]


def test_memo_may_overflow(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 4)
    text = "many different words in one text, far beyond the memo"
    assert np.frombuffer(encoder.encode(text), np.int32).tolist() == LIBRARY.encode_ordinary(text)


def test_a_worker_remembers_no_more_than_asked(encoder):
    short = bpe.Encoder(TOKENS, PERFECT, encoder.ids, public_tokenizers.PATTERN, limit=10)
    for k in range(30):
        text = f"word{k} other{k} more{k}"
        assert np.frombuffer(short.encode(text), np.int32).tolist() == LIBRARY.encode_ordinary(text)
        assert len(short.memo) <= 10


def test_every_document(spark, documents):
    rows = [(1, None), (2, ""), (3, "plain words"), (3, "plain words"), (None, "Überraschung 😀\n\n  end"), (4, "x " * 50_000), (5, "<|endoftext|>")]
    found = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op3_byte_level_bpe(spark, documents(rows)).collect()]
    want = []
    for doc, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert sorted(found, key=str) == sorted(want, key=str)


def test_no_documents(spark, documents):
    assert bpe.op3_byte_level_bpe(spark, documents([])).collect() == []


def test_a_column_of_the_results_name_is_replaced(spark):
    df = spark.createDataFrame([(7, "a b")], "ids long, text string")
    (row,) = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert list(row.ids) == LIBRARY.encode_ordinary("a b")
    assert bytes(row.bytes) == b"a b"
