"""Token files: exact round trips, and ids as the library's."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dimweave.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return token_files.WordEncoder(PATH)


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 70_000])
@pytest.mark.parametrize("high", [1, 2, 300, 49_408, 2**32 - 1])
def test_blocks_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    blocks = token_files.pack_blocks(ids)
    back = np.concatenate([np.empty(0, np.uint32), *map(token_files.unpack_block, blocks)])
    assert (back[:n] == ids).all()


def test_rare_large_ids_are_exceptions():
    ids = np.full(1024, 100, np.uint32)
    ids[::100] = 4_000_000_000
    (block,) = token_files.pack_blocks(ids)
    assert len(block) == token_files.HEAD_SIZE + 11 * 6
    assert (token_files.unpack_block(block) == ids).all()


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=50), st.text(alphabet="aAéÉßsStT'vre dm12!-<|>÷ªÿŒ\ń \x1c", max_size=60)))
def test_ids_as_the_library(encoder, text):
    assert encoder.encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_special_tokens_as_the_library(encoder):
    for text in ("a<|endoftext|>b", "<|startoftext|> x", "<|ENDOFTEXT|>"):
        assert encoder.encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def expected(rows):
    start, want = 0, []
    for doc, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return want


def answered(spark, folder):
    rows = token_files.op5_token_files(spark, folder).collect()
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sorted(rows, key=lambda r: r.start)]


def test_documents_in_order(spark, documents, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 3000)  # several files in a task
    rows = [(None, "nobody's"), (-5, "first"), (0, None), (1, ""), (2, "Don't stop, 42 times!"), (3, "same"), (3, "same"), (9, "long words " * 30_000)]
    rows += [(10 + i, f"document number {i} " * (i % 40)) for i in range(300)]
    assert answered(spark, documents(rows[::-1])) == expected(rows)


def test_no_documents(spark, documents):
    assert answered(spark, documents([])) == []
