"""Repeated bytes against a dictionary of all strings of the length."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dimweave.llm import suffix_repeats


def brute(rows, length):
    """(key, n_bytes, spans, kept) per row."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = np.flatnonzero(np.diff(np.frombuffer(bytes(gone), np.uint8), prepend=0, append=0)).tolist()
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((k, len(t), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def found(df, key="doc_id"):
    rows = [(r[key], r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("period", suffix_repeats.COVERS)
def test_covers_have_every_distance(period):
    cover = suffix_repeats.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def passages(rng, n, length):
    """Texts that share passages of about the length, shifted, cut, overlapping and at ends."""
    alphabet = "abcdefgh äü"
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(length // 2, 4 * length))) for _ in range(8)]
    pool += ["ab" * length, "x" * (length + 3)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            own = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 2 * length)))
            shared = rng.choice(pool)
            cut = rng.randint(0, len(shared))
            parts += [own, rng.choice([shared, shared[cut:], shared[:cut]])]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize(("length", "slice_bytes", "bucket_bytes"), [(16, 4 << 20, 32 << 20), (31, 300, 500), (70, 2000, 1000)])
def test_shared_passages(spark, folder, monkeypatch, length, slice_bytes, bucket_bytes):
    monkeypatch.setattr("dimweave.llm.common.SLICE_BYTES", slice_bytes)
    rows = passages(random.Random(length), 60, length)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = suffix_repeats.without_repeats(docs, folder, length=length, bucket_bytes=bucket_bytes)
    want = brute(rows, length)
    assert found(out) == want
    assert any(spans for _, _, spans, _ in want) and any(kept for *_, kept in want)


def test_marks_too_large_to_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "BROADCAST_BYTES", 0)
    rows = passages(random.Random(5), 40, 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(suffix_repeats.without_repeats(docs, folder, length=20)) == brute(rows, 20)


def test_slices_are_never_shuffled(spark, folder, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "BROADCAST_BYTES", 0)
    monkeypatch.setattr("dimweave.llm.common.SLICE_BYTES", 500)
    rows = passages(random.Random(6), 50, 20)
    out = suffix_repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), folder, length=20)
    nodes = str(out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    dealt = [n for n in nodes.split("\n\n") if "Exchange" in n.split("\n")[0]]
    assert dealt and not any("data#" in n for n in dealt)
    assert "ShuffledHashJoin" in nodes and "SortMergeJoin" not in nodes
    assert found(out) == brute(rows, 20)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("dimweave_slices")]


@pytest.mark.parametrize("lanes", [1, 2])
def test_hashes_do_not_depend_on_what_is_hashed_beside(monkeypatch, lanes):
    rng = np.random.default_rng(3)
    text = rng.integers(0, 256, 5000).astype(np.uint8)
    at = np.flatnonzero(rng.random(5000 - 29) < 0.2)
    alone = np.concatenate([suffix_repeats.hashes(text[p : p + 29].copy(), np.array([0]), 29, lanes) for p in at], axis=1)
    assert (suffix_repeats.hashes(text, at, 29, lanes) == alone).all()
    monkeypatch.setattr(suffix_repeats, "APART", 40)
    assert (suffix_repeats.hashes(text, at, 29, lanes) == alone).all()
    assert suffix_repeats.hashes(text, at[:0], 29, lanes).shape == (lanes, 0)


def test_query_on_odd_documents(spark, documents):
    rng = random.Random(2)
    passage = "".join(rng.choice("pqrstuvw ") for _ in range(200))
    long = "".join(rng.choice("abcdef ") for _ in range(60_000))
    rows = [
        (1, None), (2, ""), (3, "short"), (4, passage), (5, passage[:199]), (6, "A" + passage + "B"),
        (7, long), (8, "z" + long[100:900] + "y"), (9, "same row " * 40), (9, "same row " * 40),
        (None, passage[:-1] + "!"), (10, "é" * 150), (11, "ü" + "é" * 100), (12, "x" * 201), (13, "y" * 200),
    ]
    got = {}
    for r in suffix_repeats.op13_suffix_array_dedup(spark, documents(rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    want = {}
    for key, n, spans, kept in brute(rows, 200):
        digest = hashlib.sha256(kept).hexdigest()
        want.setdefault(key, []).append((n, sum(b - a for a, b in spans), len(spans), digest))
    assert got == want
    assert want[4][0][1] == 200 and want[5][0][1] == 0 and want[12][0][1] == 201 and want[13][0][1] == 0


def test_no_documents_and_clashing_columns(spark, documents, folder):
    assert suffix_repeats.op13_suffix_array_dedup(spark, documents([])).collect() == []
    docs = spark.createDataFrame([("a b" * 9, 1, "k", "s")], "text string, n_bytes int, keys string, slice string")
    out = suffix_repeats.without_repeats(docs, folder, key="slice", length=16)
    assert out.columns == ["slice", "n_bytes", "spans", "kept"]
    assert found(out, "slice") == brute([("s", "a b" * 9)], 16)


def test_too_short_repeats(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(ValueError, match="at least"):
        suffix_repeats.without_repeats(docs, folder, length=15)


def test_sf_documents(spark):
    """The whole given table against plain Python sets of its strings."""
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_repeats.op13_suffix_array_dedup(spark, folder).collect()}
    want = {}
    for key, n, spans, kept in brute(rows, 200):
        want[key] = (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
    assert got == want
