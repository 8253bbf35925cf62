"""Mixing against targets by iteration, and what a mix may take."""

import random

import pytest
from pyspark.sql import functions as F

from dimweave.llm import mixing

WORDS = [(i, " ".join("w" for _ in range(n))) for i, n in enumerate([0, 1, 5, 30])]


def plan(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    """Sizes and targets by sharing out what is over, again and again."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full, left = dict.fromkeys(order, 0.0), set(), share * sum(sizes.values())
    while left > 1e-9 and len(full) < len(order):
        open_ = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in open_:
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                full.add(s)
    return sizes, target


def check(spark, folder, rows):
    found = mixing.op10_mixing_to_weights(spark, folder).collect()
    assert len(found) == len(rows)
    sizes, target = plan(rows)
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in found:
        own = source[r.doc_id]
        assert r.size == len(dict((i, t) for i, t, _ in rows)[r.doc_id].split() if dict((i, t) for i, t, _ in rows)[r.doc_id] else [])
        assert r.source_size == sizes[own]
        assert r.target == pytest.approx(target[own])
        assert r.taken % max(1, r.size) == 0 and r.taken <= 2 * r.size
        taken[own] = taken.get(own, 0) + r.taken
    largest = {}
    for r in found:
        largest[source[r.doc_id]] = max(r.size, largest.get(source[r.doc_id], 0))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]
    return found


def test_targets_and_taken(spark, documents):
    rng = random.Random(3)
    rows = []
    for s, n in [("a", 400), ("b", 60), ("c", 50), (None, 30), ("", 20), ("B", 300)]:
        rows += [(len(rows) + k, "w " * rng.randint(0, 40), s) for k in range(n)]
    folder = documents(rows)
    first = check(spark, folder, rows)
    again = mixing.op10_mixing_to_weights(spark, folder).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_odd_documents(spark, documents):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one", "b"), (4, "x " * 50_000, None), (5, "one two", "a"), (6, "y", None)]
    check(spark, documents(rows), rows)


def test_repeated_rows_are_taken_alike(spark, documents):
    rows = [(7, "same text", "a")] * 50 + [(i, "another text of some words", "b") for i in range(50, 90)]
    found = mixing.op10_mixing_to_weights(spark, documents(rows)).collect()
    assert len({r.taken for r in found if r.doc_id == 7}) == 1


def test_no_documents_and_no_words(spark, documents):
    assert mixing.op10_mixing_to_weights(spark, documents([])).collect() == []
    rows = mixing.op10_mixing_to_weights(spark, documents([(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.taken, r.target) for r in rows] == [(0, 0, 0.0)] * 2


def test_repeat_returns_whole_rows(spark, folder):
    rows = [(i, "w " * (i % 30), f"s{i % 3}", "mine", 1.5) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, taken double")
    out = mixing.repeat(docs, folder)
    assert out.dtypes == docs.dtypes
    sized = docs.select("doc_id", "text", "source")
    taken = mixing.mix(sized, mixing.word_count(F.col("text")), f"{folder}2").collect()
    want = {r.doc_id: r.taken // r.size for r in taken if r.taken}
    got = {}
    for r in out.collect():
        assert tuple(r) == rows[r.doc_id]
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want
