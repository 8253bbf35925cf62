"""The join's links and components against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from dimweave.llm import ngram_join
from dimweave.llm.common import WordHashes


def shingle_set(text):
    words = [w.decode("utf-8", "replace") for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(k)] = min(doc, ids.get(find(k), doc))
    return sorted(((doc, len(sets[k]), ids.get(find(k))) for k, (doc, _) in enumerate(rows)), key=str)


def answered(spark, folder):
    rows = ngram_join.op2_ngram_jaccard_join(spark, folder).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def near_copies(rng, groups, size, words, edits):
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(words)]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"e{rng.randint(0, 9)}"
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_groups_of_near_copies(spark, documents):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = near_copies(rng, 12, 14, 60, 4) + [(1000 + i, f"{passage} {t}") for i, t in near_copies(rng, 20, 2, 30, 2)]
    assert answered(spark, documents(rows)) == brute(rows)


@pytest.mark.parametrize("leaf, partners", [(512, 4 << 20), (4, 100)])
def test_one_large_group(spark, documents, monkeypatch, leaf, partners):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "PARTNERS", partners)
    rng = random.Random(6)
    rows = near_copies(rng, 1, 1, 80, 0)
    base = rows[0][1].split()
    for i in range(1, 300):
        own = list(base)
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(80)] = f"x{rng.randint(0, 400)}"
        rows.append((i, " ".join(own)))
    assert answered(spark, documents(rows)) == brute(rows)


def test_odd_documents(spark, documents):
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, "É a b c d e"),
        (8, "é a b c d e"), (9, long), (10, long + " more"), (11, "one two"), (11, "one two"), (None, "one two"),
        (None, "nobody else"), (12, "a b c d e"), (13, "a b c d e"), (12, "quite another text than that of its twin"),
    ]
    assert answered(spark, documents(rows)) == brute(rows)


def test_chains_link_through(spark, documents):
    words = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(30)]
    found = answered(spark, documents(rows))
    assert found == brute(rows)
    assert {c for _, _, c in found} == {0}


def test_no_documents(spark, documents):
    assert answered(spark, documents([])) == []


@pytest.mark.parametrize("seed", range(5))
def test_dual_traversal_misses_no_link(seed):
    rng, hashes = random.Random(seed), WordHashes()
    texts = [t for _, t in near_copies(rng, 8, 20, rng.choice([6, 30, 400]), 3)]
    sets = [s for s in {x.tobytes(): x for x in (ngram_join.shingles(t, hashes) for t in texts)}.values()]
    tree = ngram_join.SignatureTree(sets)
    met = {frozenset((tree.order[i], tree.order[j])) for i, j in tree.candidates(tree)}
    links = {frozenset((i, j)) for i in range(len(sets)) for j in range(i) if ngram_join.linked(sets[i], sets[j])}
    assert links <= met
    half = len(sets) // 2
    left, right = ngram_join.SignatureTree(sets[:half]), ngram_join.SignatureTree(sets[half:])
    pairs = ngram_join.links_between(left, list(range(half)), right, list(range(half, len(sets))))
    assert all(frozenset(p) in links for p in pairs)
    assert bool(pairs) == any(min(p) < half <= max(p) for p in links)


def test_shared_counts_are_exact_on_blobs():
    rng = np.random.default_rng(1)
    sets = {k: np.unique(rng.integers(0, 50, 30).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for k in range(6)}
    by_part = {}
    for some in (dict(list(sets.items())[:4]), dict(list(sets.items())[3:])):  # key 3 comes twice
        for part, blob in ngram_join._blobs(some, 7):
            by_part.setdefault(part, []).append(blob)
    total = {}
    for blobs in by_part.values():
        for key, n in zip(*ngram_join._shared(blobs)):
            total[int(key)] = total.get(int(key), 0) + int(n)
    want = {k: sum(any(x in t for j, t in sets.items() if j != k) for x in s) for k, s in sets.items()}
    assert total == want


def test_lists_do_not_grow_with_the_parts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, 60, np.uint64)) for _ in range(400)]
    total = sum(map(len, sets))
    for parts in (1, 20, 600):
        made = list(ngram_join._lists(sets, parts))
        assert sum(len(x) - 1 for _, x in made) <= 6 * total


@pytest.mark.parametrize("parts", [1, 7, 500])
def test_met_places_are_those_of_repeated_shingles(parts):
    rng = np.random.default_rng(parts)
    draw = lambda: np.unique(rng.integers(0, 400, 30).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    made = [[draw() for _ in range(n)] for n in (3, 1, 700)]
    by_part = {}
    for k, sets in enumerate(made):
        for part, packed in ngram_join._lists(sets, parts):
            by_part.setdefault(part, []).append((k, packed))
    got = [np.zeros(len(sets), int) for sets in made]
    for lists in by_part.values():
        for (k, _), places in zip(lists, ngram_join._met([x for _, x in lists])):
            np.add.at(got[k], places, 1)
    seen = Counter(int(x) for sets in made for s in sets for x in s)
    assert [g.tolist() for g in got] == [[sum(seen[int(x)] > 1 for x in s) for s in sets] for sets in made]


@pytest.mark.parametrize("rows", [1, 1_000_000])
def test_nodes_take_turns(spark, documents, monkeypatch, rows):
    monkeypatch.setattr(ngram_join, "LEAF", 4)
    monkeypatch.setattr(ngram_join, "AT_ONCE", 1)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", max(rows, 8))
    turns = []
    monkeypatch.setattr(ngram_join, "freed", turns.append)
    rng = random.Random(8)
    near = near_copies(rng, 6, 40, 50, 3)
    assert answered(spark, documents(near)) == brute(near)
    assert rows > 1 or len(turns) > 4  # two of the counts of shingles, the others of turns
