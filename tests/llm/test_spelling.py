"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dimweave.llm import spelling


def words_of(rows):
    """The vocabulary by characters, with misprints."""
    total = Counter()
    for row in rows:
        name, text = row[0], row[1]
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def near_of(words):
    """Words one letter apart, by what is left without one letter."""
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def brute(words, times=5):
    near, form = near_of(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda u: (-words[u], u), default=None)
        if best is not None and words[best] >= times * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=lambda r: r[0])


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_one_apart():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))
        want = b in near_of({a, b})[a]
        assert spelling.one_apart(a.encode(), b.encode()) == want


@pytest.mark.parametrize("longest", [9, 20, 40])
def test_quick_comparison(longest):
    rng = random.Random(longest)
    made = []
    for _ in range(400):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, longest)))
        at = rng.randrange(len(w))
        made += [w, w[:at] + w[at + 1 :], w[:at] + "c" + w[at + 1 :], w[::-1]]
    words = spelling.Words([w.encode("latin-1") for w in made])
    a, b = np.meshgrid(np.arange(300), np.arange(len(made)))
    a, b = a.ravel(), b.ravel()
    got = set(words.apart(a, b).tolist())
    want = {i for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())) if spelling.one_apart(words.words[x], words.words[y])}
    assert got == want


def vocabulary(rng, n, letters, lengths=(6, 12)):
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*lengths)))
        words[w] = rng.randint(5, 2000)
        for _ in range(rng.randint(0, 3)):
            at, x = rng.randrange(len(w)), rng.choice(letters)
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + x + w[at:], w[:at] + x + w[at + 1 :]])
            words[w] = rng.choice([5, 9, 40, 300, 2000, 60_000])
    return {w: n for w, n in words.items() if len(w) >= 6}


@pytest.mark.parametrize(("letters", "subtree", "large"), [("abcdeé", 20_000, 1 << 14), ("abÿÀq", 50, 1 << 14), ("ab", 30, 4), ("aeiost", 7, 1)])
def test_variants(spark, folder, monkeypatch, letters, subtree, large):
    monkeypatch.setattr(spelling, "LARGE", large)
    monkeypatch.setattr(spelling, "PAIRS", 1000)
    monkeypatch.setattr(spelling, "STATES", 64)
    words = vocabulary(random.Random(subtree), 600, letters)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = found(spelling.variants(df, folder, subtree=subtree))
    assert got == brute(words)
    assert any(r[1] for r in got) and any(r[2] != r[1] and r[1] for r in got)


def test_very_long_words(spark, folder):
    long = "ab" * 700
    words = {long: 100, long + "b": 6, "b" + long: 600, long[:-1]: 5, long[:600] + "c" + long[601:]: 7, "a" * 300: 5, "a" * 301: 50}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.variants(df, folder)) == brute(words)


def test_query(spark, documents):
    rng = random.Random(4)
    pool = [w for w in vocabulary(rng, 120, "aehlorstÉ")]
    rows = [(i, " ".join(rng.choice(pool[: rng.choice([4, 40, 200])]) for _ in range(200))) for i in range(60)]
    rows += [(900, None), (901, ""), (902, "Straße straße STRASSE naïve-naïve xāy 日本 ǆabcdef"), (None, "Wonderful " * 30)]
    rows += [(903, "wonderfull " * 5 + "x" * 50_000)] + [(904, "repeated repeated")] * 4 + [(905, "×÷abcdefÀ " * 6)]
    got = found(spelling.op11_spelling_variants(spark, documents(rows)))
    assert got == brute(words_of(rows))


def test_no_words_and_clashing_columns(spark, documents, folder):
    assert spelling.op11_spelling_variants(spark, documents([])).collect() == []
    assert spelling.op11_spelling_variants(spark, documents([(1, None), (2, "a b c")])).collect() == []
    df = spark.createDataFrame([("abcdef", 50, "x", "y"), ("abcdeg", 5, "x", "y")], "word string, n long, form string, vec string")
    assert found(spelling.variants(df, folder)) == brute({"abcdef": 50, "abcdeg": 5})


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_documents(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = found(spelling.op11_spelling_variants(spark, folder))
    assert got == brute(words_of(rows))
    assert any(r[1] for r in got)
