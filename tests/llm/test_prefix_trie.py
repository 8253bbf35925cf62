"""The prefix trie against a trie of plain lists, and its SQL."""

import hashlib
import random
import zlib

import pytest
from compare import connect, duck_side, spark_side

from dimweave.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    own = {}
    for row in rows:
        conv, turn, role, text = row[:4]
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(t)] for c, t in own.items()}
    paths = {}
    for c in turns:
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == node)
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), up, len(convs), len(children), len(leaves), saved, digest))
    return sorted(out)


def found(spark, tables, rows, schema=SCHEMA):
    folder = tables(conversations=(rows, schema))
    out = prefix_trie.op12_conversation_prefix_trie(spark, folder)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def conversations(rng, n, longest, texts):
    rows = []
    for c in range(n):
        copy = rng.random() < 0.3
        own = random.Random(7 if copy else c)
        length = own.randint(1, longest)
        for t in range(length):
            rows.append((c, t, ["user", "assistant"][t % 2], f"text {own.randrange(texts)} é"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("block", "run", "piece"), [(4, 1024, 50_000), (2, 2, 1), (3, 1, 4), (1, 3, 2)])
def test_shared_beginnings(spark, tables, monkeypatch, block, run, piece):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "RUN", run)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows = conversations(random.Random(block), 60, 14, 2)
    assert found(spark, tables, rows) == brute(rows)


def test_odd_conversations(spark, tables):
    long = "very long " * 20_000
    rows = [
        (0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, None, None, None), (1, None, "user", "z"), (1, 0, "user", ""),
        (2, 5, "user", long), (2, 5, "user", long), (2, 5, "assistant", "tie"), (3, 0, None, "a"), (4, 0, "user", None),
        (-7, 0, "user", "a"), (-5, 0, "user", "a"), (-5, 1, "x", "y"), (None, 0, "user", "a"), (12, 3, "user", "no base"),
        (13, 1, "user", "a"), (14, 1, "user", "a"), (14, 2, "user", "a"),
    ]
    rows += [(15, t, "user", f"{t}") for t in range(40)] + [(c, t, "user", f"{t}") for c in (16, 17) for t in range(3)]
    assert found(spark, tables, rows) == brute(rows)


def test_turnless_and_clashing_columns(spark, tables):
    # A conversation of few turns loses them all where its group's first one is absent.
    lost = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lost, 0, "user", "gone", 1, 2, "x"), (1000, 0, "user", "kept", 1, 2, "x")]
    schema = SCHEMA + ", depth int, pa int, ends_sha256 string"
    got = found(spark, tables, rows, schema)
    assert got == brute(rows)
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in got)


def test_no_conversations(spark, tables):
    assert found(spark, tables, []) == []
    assert found(spark, tables, [(None, 0, "user", "a")]) == []


def test_one_long_conversation_with_most_rows(spark, tables):
    rows = [(5, t, "user", "same") for t in range(3000)] + [(6, t, "user", "same") for t in range(50)]
    rows += [(20 + c, 0, "user", "same") for c in range(40)]
    got = found(spark, tables, rows)
    assert len(got) == 3001
    assert max(n[1] for n in got) == 3000
    by_depth = {n[1]: n for n in got}
    assert by_depth[3000][4:6] == (0, 1) and all(n[5] == 1 for n in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    left = spark_side(prefix_trie.op12_conversation_prefix_trie(spark, folder))
    assert left == duck_side(connect(folder), prefix_trie.ORACLE_SQL)
