"""Chat formatting against plain loops."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from dimweave.llm import chat
from pyspark.sql import functions as F

ROWS = "conv_id long, turn long, role string, text string"
BITS = [*chat.CONTROL, "\\", "<", "[", "|", "/", "a", "\n", ">", " "]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@given(st.lists(st.sampled_from(BITS), max_size=12).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|im_sep|>"]), st.lists(st.sampled_from(BITS), max_size=6).map("".join))))
def test_render_then_parse(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert "".join(chat.unescape(formatted[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def expected(rows):
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        talks.setdefault(conv, []).append((role or "", text or ""))
    said = "</s>[INST] ok [/INST]"
    talks[-1] = [("user", said), ("assistant", said)]
    found = {}
    for conv, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        found[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return found


def answered(spark, folder):
    rows = chat.op1_chat_formatting(spark, folder).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_odd_conversations(spark, tables):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "user", ""), (1, 3, "assistant", "é😀\\n<s>"),
        (2, 0, None, "no role"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (2, None, "user", "no turn"),
        (None, 0, "user", "no conversation"), (None, 1, "assistant", "yes"), (3, 5, "assistant", "x" * 200_000),
    ]
    rows += [(4, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(150)]
    folder = tables(conversations=([(*r, "extra") for r in rows], f"{ROWS}, formatted string"))
    assert answered(spark, folder) == expected(rows)


def test_no_conversations(spark, tables):
    assert set(answered(spark, tables(conversations=([], ROWS)))) == {-1}


@pytest.mark.parametrize("branches", [None, 1, 2])
def test_best_branches_of_reply_trees(spark, folder, branches):
    rng = random.Random(3)
    parent, score, tree = {}, {}, {}
    for t in range(8):
        own = []
        for k in range(rng.randint(1, 40)):
            i = len(parent)
            parent[i] = rng.choice(own[-4:]) if own and rng.random() < 0.95 else None
            if (t, k) == (3, 5):
                parent[i] = 999_999  # a parent that is missing
            score[i], tree[i] = rng.randint(0, 5), t
            own.append(i)
    rows = [(tree[i], i, parent[i], float(score[i])) for i in parent]
    rows += [(50, 900, 901, 1.0), (50, 901, 900, 1.0), (50, 902, 901, 1.0)]  # a cycle
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    paths = {}
    for r in chat.best_paths(messages, folder, F.col("score"), branches).collect():
        paths.setdefault(r.leaf, []).append((r.place, r.node))

    def path(i):
        up = []
        while i in parent:
            up.append(i)
            i = parent[i]
        return up[::-1]

    want = {i: path(i) for i in parent if i not in parent.values()}
    if branches:
        by_tree = {}
        for i in want:
            by_tree.setdefault(tree[i], []).append(i)
        best = lambda i: (-sum(score[n] for n in want[i]) / len(want[i]), -len(want[i]), i)
        want = {i: want[i] for own in by_tree.values() for i in sorted(own, key=best)[:branches]}
    assert {i: [n for _, n in sorted(p)] for i, p in paths.items()} == want
