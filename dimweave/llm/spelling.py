"""Spelling variants: words one letter apart, found in a trie of letter counts.

A word's vector counts its letters by group; the trie arranges words by these counts, one group a level.
Words one insertion, deletion or replacement apart have vectors with at most one letter too many and one too
few, so a depth-first search spends a budget of one surplus and one deficit and compares words at the leaves
it reaches. The trie is cut into subtrees of bounded size, which tasks search; a word visits the other subtrees
that its budget allows, each pair of subtrees once.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, table, trim, work_folder, written

#: Every so many of the runs' hashes is a misprint to make, as the query states it.
MISPRINT = 199

#: Letters of a group have the same code point modulo 16. Groups in order of levels: those of e, t, n, a, i, r first.
LEVELS = (5, 4, 14, 1, 9, 2, 15, 3, 8, 12, 13, 7, 6, 0, 11, 10)

#: Words of a subtree, unless they all have the same counts.
SUBTREE = 20_000

#: Distinct words a task counts before it hands them on.
COUNTED = 400_000

#: Search states, and word pairs, looked at together.
STATES, PAIRS = 200_000, 1_000_000

#: Leaves with more pairs than this compare only words that agree in one half.
LARGE = 1 << 14

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)
_LEVEL_OF = np.argsort(LEVELS)[np.arange(256) % 16]


# --- vocabulary -----------------------------------------------------------------------------------


def runs(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def misprinted(run: bytes, start: int) -> bytes:
    """The run without one letter, if its hash (crc32, continued from `start`) says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % MISPRINT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vectors(words: Sequence[bytes]) -> np.ndarray:
    """Counts of letters by level, up to 255 of each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    level = _LEVEL_OF[np.frombuffer(b"".join(words), np.uint8)]
    flat = np.bincount(np.repeat(np.arange(len(words)), sizes) * 16 + level, minlength=16 * len(words))
    return np.minimum(flat, 255).astype(np.uint8).reshape(-1, 16)


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, fewest: int = 5) -> DataFrame:
    """(word, n): words of at least `shortest` letters with `fewest` occurrences, after misprints."""

    def handed(total: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def count(batches):
        total = Counter()
        for batch in batches:
            for name, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(b":" if name is None else f"{name}:".encode())
                for run, n in Counter(runs(said or "")).items():
                    if len(run) >= shortest:
                        word = misprinted(run, start)
                        if len(word) >= shortest:
                            total[word] += n
                if len(total) >= COUNTED:
                    yield handed(total)
                    total.clear()
        yield handed(total)
        trim()

    found = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


# --- the trie -------------------------------------------------------------------------------------


class CountTrie:
    """A trie of letter counts; its leaves are the given prefixes of vectors, none of which begins another."""

    def __init__(self, prefixes: Sequence[bytes]):
        children: dict[tuple[int, int], int] = {}
        self.leaf = {}
        for at, prefix in enumerate(prefixes):
            node = 0
            for count in prefix:
                node = children.setdefault((node, count), len(children) + 1)
            self.leaf[node] = at
        self.end = np.full(len(children) + 1, -1, np.int64)
        self.end[list(self.leaf)] = list(self.leaf.values())
        keys = np.array([node * 256 + count for node, count in children], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(children.values()), np.int64)[order]

    def _step(self, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child of that count, and these children."""
        key = node * 256 + count
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = np.flatnonzero((self.keys[at] == key) & (count >= 0) & (count < 256))
        return found, self.child[at[found]]

    def near(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of `wanted`, leaf) wherever at most one letter is too many and one too few along the leaf's prefix.

        States wait on a stack in pieces of bounded size, so the search goes deep before it goes wide.
        """
        if not len(self.leaf):
            return
        n = len(wanted)
        stack = []
        for start in range(0, n, STATES):
            rows = np.arange(start, min(start + STATES, n))
            stack.append((0, rows, np.zeros(len(rows), np.int64), np.ones((2, len(rows)), bool)))
        while stack:
            level, row, node, spare = stack.pop()
            ended = self.end[node] >= 0
            if ended.any():
                yield row[ended], self.end[node[ended]]
                row, node, spare = row[~ended], node[~ended], spare[:, ~ended]
            if not len(row):
                continue
            count = wanted[row, level].astype(np.int64)
            parts = []
            for more, budget in ((0, None), (1, 0), (-1, 1)):
                may = np.arange(len(row)) if budget is None else np.flatnonzero(spare[budget])
                found, child = self._step(node[may], count[may] + more)
                left = spare[:, may[found]].copy()
                if budget is not None:
                    left[budget] = False
                parts.append((row[may[found]], child, left))
            row, node = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            spare = np.concatenate([p[2] for p in parts], axis=1)
            for start in range(0, len(row), STATES):
                piece = slice(start, start + STATES)
                stack.append((level + 1, row[piece], node[piece], spare[:, piece]))


# --- words at the leaves --------------------------------------------------------------------------


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether one letter inserted, deleted or replaced makes a of b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _first_eight(words: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(w[:8].ljust(8, b"\0") for w in words), "<u8")


def _differ(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the 8 bytes are not 0, and the place of the first (8: none)."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    marks = (((x & low) + low) | x) & ~low
    lowest = marks & (~marks + np.uint64(1))
    first = np.where(marks == 0, 8, np.bitwise_count(lowest - np.uint64(1)) >> 3)
    return np.bitwise_count(marks).astype(np.int64), first.astype(np.int64)


class Words:
    """Words with their first and last eight letters as numbers, to rule most pairs out at once."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.head, self.tail = _first_eight(words), _first_eight([w[::-1] for w in words])

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs (places of words) are one letter apart."""
        heads, first = _differ(self.head[a] ^ self.head[b])
        tails, last = _differ(self.tail[a] ^ self.tail[b])
        less, gap = np.minimum(self.size[a], self.size[b]), np.abs(self.size[a] - self.size[b])
        same = gap == 0
        # With one letter more, what agrees at the head and at the tail has to cover the shorter word.
        known = (first < 8) & (last < 8)
        possible = np.where(same, (heads <= 1) & (tails <= 1), ~known | (first + last >= less))
        found = np.flatnonzero(possible & (gap <= 1))
        # Within 16 letters the heads and tails are the whole words: one place, seen from both ends or from one.
        short = same[found] & (less[found] <= 16)
        h, t = heads[found], tails[found]
        one = (h + t == 1) | ((h + t == 2) & (first[found] + last[found] == less[found] - 1))
        sure = (short & one) | (~same[found] & known[found])
        check = np.flatnonzero(~short & ~sure)
        words = self.words
        pairs = zip(a[found[check]].tolist(), b[found[check]].tolist())
        sure[check] = [one_apart(words[i], words[j]) for i, j in pairs]
        return found[sure]

    def halves(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of two large leaves that agree in a half: the letter apart lies in the other one."""
        by, pairs = defaultdict(list), set()
        for j in right.tolist():
            word = self.words[j]
            for less in (len(word), len(word) - 1):
                by[less, word[: less // 2], 0].append(j)
                by[less, word[less // 2 - less :], 1].append(j)
        for i in left.tolist():
            word = self.words[i]
            for less in (len(word), len(word) - 1):
                pairs.update((i, j) for j in by.get((less, word[: less // 2], 0), ()))
                pairs.update((i, j) for j in by.get((less, word[less // 2 - less :], 1), ()))
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def near_pairs(words: Words, vecs: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (places) of words one letter apart, each once, of which one at least is the subtree's own.

    Own words come first in no particular order; a visitor meets own words only.
    """
    raw = np.ascontiguousarray(vecs).view("V16").ravel()
    leaves, of = np.unique(raw, return_inverse=True)
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(len(leaves) + 1))
    mine = np.zeros(len(leaves), bool)
    mine[of[own]] = True
    places = np.flatnonzero(mine)
    trie = CountTrie([leaves[i].tobytes() for i in places])
    matrix = np.frombuffer(leaves.tobytes(), np.uint8).reshape(-1, 16)
    sizes = np.diff(starts)
    for row, leaf in trie.near(matrix):
        leaf = places[leaf]
        once = ~mine[row] | (row <= leaf)
        row, leaf = row[once], leaf[once]
        product = sizes[row] * sizes[leaf]
        for i in np.flatnonzero(product > LARGE).tolist():
            a, b = words.halves(order[starts[row[i]] : starts[row[i] + 1]], order[starts[leaf[i]] : starts[leaf[i] + 1]])
            if row[i] == leaf[i]:
                a, b = a[a < b], b[a < b]
            for start in range(0, len(a), PAIRS):
                part = slice(start, start + PAIRS)
                hit = words.apart(a[part], b[part])
                yield a[part][hit], b[part][hit]
        rest = np.flatnonzero(product <= LARGE)
        row, leaf, product = row[rest], leaf[rest], product[rest]
        cuts = np.searchsorted(np.cumsum(product), np.arange(PAIRS, int(product.sum()) + PAIRS, PAIRS), "left") + 1
        for start, end in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            r, f, p = row[start:end], leaf[start:end], product[start:end]
            if not len(r):
                continue
            within = np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
            wide = np.repeat(sizes[f], p)
            a = order[np.repeat(starts[r], p) + within // wide]
            b = order[np.repeat(starts[f], p) + within % wide]
            other = (np.repeat(r, p) != np.repeat(f, p)) | (a < b)
            a, b = a[other], b[other]
            hit = words.apart(a, b)
            yield a[hit], b[hit]


# --- subtrees -------------------------------------------------------------------------------------


def cut_trie(words: DataFrame, most: int) -> list[bytes]:
    """Prefixes of vectors that part all words into subtrees of `most` words or one vector each.

    Level by level only subtrees over `most` are split, so the driver sees no more counts than these have children.
    """
    cut, heavy, level = [], [b""], 0
    while heavy:
        level += 1
        inside = words.where(F.substring("vec", 1, level - 1).isin(*map(bytearray, heavy))) if level > 1 else words
        counts = inside.groupBy(F.substring("vec", 1, level).alias("prefix")).count().collect()
        cut += [bytes(r["prefix"]) for r in counts if r["count"] <= most or level == 16]
        heavy = [bytes(r["prefix"]) for r in counts if r["count"] > most and level < 16]
    return sorted(cut)


def near_words(words: DataFrame, folder: str, subtree: int = SUBTREE) -> DataFrame:
    """(word, n_near, best_n, best): per word with near ones their number and the commonest, ties to the smaller.

    `words` is (word, n), each once, of letters up to U+00FF. A subtree's task gets its own words and those
    that visit it. Visits go from the lower to the higher subtree, so each pair of words meets once.
    """

    def measure(batches):
        for batch in batches:
            some = [w.encode("latin-1") for w in column_of(batch, "word").to_pylist()]
            vecs = pa.array([v.tobytes() for v in vectors(some)] if some else [], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, vecs], ["word", "n", "vec"])

    words = written(words.select("word", "n").mapInArrow(measure, "word string, n long, vec binary"), f"{folder}/vectors")
    prefixes = cut_trie(words, subtree)

    def route(batches):
        trie = CountTrie(prefixes)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.frombuffer(b"".join(column_of(batch, "vec").to_pylist()), "V16")
            kinds, of = np.unique(raw, return_inverse=True)
            matrix = np.frombuffer(kinds.tobytes(), np.uint8).reshape(-1, 16)
            home = np.array([bisect_right(prefixes, k.tobytes()) - 1 for k in kinds])  # none begins another
            found = list(trie.near(matrix))
            row = np.concatenate([r for r, _ in found])
            to = np.concatenate([t for _, t in found])
            keep = to >= home[row]
            row, to = row[keep], to[keep]
            order = np.argsort(row, kind="stable")
            row, to = row[order], to[order]
            first = np.searchsorted(row, np.arange(len(kinds) + 1))
            n = np.diff(first)[of]
            at = np.repeat(np.arange(len(of)), n)
            within = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            goal = to[first[of[at]] + within]
            sent = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(goal, pa.int64()), pa.array(goal == home[of[at]], pa.bool_()), *sent.columns],
                ["subtree", "own", "word", "n", "vec"],
            )

    def search(group: pa.Table) -> pa.Table:
        texts = group.column("word").to_pylist()
        n, own = group.column("n").to_numpy(), group.column("own").to_numpy(zero_copy_only=False)
        words = Words([w.encode("latin-1") for w in texts])
        vecs = np.frombuffer(b"".join(group.column("vec").to_pylist()), np.uint8).reshape(-1, 16)
        found = list(near_pairs(words, vecs, own))
        a = np.concatenate([x for x, _ in found] + [np.empty(0, np.int64)])
        b = np.concatenate([y for _, y in found] + [np.empty(0, np.int64)])
        word, other = np.concatenate([a, b]), np.concatenate([b, a])
        place = np.empty(len(texts), np.int64)
        place[sorted(range(len(texts)), key=words.words.__getitem__)] = np.arange(len(texts))
        order = np.lexsort((place[other], -n[other], word))
        word, other = word[order], other[order]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        best = other[first].tolist()
        return pa.table({
            "word": pa.array([texts[i] for i in word[first].tolist()], pa.string()),
            "n_near": pa.array(np.diff(first, append=len(word)), pa.int64()),
            "best_n": pa.array(n[best], pa.int64()),
            "best": pa.array([texts[i] for i in best], pa.string()),
        })

    dealt = words.mapInArrow(route, "subtree long, own boolean, word string, n long, vec binary")
    schema = "word string, n_near long, best_n long, best string"
    found = dealt.groupBy("subtree").applyInArrow(search, schema)
    top = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    met = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
    return met.select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def variants(words: DataFrame, folder: str, times: int = 5, subtree: int = SUBTREE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n): which word each is a variant of.

    The form is the commonest near word (ties: the smaller one) if it occurs `times` as often at least; the
    root is the last of the chain of forms, the word itself without one. Chains end, for counts grow along them;
    they are followed in steps that double. No words, no result.
    """
    words = written(words.select("word", "n"), f"{folder}/words")
    near = near_words(words, folder, subtree)
    taken = F.col("best_n") >= F.col("n") * times
    found = words.join(near, "word", "left").select(
        "word", F.when(taken, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, F.col("best_n")).alias("form_n"),
    )
    found = written(found, f"{folder}/found")
    roots, moved, step = found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 1, 0
    while moved:
        hop = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(
            roots.join(hop, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"),
            f"{folder}/roots{step}",
        )
        moved, roots, step = roots.where("next IS NOT NULL").count(), roots.drop("next"), step + 1
    columns = ["word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"]
    return found.join(roots, "word", "left").select(*columns)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, misprints put in, with the words they are variants of.

    Null texts have no words; in a hash a null doc_id is empty. Every row counts, repeated ones too.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(vocabulary(docs), work_folder(spark, "spelling"))
