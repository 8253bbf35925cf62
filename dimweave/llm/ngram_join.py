"""N-gram Jaccard join: documents whose shingle sets overlap enough, by signature trees, and their components."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import BROADCAST_ROWS, WordHashes, column_of, freed, mix, per_worker, slices, small, table, trim, windows, work_folder, written

#: Words in a shingle; two sets link when 100 * intersection >= SIMILARITY * union. The bounds below are for 75.
WIDTH, SIMILARITY = 5, 75

#: Bits of a set's signature, children of a tree's node, sets in a tree.
BITS, FANOUT, LEAF = 2048, 8, 512

#: Shingles of smaller nodes that come to one task.
PARTNERS = 1 << 20

#: Shingles of smaller nodes that are sent to their pairs at a time, if all nodes together do not have more.
AT_ONCE = 1 << 26

#: Sets that a blob's places of 16 bits tell apart.
PLACES = 1 << 16

#: Shingles that the order of prefixes puts last, the commonest; any number gives the same links.
COMMON = 65_536


# --- sets -----------------------------------------------------------------------------------------


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of the whole sequence if it is shorter than one.

    Words are runs without ASCII white space, A-Z lowered. No words, no shingles.
    """
    words = text.encode("utf-8", "replace").lower().split()
    return np.unique(windows(hashes.of(words), min(WIDTH, len(words)))) if words else np.empty(0, np.uint64)


def set_key(tokens: np.ndarray) -> int:
    """64 bits that stand for a set."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


class SignatureTree:
    """Sets in a tree whose nodes hold OR-combined bitmaps, size ranges and what their sets' bitmaps can spare.

    Sets of a and b shingles that link share at least 3 (a + b) / 7. What the first has beyond that may
    set bits of its own, no more than one each: 7 shared bits >= 7 bits - 4 a + 3 b. For two nodes no pair
    links if the bits that their bitmaps share are too few for the least demanding set of either and the
    smallest size in the other, or if no two sizes of their ranges are within the ratio 3 / 4.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:1].tolist()))
        self.sets = [sets[i] for i in self.order]
        bits = np.zeros((len(sets), BITS), bool)
        for row, s in zip(bits, self.sets):
            row[(s % np.uint64(BITS)).astype(np.int64)] = True
        size = np.array([len(s) for s in self.sets], np.int64)
        maps = np.packbits(bits, axis=1).view(np.uint64)
        need = 7 * bits.sum(axis=1) - 4 * size
        self.levels = [(maps, size, size, need)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, need = self.levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at),
                np.maximum.reduceat(high, at), np.minimum.reduceat(need, at),
            ))

    def top(self) -> int:
        return len(self.levels) - 1

    def possible(self, other: SignatureTree, level: int, other_level: int, mine: range, theirs: range) -> np.ndarray:
        """Which of these nodes may hold a pair that links."""
        maps, low, high, need = (x[mine.start : mine.stop] for x in self.levels[level])
        maps2, low2, high2, need2 = (x[theirs.start : theirs.stop] for x in other.levels[other_level])
        sizes = (4 * high[:, None] >= 3 * low2) & (4 * high2 >= 3 * low[:, None])
        shared = np.bitwise_count(maps[:, None, :] & maps2[None, :, :]).sum(axis=2, dtype=np.int64)
        return sizes & (7 * shared >= np.maximum(need[:, None] + 3 * low2, need2 + 3 * low[:, None]))

    def children(self, level: int, node: int) -> range:
        return range(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))

    def candidates(self, other: SignatureTree) -> Iterator[tuple[int, int]]:
        """Dual traversal: places of pairs that the bounds can't rule out (each once, if other is self)."""
        same = other is self
        if not self.sets or not other.sets:
            return
        roots = self.possible(other, self.top(), other.top(), range(1), range(1))
        stack = [(self.top(), 0, other.top(), 0)] if roots.all() else []
        while stack:
            level, node, other_level, other_node = stack.pop()
            if level == other_level == 0:
                if not same or node < other_node:
                    yield node, other_node
                continue
            mine, theirs = range(node, node + 1), range(other_node, other_node + 1)
            if level >= other_level:
                mine, level = self.children(level, node), level - 1
                if other_level > level:
                    theirs, other_level = other.children(other_level, other_node), other_level - 1
            else:
                theirs, other_level = other.children(other_level, other_node), other_level - 1
            found = np.argwhere(self.possible(other, level, other_level, mine, theirs))
            for i, j in found[::-1].tolist():
                if not same or level or other_level or mine[i] < theirs[j]:
                    if not same or mine[i] <= theirs[j]:
                        stack.append((level, mine[i], other_level, theirs[j]))


def link_all(sets: list[np.ndarray]) -> list[int]:
    """For each set the first place of its component; pairs already connected are not compared."""
    tree = SignatureTree(sets)
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in tree.candidates(tree):
        a, b = find(tree.order[i]), find(tree.order[j])
        if a != b and linked(tree.sets[i], tree.sets[j]):
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def links_between(
    left: SignatureTree, roots: list[int], right: SignatureTree, other_roots: list[int]
) -> list[tuple[int, int]]:
    """Pairs of roots that links between the sets of two trees connect; what is connected already is not compared."""
    found, joined = [], {}

    def find(x: int) -> int:
        while (up := joined.get(x, x)) != x:
            x = up
        return x

    for i, j in left.candidates(right):
        x, y = roots[left.order[i]], other_roots[right.order[j]]
        if find(x) != find(y) and linked(left.sets[i], right.sets[j]):
            joined[find(x)] = find(y)
            found.append((x, y))
    return found


# --- which sets can have a partner at all ---------------------------------------------------------


def _part_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    return (tokens % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)


def _lists(sets: list[np.ndarray], parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, packed shingles) of a slice's sets: the steps from one shingle's set to the next one's, in 8 or 16
    bits as the first byte says, and the shingles' upper 32 bits. Nothing in it grows with the number of parts."""
    tokens = np.concatenate(sets)
    place = np.repeat(np.arange(len(sets), dtype="<u2"), [len(s) for s in sets])
    part = _part_of(tokens, parts)
    order = np.argsort(part, kind="stable")
    high, place = (tokens[order] >> np.uint64(32)).astype("<u4"), place[order]
    ends = np.cumsum(np.bincount(part, minlength=parts))
    start = 0
    for p, end in enumerate(ends.tolist()):
        if end > start:
            steps = np.diff(place[start:end], prepend=np.uint16(0))
            width = 1 if steps.max() < 256 else 2
            yield p, bytes([width]) + steps.astype(f"<u{width}").tobytes() + high[start:end].tobytes()
            start = end


def _met(lists: list[bytes]) -> list[np.ndarray]:
    """For each of a part's lists the places of the shingles that come again in the part, one for each."""
    places, highs = [], []
    for packed in lists:
        width = packed[0]
        n = (len(packed) - 1) // (4 + width)
        places.append(np.cumsum(np.frombuffer(packed, f"<u{width}", n, 1), dtype=np.uint32).astype("<u2"))
        highs.append(np.frombuffer(packed, "<u4", n, 1 + n * width))
    both = np.concatenate(highs).astype(np.uint64)
    both <<= np.uint64(32)
    both |= np.arange(len(both), dtype=np.uint64)
    both.sort()
    same = both[1:] >> np.uint64(32) == both[:-1] >> np.uint64(32)
    again = np.zeros(len(both), bool)
    again[(both[1:][same] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    again[(both[:-1][same] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    cuts = np.cumsum([len(x) for x in places])[:-1]
    return [x[found] for x, found in zip(places, np.split(again, cuts))]


def _kind(docs: DataFrame) -> tuple[str, pa.DataType]:
    """The type of doc_id, for Spark and for Arrow."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return kind, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def sets_and_able(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n) of every document, and (key) of the sets of which three in four shingles are met again.

    Shingles are dealt by hash to as many parts as the session has shuffle partitions, in 5 or 6 bytes each
    however many parts there are. They carry the place of their set in a slice of text, not its key: a set that
    another slice has too is met there, so that all sets with copies are among the able.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind, arrow = _kind(docs)
    names = ["part", "doc_id", "key", "n", "slice", "packed"]

    def rows(part: list[int], slice_: int, packed: list[bytes], key: int | None) -> pa.RecordBatch:
        n = len(part)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.nulls(n, arrow), pa.array([key] * n, pa.int64()), pa.nulls(n, pa.int64()),
                pa.array([slice_] * n, pa.int64()), pa.array(packed, pa.binary()),
            ],
            names,
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("hashes", WordHashes)
        made = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text"):
            sets = [shingles(t or "", hashes) for t in column_of(batch, "text").to_pylist()]
            keys = [set_key(s) for s in sets]
            count = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(count) % parts, pa.int32()),  # they meet nothing there
                    column_of(batch, "doc_id"),
                    pa.array(keys, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(count, pa.int64()),
                    pa.nulls(count, pa.binary()),
                ],
                names,
            )
            full = list({k: s for k, s in zip(keys, sets) if len(s)}.items())
            for start in range(0, len(full), PLACES):
                some = full[start : start + PLACES]
                head = np.array([(k, len(s)) for k, s in some], np.int64).tobytes()
                yield rows([made % parts], made, [head], 0)
                part, packed = zip(*_lists([s for _, s in some], parts))
                for at in range(0, len(part), 1024):
                    yield rows(part[at : at + 1024], made, packed[at : at + 1024], None)
                made += 1
        trim()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            known = column_of(batch, "key").is_valid()
            others = batch.filter(known)
            if others.num_rows:
                yield others.select(names[1:])
            batch = batch.filter(pc.invert(known))
            packed = column_of(batch, "packed").to_pylist()
            for part, place, raw in zip(column_of(batch, "part").to_pylist(), column_of(batch, "slice").to_pylist(), packed):
                lists.setdefault(part, []).append((place, raw))
        for part in list(lists):
            place, raw = zip(*lists.pop(part))
            found = [(s, x.tobytes()) for s, x in zip(place, _met(raw)) if len(x)]
            if found:
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(n, arrow), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                        pa.array([s for s, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary()),
                    ],
                    names[1:],
                )
        trim()

    def able(group: pa.Table) -> pa.Table:
        heads = group["key"].is_valid().to_pylist()
        packed = group["packed"].to_pylist()
        keys, sizes = np.frombuffer(packed[heads.index(True)], np.int64).reshape(-1, 2).T
        met = np.zeros(len(keys), np.int64)
        for head, raw in zip(heads, packed):
            if not head:
                met += np.bincount(np.frombuffer(raw, "<u2"), minlength=len(keys))
        return pa.table({"key": pa.array(keys[4 * met >= 3 * sizes])})

    packed = docs.select("doc_id", "text").mapInArrow(
        pack, f"part int, doc_id {kind}, key long, n long, slice long, packed binary"
    )
    found = packed.repartition(parts, "part").mapInArrow(count, f"doc_id {kind}, key long, n long, slice long, packed binary")
    found = written(found, f"{folder}/counted", "zstd")
    freed(spark)
    of_slices = found.where("slice IS NOT NULL").select("slice", "key", "packed").groupBy("slice")
    keys = written(of_slices.applyInArrow(able, "key long").distinct(), f"{folder}/counted_keys")
    return found.where("n IS NOT NULL").select("doc_id", "key", "n"), keys


def _blobs(sets: dict[int, np.ndarray], parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, packed shingles) of some sets by key: a part has the keys present, then for each of its
    shingles the key's place (16 bits) and the shingle's upper 32 bits."""
    if not sets:
        return
    keys = np.array(list(sets), np.int64)
    tokens = np.concatenate(list(sets.values()))
    place = np.repeat(np.arange(len(keys)), [len(s) for s in sets.values()])
    part = _part_of(tokens, parts)
    order = np.argsort(part, kind="stable")
    high, place = (tokens[order] >> np.uint64(32)).astype("<u4"), place[order]
    ends = np.cumsum(np.bincount(part, minlength=parts))
    start = 0
    for p, end in enumerate(ends.tolist()):
        if end > start:
            own = place[start:end]
            present = np.flatnonzero(np.bincount(own, minlength=len(keys)))
            short = np.zeros(len(keys), "<u2")
            short[present] = np.arange(len(present))
            head = struct.pack("<I", len(present)) + keys[present].tobytes()
            yield p, head + short[own].tobytes() + high[start:end].tobytes()
            start = end


def _shared(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, how many of a key's shingles another key has too) of a part's blobs; keys without any are left out."""
    keys, places, highs, offset = [], [], [], 0
    for blob in blobs:
        (n,) = struct.unpack_from("<I", blob)
        rest = (len(blob) - 4 - 8 * n) // 6
        keys.append(np.frombuffer(blob, "<i8", n, 4))
        places.append(np.frombuffer(blob, "<u2", rest, 4 + 8 * n).astype(np.uint32) + np.uint32(offset))
        highs.append(np.frombuffer(blob, "<u4", rest, 4 + 8 * n + 2 * rest))
        offset += n
    own, number = np.unique(np.concatenate(keys), return_inverse=True)
    number = number.astype(np.uint32)
    both = np.concatenate(highs).astype(np.uint64)
    both <<= np.uint64(32)
    both |= number[np.concatenate(places)]
    both.sort()  # by shingle, then key
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    both = both[first]
    places = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    both >>= np.uint64(32)
    again = np.zeros(len(both), bool)
    again[1:] = both[1:] == both[:-1]
    again[:-1] |= again[1:]
    counts = np.bincount(places[again], minlength=len(own))
    some = np.flatnonzero(counts)
    return own[some], counts[some]


def docs_of(docs: DataFrame, able: DataFrame) -> DataFrame:
    """(doc_id, text) of documents with these ids (first)."""
    same = F.col("d.doc_id").eqNullSafe(F.col("a.first"))
    return docs.select("doc_id", "text").alias("d").join(small(able).alias("a"), same, "left_semi")


def sets_with_partners(docs: DataFrame, keys: DataFrame, met: DataFrame, folder: str) -> DataFrame:
    """(key, n, tokens) of the sets of which three in four shingles are found in another set.

    Others can't link: the intersection alone has to be that large, and so is the other set's. `met` are the keys
    that a count of all documents has left. One document stands for each and they are counted again without their
    copies; shingles are made anew from the texts.
    """
    firsts = written(keys.join(met, "key").select("first"), f"{folder}/firsts")
    some = written(docs_of(docs, firsts).distinct(), f"{folder}/texts", "zstd")  # ids may repeat, with their texts
    able = keys.join(sets_and_able(some, f"{folder}/again")[1], "key").select("first")
    texts = docs_of(some, written(able, f"{folder}/able"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("hashes", WordHashes)
        for batch in slices(batches, "text"):
            sets = [s for t in column_of(batch, "text").to_pylist() if len(s := shingles(t or "", hashes))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["key", "n", "tokens"],
            )

    return written(texts.mapInArrow(run, "key long, n long, tokens binary"), f"{folder}/sets")


# --- links ----------------------------------------------------------------------------------------


def unpack(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def common_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The COMMON shingles found most often twice in a slice of sets, ascending, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tokens"):
            together = np.concatenate([np.empty(0, np.uint64), *unpack(column_of(batch, "tokens"))])
            tokens, counts = np.unique(together, return_counts=True)
            often = counts > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often], pa.int64())], ["token", "n"]
            )

    counted = sets.select("tokens").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "token").limit(COMMON).collect()
    tokens = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array([r["n"] for r in rows], np.int64)[order]


def ranks(own: np.ndarray, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """How common shingles are; 0 for those not listed."""
    if not len(common):
        return np.zeros(len(own), np.int64)
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return np.where(common[at] == own, often[at], 0)


def leaves(sets: DataFrame, shared: Broadcast, folder: str) -> DataFrame:
    """(key, least, c, node): leaves of about LEAF sets for signature trees.

    `least` is a set's smallest shingle after mixing, of its common ones if it has any: near copies share
    those, whatever else was changed in them. `c` sets share it and are cut into nodes by hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = shared.value
        for batch in slices(batches, "tokens"):
            least = []
            for own in unpack(column_of(batch, "tokens")):
                listed = own[ranks(own, common, often) > 0]
                least.append(int(mix(listed if len(listed) else own).min().astype(np.int64)))
            yield pa.RecordBatch.from_arrays([column_of(batch, "key"), pa.array(least, pa.int64())], ["key", "least"])

    least = sets.select("key", "tokens").mapInArrow(run, "key long, least long").distinct()
    least = written(least, f"{folder}/least")
    sizes = written(least.groupBy("least").agg(F.count(F.lit(1)).alias("c")), f"{folder}/sizes")
    chunk = F.pmod(F.xxhash64("key"), F.ceil(F.col("c") / LEAF))
    node = F.xxhash64("least", chunk).alias("node")
    return written(least.join(small(sizes), "least").select("key", "least", "c", node), f"{folder}/leaves")


def trees(sets: DataFrame, nodes: DataFrame, folder: str) -> DataFrame:
    """(key, root): components within signature trees, built over each other.

    The sets of a node form a tree. Of each component in it one set goes on to the next round, in which
    those of one smallest shingle meet again, until a tree holds them all or rounds no longer help. All
    links are exact; links between trees are left to `between`.
    """
    items = sets.join(small(nodes.where("c > 1")), "key").select("key", "tokens", "least", "c", "node")
    labels, level, before = None, 0, items.count()
    while True:

        def run(group: pa.Table) -> pa.Table:
            keys, first = np.unique(group["key"].to_numpy(), return_index=True)
            group = group.take(first)
            sets = unpack(group["tokens"].combine_chunks())
            at = link_all(sets)
            more = len(keys) and group["c"][0].as_py() > LEAF
            going = [s.tobytes() if more and at[i] == i else None for i, s in enumerate(sets)]
            return pa.table({
                "key": keys,
                "root": keys[at] if len(keys) else keys,
                "tokens": pa.array(going, pa.binary()),
                "least": group["least"],
            })

        made = items.groupBy("node").applyInArrow(run, "key long, root long, tokens binary, least long")
        made = written(made, f"{folder}/level{level}")
        if labels is None:
            labels = made.select("key", "root")
        else:
            further = made.select(F.col("key").alias("root"), F.col("root").alias("next"))
            last = F.coalesce("next", "root").alias("root")
            labels = labels.join(small(further), "root", "left").select("key", last)
        labels = written(labels, f"{folder}/labels{level}")
        going = made.where("tokens IS NOT NULL").select("key", "tokens", "least")
        left = going.count()
        if not left or 2 * left > before:
            return labels
        level, before = level + 1, left
        sizes = written(going.groupBy("least").agg(F.count(F.lit(1)).alias("c")), f"{folder}/sizes{level}")
        chunk = F.pmod(F.xxhash64("key", F.lit(level)), F.ceil(F.col("c") / LEAF))
        node = F.xxhash64("least", chunk).alias("node")
        items = going.join(small(sizes), "least").select("key", "tokens", "least", "c", node)


def prefixes(sets: DataFrame, shared: Broadcast) -> DataFrame:
    """(token, key, n, rest): the shingles of each set of which two sets that link share at least one.

    In any fixed order of all shingles, sets that share three quarters of each share one among their
    first n - ceil(3 n / 4) + 1. The order puts common shingles last, so that a passage that very many
    documents quote is in a prefix only where a set has little else. `rest` is how many of the set's
    shingles come from there on: the first shingle two sets share leaves no more for their intersection.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = shared.value
        for batch in slices(batches, "tokens"):
            keys, tokens, sizes, rest = ([np.empty(0, np.int64)] for _ in range(4))
            for key, own in zip(column_of(batch, "key").to_pylist(), unpack(column_of(batch, "tokens"))):
                n = len(own)
                first = own[np.argsort(ranks(own, common, often), kind="stable")[: n + (-3 * n) // 4 + 1]]
                tokens.append(first.view(np.int64))
                keys.append(np.full(len(first), key, np.int64))
                sizes.append(np.full(len(first), n))
                rest.append(n - np.arange(len(first)))
            columns = [pa.array(np.concatenate(x)) for x in (tokens, keys, sizes, rest)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "key", "n", "rest"])

    return sets.select("key", "tokens").mapInArrow(run, "token long, key long, n long, rest long")


def between(sets: DataFrame, nodes: DataFrame, shared: Broadcast, folder: str) -> DataFrame:
    """(a, b): roots with a link between sets of different nodes; `nodes` is (key, root, node).

    Nodes whose sets share a shingle of their prefixes, unless all of them have one root, whose size
    ranges meet and of which enough is left from that shingle on, are compared as signature trees.
    Shingles all of whose sets have one root drop out before nodes are paired.
    """
    entries = prefixes(sets, shared).join(small(nodes), "key").groupBy("token", "node")
    entries = entries.agg(
        F.min("root").alias("x"), F.max("root").alias("y"),
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest"),
    )
    entries = written(entries, f"{folder}/entries")
    several = entries.groupBy("token").agg(F.min("x").alias("x"), F.max("y").alias("y"), F.count(F.lit(1)).alias("c"))
    several = written(several.where("x <> y AND c > 1").select("token"), f"{folder}/several")
    met = written(entries.join(small(several), "token", "left_semi"), f"{folder}/met")
    a, b = met.alias("a"), met.alias("b")
    apart = (F.least("a.x", "b.x") < F.greatest("a.y", "b.y")) & (F.col("a.node") < F.col("b.node"))
    sizes_meet = (4 * F.col("a.high") >= 3 * F.col("b.low")) & (4 * F.col("b.high") >= 3 * F.col("a.low"))
    enough = 7 * F.least("a.rest", "b.rest") >= 3 * (F.col("a.low") + F.col("b.low"))
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & apart & sizes_meet & enough)
    pairs = pairs.select(F.col("a.node").alias("left"), F.col("b.node").alias("right")).distinct()
    pairs = written(pairs, f"{folder}/pairs")
    quoting = prefixes(sets, shared).join(small(several), "token", "left_semi").select("key").distinct()
    wanted = pairs.select(F.col("left").alias("node")).union(pairs.select("right")).distinct()
    own = nodes.join(small(written(wanted, f"{folder}/wanted")), "node", "left_semi")
    own = written(own.join(small(written(quoting, f"{folder}/quoting")), "key", "left_semi"), f"{folder}/own")
    held = sets.select("key", "n", "tokens").join(small(own), "key").groupBy("node")
    held = held.agg(F.collect_list("root").alias("roots"), F.collect_list("tokens").alias("sets"), F.sum("n").alias("w"))
    return compare(pairs, written(held, f"{folder}/held"), folder)


def compare(pairs: DataFrame, held: DataFrame, folder: str) -> DataFrame:
    """(a, b): roots connected by links between the sets of paired nodes; held is (node, roots, sets, w).

    The larger node of each pair is sent once to a task, which all its smaller partners come to; where
    these are more than PARTNERS shingles, it is sent to several tasks that share them. A node with many
    partners is sent as many times: larger nodes take turns, so that no more is under way at a time than all
    nodes have, or AT_ONCE shingles.
    """
    weights = small(written(held.select("node", "w"), f"{folder}/weights"))
    sized = pairs.join(weights.select(F.col("node").alias("left"), F.col("w").alias("x")), "left")
    sized = sized.join(weights.select(F.col("node").alias("right"), F.col("w").alias("y")), "right")
    first = F.col("x") >= F.col("y")
    sized = sized.select(
        F.when(first, F.col("left")).otherwise(F.col("right")).alias("big"),
        F.when(first, F.col("right")).otherwise(F.col("left")).alias("node"),
        F.least("x", "y").alias("w"),
    )
    sized = written(sized, f"{folder}/sized")
    facts = sized.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).first()
    most = max(AT_ONCE, weights.agg(F.sum("w")).first()[0] or 0)
    turns = max(1, -(-(facts["w"] or 0) // most), -(-2 * facts["n"] // BROADCAST_ROWS))

    def run(big: pa.Table, others: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if big.num_rows:
            roots = big["own_roots"][0].as_py()
            sets = [np.frombuffer(s, np.uint64) for s in big["own"][0].as_py()]
            tree = SignatureTree(sets)
            for i in range(others.num_rows):
                partner = [np.frombuffer(s, np.uint64) for s in others["sets"][i].as_py()]
                found += links_between(tree, roots, SignatureTree(partner), others["roots"][i].as_py())
        return pa.table({name: pa.array([x[k] for x in found], pa.int64()) for k, name in enumerate("ab")})

    found = None
    for turn in range(turns):
        mine = sized.where(F.pmod(F.xxhash64("big", F.lit(turns)), F.lit(turns)) == turn)
        tasks = mine.groupBy("big").agg(F.ceil(F.sum("w") / PARTNERS).cast("int").alias("tasks"))
        tasks = small(written(tasks, f"{folder}/tasks{turn}"))
        part = F.pmod(F.xxhash64("node"), F.col("tasks")).cast("int").alias("part")
        partners = mine.select("big", "node").join(tasks, "big").select("big", "node", part)
        partners = small(written(partners, f"{folder}/partners{turn}"))
        partners = partners.join(held.select("node", "roots", "sets"), "node")
        every = F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("part")
        own = held.select(F.col("node").alias("big"), F.col("roots").alias("own_roots"), F.col("sets").alias("own"))
        bigs = tasks.select("big", every).join(own, "big")
        together = bigs.groupBy("big", "part").cogroup(partners.groupBy("big", "part"))
        links = written(together.applyInArrow(run, "a long, b long").distinct(), f"{folder}/links{turn}")
        found = links if found is None else found.union(links)
        freed(held.sparkSession)
    return found


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component): the smallest node that edges (a, b) reach, for every node of an edge.

    Alternates two steps until edges stay the same: each node's larger neighbours, then its smaller
    ones, are tied to the smallest of its neighbourhood. Minima are taken before they meet, neighbours
    are never listed, and each round is written.
    """
    state = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state = written(state, f"{folder}/edges0")
    mark, step = None, 0
    while True:
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        facts = state.agg(F.count(F.lit(1)).alias("n"), total).first()
        if mark == (facts["n"], facts["s"]) or not facts["n"]:
            return state.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        mark, step = (facts["n"], facts["s"]), step + 1
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), f"{folder}/large{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        little = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        state = written(little.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{folder}/edges{step}")


def near_duplicates(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of (doc_id, text): its component of linked documents.

    Rows with equal sets are one node throughout. A null text has no shingles and stands alone, as does
    any text without words; its component is its own doc_id. Rows without doc_id take part in links, and
    a component is named by the smallest doc_id it has, null if it has none. Hashes are 64 bits: two
    different sets or shingles count as one with a chance of 2 ** -64.
    """
    rows, met = sets_and_able(docs, folder)
    keys = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    keys = written(keys, f"{folder}/keys")
    sets = sets_with_partners(docs, keys, met, folder)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(sets))  # COMMON numbers at most
    nodes = leaves(sets, common, folder)
    rooted = nodes.join(small(trees(sets, nodes, folder)), "key", "left")
    labels = written(rooted.select("key", F.coalesce("root", "key").alias("root"), "node"), f"{folder}/labels")
    joined = components(between(sets, labels, common, folder), folder)
    joined = written(joined.withColumnRenamed("node", "root"), f"{folder}/joined")
    component = F.coalesce("component", "root").alias("component")
    whole = labels.join(small(joined), "root", "left").select("key", component)
    whole = whole.join(keys, "key")
    named = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    renamed = written(whole.join(named, "component").select("key", "component_id"), f"{folder}/renamed")
    named = F.coalesce("component_id", "first").alias("component_id")
    final = written(keys.join(small(renamed), "key", "left").select("key", named), f"{folder}/final")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(final, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and component."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), work_folder(spark, "ngram"))
