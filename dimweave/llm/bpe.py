"""Byte-level BPE: pre-tokens of the vocabulary by a minimal perfect hash, others by a heap of merges."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from dimweave.llm.common import column_of, hide, mix, per_worker, slices, table, trim, written

#: Pre-tokens a worker keeps ids of, tier above both others; emptied when full.
MEMO = 500_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank from a file of base64 token and rank per line; ranks must be 0, 1, 2, ..."""
    ranks = {}
    with open(path, "rb") as lines:
        for token, rank in map(bytes.split, lines):
            ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be consecutive from 0")
    return [ranks[i] for i in range(len(ranks))]


def _base_hash(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


@dataclass
class PerfectHash:
    """Minimal perfect hash by displacement: `n` keys, `n` slots.

    A key's bucket names a seed that sends each key of the bucket to a slot of its own. Buckets of one
    key name their slot directly, as -1 - slot. A word outside the keys lands on some slot as well, so
    a caller compares the key kept there.
    """

    n: int
    seeds: np.ndarray

    @classmethod
    def build(cls, keys: list[bytes], per_bucket: int = 4) -> PerfectHash:
        n, hashes = len(keys), _base_hash(keys)
        if len(np.unique(hashes)) != n:
            raise ValueError("keys must differ")
        buckets = max(1, n // per_bucket)
        seeds = np.zeros(buckets, np.int64)
        home = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if n else []
        taken = np.zeros(n, bool)
        singles = []
        for group in sorted(groups, key=len, reverse=True):
            if len(group) == 1:
                singles.append(group[0])
                continue
            own, first, fits = hashes[group], 1, np.empty(0, np.int64)
            while not len(fits):  # 32 seeds at a time
                tried = np.arange(first, first + 32)
                slots = np.sort(cls._slots(own[None, :], tried[:, None], n), axis=1)
                apart = (np.diff(slots, axis=1) > 0).all(axis=1)
                fits = np.flatnonzero(apart & ~taken[slots].any(axis=1))
                first += 32
            taken[slots[fits[0]]] = True
            seeds[home[group[0]]] = tried[fits[0]]
        free = np.flatnonzero(~taken)
        for key, slot in zip(singles, free):
            seeds[home[key]] = -1 - slot
        return cls(n, seeds)

    @staticmethod
    def _slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
        spread = mix(hashes ^ (seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return (spread % np.uint64(n)).astype(np.int64)

    def slots(self, words: list[bytes]) -> np.ndarray:
        hashes = _base_hash(words)
        seeds = self.seeds[(hashes % np.uint64(len(self.seeds))).astype(np.int64)]
        return np.where(seeds < 0, -1 - seeds, self._slots(hashes, np.maximum(seeds, 0), self.n))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: pairs merge lowest rank first, leftmost among equals.

    The bytes form a linked list, the possible merges a heap; a merge outdates the entries of its
    neighbours, which are recognised by their length when they come up. n log n steps in all.
    """
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = after[:]  # end[i]: where the piece that starts at i ends; 0 once it is merged away
    heap = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := word[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not end[i] or j >= n or end[j] != stop or after[i] != end[i]:
            continue
        end[i], end[j] = stop, 0
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get(word[i : end[k]])) is not None:
                heapq.heappush(heap, (rank, i, end[k]))
        h = before[i]
        if h >= 0 and (rank := ranks.get(word[h:stop])) is not None:
            heapq.heappush(heap, (rank, h, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = after[i]
    return ids


class Encoder:
    """One worker's encoder: recent pre-tokens, then the perfect hash, then merges."""

    def __init__(self, tokens: list[bytes], perfect: PerfectHash, ids: np.ndarray, pattern: str, limit: int | None = None):
        import regex

        self.find = regex.compile(pattern).findall
        self.tokens, self.perfect, self.ids = tokens, perfect, ids
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.memo: dict[str, bytes] = {}
        self.limit = limit

    def learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "replace") for w in words]
        found = self.ids[self.perfect.slots(raw)].tolist()
        for word, key, i in zip(words, raw, found):
            ids = [i] if self.tokens[i] == key else merge(key, self.ranks)
            self.memo[word] = np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        words, memo = self.find(text), self.memo
        try:
            return b"".join(map(memo.__getitem__, words))
        except KeyError:
            distinct = dict.fromkeys(words)
            new = [w for w in distinct if w not in memo]
            if len(memo) + len(new) > (self.limit or MEMO):
                memo.clear()
                new = list(distinct)
            self.learn(new)
            return b"".join(map(memo.__getitem__, words))


def _with(df: DataFrame, column: str, kind) -> StructType:
    return StructType([*hide(df, column).schema.fields, StructField(column, kind)])


def encode(
    df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", memo: int | None = None
) -> DataFrame:
    """Add `ids`, the token ids (array<int>) of the whole `text`; a column of that name is replaced.

    Null and empty texts have no ids. Repeated rows are encoded alike. The vocabulary (a bounded file)
    is read on the driver once and broadcast. A text is never cut; a task holds one slice of a batch,
    and at least one text, at a time. A worker remembers the ids of up to `memo` (MEMO) pre-tokens: fewer take less
    memory and more time, with the same ids.
    """
    tokens = read_ranks(vocabulary)
    perfect = PerfectHash.build(tokens)
    by_slot = np.empty(len(tokens), np.int64)
    by_slot[perfect.slots(tokens)] = np.arange(len(tokens))
    shared = df.sparkSession.sparkContext.broadcast((tokens, perfect.seeds, by_slot))  # plain values
    rest = hide(df, ids).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build() -> Encoder:
            words, seeds, slots = shared.value
            return Encoder(words, PerfectHash(len(words), seeds), slots, pattern, memo)

        encoder = per_worker("bpe", build, f"{vocabulary} {pattern} {memo}")
        for batch in slices(batches, text):
            packed = [encoder.encode(t) if t else b"" for t in column_of(batch, text).to_pylist()]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([*(column_of(batch, c) for c in rest), lists], [*rest, ids])
        batch = packed = ends = lists = None
        trim()

    return df.mapInArrow(run, _with(df, ids, ArrayType(IntegerType())))


def gather(arena: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated pieces of an arena."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return arena[:0]
    shift = np.repeat(starts - np.concatenate(([0], ends[:-1])), lengths)
    return arena[shift + np.arange(ends[-1])]


class Arena:
    """Byte strings by number, joined many at a time."""

    def __init__(self, items: list[bytes]):
        self.bytes = np.frombuffer(b"".join(items), np.uint8)
        self.lengths = np.array([len(x) for x in items], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def join(self, ids: np.ndarray) -> bytes:
        return gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()


def each_list(array: pa.Array) -> Iterator[np.ndarray]:
    """The lists of an array of integers as numpy views; null: empty."""
    offsets = array.offsets.to_numpy()
    values = array.values.to_numpy(zero_copy_only=False)
    valid = array.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(array)):
        yield values[offsets[i] : offsets[i + 1]] if valid[i] else values[:0]


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Add `out`, the bytes of the tokens in `ids`, joined; null ids: no bytes.

    Single ids can stand for part of a character, so only the whole is sure to be UTF-8.
    """
    tokens = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    rest = hide(df, out).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arena = Arena(tokens.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                joined = [arena.join(x) for x in each_list(column_of(part, ids))]
                yield pa.RecordBatch.from_arrays(
                    [*(column_of(part, c) for c in rest), pa.array(joined, pa.binary())], [*rest, out]
                )
        arena = batch = part = joined = None
        trim()

    return df.mapInArrow(run, _with(df, out, BinaryType()))


def digests(df: DataFrame, ids: str = "ids", decoded: str = "bytes") -> DataFrame:
    """Replace ids and bytes by n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256."""
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    return hide(df, "n_tokens", "ids_sha256", "decoded_sha256").select(
        *[F.col(f"`{c}`") for c in hide(df, ids, decoded, "n_tokens", "ids_sha256", "decoded_sha256").columns],
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )


def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to."""
    return encoded_documents(table(spark, sf_dir, "documents"))


def encoded_documents(docs: DataFrame, memo: int | None = None, folder: str | None = None) -> DataFrame:
    """Ids of every document and what they decode to, as digests.

    With a folder the ids are written there before they are decoded: a task then has one Python worker at a
    time. Without, it has one that encodes and one that decodes.
    """
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = encode(docs.select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN, memo=memo).drop("text")
    if folder:
        ids = written(ids, f"{folder}/ids", "zstd")
    return digests(decode(ids, vocabulary))
