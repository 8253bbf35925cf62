"""Bytes of repeated passages: blockwise sorting of suffixes with a difference cover.

Two suffixes tie when their first `length` bytes are equal; what a tied suffix begins with is removed. Of
any two suffixes some pair of followers, less than `period` bytes on and equally far from both, lies in the
cover sample. So ranks of the sample are computed first, to two depths, and decide most suffixes:

* one whose sampled followers all differ from every other in `length - period + 1` bytes ties with none;
* ones after which sampled followers tie for `length + period - 1` bytes, or up to equal ends of their
  documents, tie: long ties need no sorting.

The suffixes left over, those near the ends of matches, are sorted to the depth of `length`, one bucket at
a time, among them the decided ones that a sampled follower ties with theirs. Only ranks that tell equal from
unequal are needed, so buckets are ranges of hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, freed, slices, table, trim, work_folder, written

#: Perfect difference sets: every distance modulo the period is that of exactly one pair.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}

#: Least length of a repeat that can be asked for.
SHORTEST = 16

#: Bytes of text whose suffixes, or samples, one bucket sorts.
BUCKET_BYTES = 32 << 20

#: Most bytes of marks that are broadcast to the slices; beyond it marks are dealt to the slices' buckets.
BROADCAST_BYTES = 32 << 20

#: Positions hashed at a time, few enough to stay in the cache, and the bytes they may lie apart.
AT_ONCE, APART = 1 << 15, 1 << 19

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def period_of(length: int) -> int:
    """The cover's period for repeats of this length: the larger, the fewer samples and the longer ends."""
    return max(p for p in COVERS if 2 * p <= length)


def hashes(text: np.ndarray, at: np.ndarray, length: int, lanes: int = 1) -> np.ndarray:
    """`lanes` 64-bit hashes of the `length` (8 at least) bytes of a text from each position; positions ascend."""
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    out = np.empty((lanes, len(at)), np.uint64)
    start = 0
    while start < len(at):
        low = int(at[start])
        end = start + int(np.searchsorted(at[start : start + AT_ONCE], low + APART))
        here = at[start:end] - low
        words = np.ndarray(shape=(int(here[-1]) + length - 7,), dtype="<u8", buffer=text, offset=low, strides=(1,))
        words = np.ascontiguousarray(words)  # the 8 bytes at each position
        states = [np.full(len(here), length + lane, np.uint64) for lane in range(lanes)]
        for step in steps:
            read = words[here + step]
            for h, odd in zip(states, _ODD):
                h ^= read
                h *= odd
                h ^= h >> np.uint64(29)
        for lane, h in enumerate(states):
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[lane, start:end] = h ^ (h >> np.uint64(32))
        start = end
    return out


def packed_runs(flags: np.ndarray) -> bytes:
    return np.flatnonzero(np.diff(flags, prepend=False, append=False)).astype("<i4").tobytes()


def unpacked_runs(runs: bytes, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int8)
    at = np.frombuffer(runs, "<i4")
    edge[at[::2]] = 1
    edge[at[1::2]] = -1
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


class Ties:
    """Which of a slice's keys occur again, in the slice or, as the buckets say, in another one.

    A slice sends each of its keys once, so that a key which a third of all rows share comes to its bucket
    once from each slice, and gets a bit for each back. Where keys carry flags (`said`), the question is
    whether a flag is set for the key anywhere.
    """

    def __init__(self, keys: np.ndarray, spread: np.ndarray, buckets: int, width: int, said: np.ndarray | None = None):
        self.width = width
        bucket = ((spread >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
        if width < 8:
            keys = keys & np.uint64((1 << 8 * width) - 1)
        order = np.argsort(keys)
        order = order[np.argsort(bucket[order].astype(np.min_scalar_type(buckets)), kind="stable")]
        keys, bucket = keys[order], bucket[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])
        self.place = np.empty(len(keys), np.int64)
        self.place[order] = np.cumsum(first) - 1
        self.keys, self.buckets = keys[first], bucket[first].astype(np.int64)
        if said is None:
            self.here, self.said = np.bincount(self.place, minlength=len(self.keys)) > 1, None
        else:
            self.here = self.said = np.bincount(self.place[said], minlength=len(self.keys)) > 0

    def packed(self) -> Iterator[tuple[int, bytes, bytes | None]]:
        """(bucket, its keys, their flags) in order of buckets."""
        cuts = [0, *(np.flatnonzero(np.diff(self.buckets)) + 1).tolist(), len(self.keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                raw = self.keys[start:end].astype("<u8").view(np.uint8).reshape(-1, 8)
                said = None if self.said is None else np.packbits(self.said[start:end]).tobytes()
                yield int(self.buckets[start]), raw[:, : self.width].tobytes(), said

    def marked(self, bits: list[tuple[int, bytes]]) -> np.ndarray:
        """One flag for each key the slice had at first."""
        parts, at = [], 0
        for bucket, found in sorted(bits):
            n = int(np.searchsorted(self.buckets, bucket, "right")) - at
            parts.append(np.unpackbits(np.frombuffer(found, np.uint8), count=n))
            at += n
        elsewhere = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
        return (self.here | elsewhere)[self.place]


def sorted_bucket(blobs: list[bytes], said: list[bytes | None], width: int) -> list[bytes]:
    """Sort a bucket's keys; per blob a bit for each key: whether another blob has it, or any blob's flag is set."""
    counts = [len(b) // width for b in blobs]
    raw = np.zeros((sum(counts), 8), np.uint8)
    raw[:, :width] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
    keys = raw.view("<u8").ravel()
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    tied = np.zeros(len(keys), bool)
    if said[0] is None:
        tied[order[1:][same]] = True
        tied[order[:-1][same]] = True
    else:
        flags = [np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(said, counts)]
        group = np.concatenate([[0], np.cumsum(~same)])
        tied[order] = (np.bincount(group, np.concatenate(flags)[order]) > 0)[group]
    return [np.packbits(part).tobytes() for part in np.split(tied, np.cumsum(counts)[:-1])]


class Slice:
    """Some documents one after the other, and what rounds have found out about their suffixes.

    `marks` are those of the last round, `state` what earlier ones have left: nothing is worked out twice.
    """

    def __init__(
        self, data: bytes, sizes: np.ndarray, length: int, buckets: int, state: dict[str, bytes], marks: list[tuple[int, bytes]]
    ):
        self.bytes = np.frombuffer(data, np.uint8) if len(data) else np.empty(0, np.uint8)
        self.n, self.length, self.buckets, self.state, self.marks = len(data), length, buckets, state, marks
        self.period = period_of(length)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def _inside(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether a position lies in one of the ranges from `first` to before `last`."""
        edge = np.zeros(self.n + 1, np.int32)
        np.add.at(edge, first, 1)
        np.add.at(edge, last, -1)
        return np.cumsum(edge[:-1], out=edge[:-1]) > 0

    @cached_property
    def _samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cover sample with a short depth left in their document, and the documents' ends."""
        short = self.length - self.period + 1
        longest = int((self.ends - self.starts).max(initial=0))
        cover = np.asarray(COVERS[self.period])
        offsets = (np.arange(0, longest, self.period)[:, None] + cover).ravel()
        counts = np.searchsorted(offsets, self.ends - self.starts - short, "right")
        at = [offsets[:n] + start for n, start in zip(counts.tolist(), self.starts.tolist()) if n]
        ends = np.repeat(self.ends, counts)
        return (np.concatenate(at) if at else np.empty(0, np.int64)), ends

    @cached_property
    def short_ties(self) -> Ties:
        """Round 1: samples by their first length - period + 1 bytes."""
        keys = hashes(self.bytes, self._samples[0], self.length - self.period + 1)[0]
        return Ties(keys, keys, self.buckets, 5)

    @cached_property
    def tied_flags(self) -> np.ndarray:
        if "tied" in self.state:
            bits = np.frombuffer(self.state["tied"], np.uint8)
            return np.unpackbits(bits, count=len(self._samples[0])).astype(bool)
        return self.short_ties.marked(self.marks)

    @cached_property
    def _tied(self) -> tuple[np.ndarray, np.ndarray]:
        return self._samples[0][self.tied_flags], self._samples[1][self.tied_flags]

    @cached_property
    def long_ties(self) -> Ties:
        """Round 2: tied samples by their first length + period - 1 bytes, or all bytes of a document that has less.

        The latter are named by what is left and three overlapping pieces of the short depth, the last at the end.
        """
        at, ends = self._tied
        short, deep = self.length - self.period + 1, self.length + self.period - 1
        whole = at + deep <= ends
        keys = np.empty((2, len(at)), np.uint64)
        keys[:, whole] = hashes(self.bytes, at[whole], deep, 2)
        first, last = at[~whole], ends[~whole] - short
        key = np.tile((ends[~whole] - first).astype(np.uint64), (2, 1))
        for piece in (first, np.minimum(first + short, last), last):
            key = (key ^ hashes(self.bytes, piece, short, 2)) * _ODD[:, None]
            key ^= key >> np.uint64(31)
        keys[:, ~whole] = key
        return Ties(keys[0], keys[1], self.buckets, 8)

    @cached_property
    def decided(self) -> np.ndarray:
        """Suffixes that tie because a sample tied for long."""
        if "decided" in self.state:
            return unpacked_runs(self.state["decided"], self.n)
        long = self.long_ties.marked(self.marks)
        at, ends = self._tied[0][long], self._tied[1][long]
        last = np.minimum(at + self.period, ends - self.length + 1)
        return self._inside(at[at < last], last[at < last])

    def _before(self, which: np.ndarray) -> np.ndarray:
        """Suffixes with one of these tied samples among their followers."""
        at, ends = self._tied[0][which], self._tied[1][which]
        begins = self.starts[np.searchsorted(self.ends, at, "right")]
        first, last = np.maximum(at - self.period + 1, begins), np.minimum(at, ends - self.length) + 1
        some = first < last  # none in a document shorter than `length`
        return self._inside(first[some], last[some])

    @cached_property
    def _open(self) -> np.ndarray:
        """Suffixes that may tie: a sample among their followers does, and no long tie has decided them."""
        return self._before(np.ones(len(self._tied[0]), bool)) & ~self.decided

    @cached_property
    def wanted_ties(self) -> Ties:
        """Round 3: tied samples again; those that follow an open suffix say so to the others of their rank."""
        at, ends = self._tied
        begins = self.starts[np.searchsorted(self.ends, at, "right")]
        opened = np.zeros(self.n + 1, np.int32)
        np.cumsum(self._open, out=opened[1:])
        said = opened[at + 1] > opened[np.maximum(at - self.period + 1, begins)]
        keys = hashes(self.bytes, at, self.length - self.period + 1)[0]
        return Ties(keys, keys, self.buckets, 5, said)

    @cached_property
    def sorted(self) -> np.ndarray:
        """Open suffixes, and those decided ones that an open one may tie with."""
        if "sorted" in self.state:
            return unpacked_runs(self.state["sorted"], self.n)
        return self._open | (self.decided & self._before(self.wanted_ties.marked(self.marks)))

    @cached_property
    def suffix_ties(self) -> Ties:
        """Round 4: these suffixes by their first `length` bytes. Keys are full; a second hash picks the bucket."""
        keys, spread = hashes(self.bytes, np.flatnonzero(self.sorted), self.length, 2)
        return Ties(keys, spread, self.buckets, 8)

    def covered(self) -> np.ndarray:
        """The bytes that some tied suffix begins with."""
        starts = self.decided.copy()
        starts[np.flatnonzero(self.sorted)[self.suffix_ties.marked(self.marks)]] = True
        edges = np.flatnonzero(np.diff(starts, prepend=False, append=False))
        return self._inside(edges[::2], edges[1::2] + self.length - 1)

    def documents(self) -> Iterator[tuple[list[dict[str, int]], bytes]]:
        """Each document's maximal removed spans, and its other bytes."""
        covered = self.covered()
        for start, end in zip(self.starts.tolist(), self.ends.tolist()):
            removed, own = covered[start:end], self.bytes[start:end]
            if not removed.any():
                yield [], own.tobytes()
                continue
            edges = np.flatnonzero(np.diff(removed, prepend=False, append=False)).tolist()
            spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
            yield spans, own[~removed].tobytes()


#: Of each round: its keys, their bytes (where a chance tie only costs work, 5 do), and what it leaves of the one before.
ROUNDS: tuple[tuple[Callable[[Slice], Ties], int, str, Callable[[Slice], bytes]], ...] = (
    (lambda s: s.short_ties, 5, "", lambda s: b""),
    (lambda s: s.long_ties, 8, "tied", lambda s: np.packbits(s.tied_flags).tobytes()),
    (lambda s: s.wanted_ties, 5, "decided", lambda s: packed_runs(s.decided)),
    (lambda s: s.suffix_ties, 8, "sorted", lambda s: packed_runs(s.sorted)),
)


def _slices(df: DataFrame, kind: str) -> DataFrame:
    """(slice, keys, sizes, data): documents in rows of a few megabytes, null texts as empty ones."""

    def run(batches):
        made = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text"):
            keys = column_of(batch, "key")
            texts = [t.encode("utf-8") if t else b"" for t in column_of(batch, "text").to_pylist()]
            ends = pa.array([0, len(texts)], pa.int32())
            sizes = pa.ListArray.from_arrays(ends, pa.array(list(map(len, texts)), pa.int64()))
            whole = pa.ListArray.from_arrays(ends, keys)
            data = pa.array([b"".join(texts)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), whole, sizes, data], ["slice", "keys", "sizes", "data"]
            )
            made += 1

    return df.mapInArrow(run, f"slice long, keys array<{kind}>, sizes array<long>, data binary")


def _read(batches, length: int, buckets: int) -> Iterator[tuple[int, pa.RecordBatch, int, Slice]]:
    """The slices of a task, one at a time, with what is known of them."""
    for batch in batches:
        known = [n for _, _, n, _ in ROUNDS if n in batch.schema.names]
        for i in range(batch.num_rows):
            state = {n: column_of(batch, n)[i].as_py() for n in known}
            marks = column_of(batch, "marks")[i].as_py() if "marks" in batch.schema.names else None
            sizes = column_of(batch, "sizes")[i].values.to_numpy()
            data = column_of(batch, "data")[i].as_buffer()
            pairs = [(m["bucket"], m["bits"]) for m in marks or []]
            yield column_of(batch, "slice")[i].as_py(), batch, i, Slice(data, sizes, length, buckets, state, pairs)
    trim()


def _dealt(df: DataFrame, folder: str) -> DataFrame:
    """The slices as a table in buckets, as many as the session has shuffle partitions: what joins them comes to them."""
    spark = df.sparkSession
    parts = min(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), 100_000)  # Spark takes no more buckets
    name = f"dimweave_slices_{uuid.uuid4().hex}"
    df.write.bucketBy(parts, "slice").option("compression", "zstd").option("path", folder).saveAsTable(name)
    dealt = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: files with a path of their own stay
    return dealt


def _joined(docs: DataFrame, facts: DataFrame, weight: int) -> DataFrame:
    """Slices with a row of facts each, which are broadcast if they weigh little; slices are never shuffled."""
    return docs.join(F.broadcast(facts) if weight <= BROADCAST_BYTES else facts.hint("shuffle_hash"), "slice", "left")


def _round(
    docs: DataFrame, known: DataFrame, states: dict[str, DataFrame], step: int, length: int, buckets: int, folder: str
) -> DataFrame:
    """One more round: keys go to their buckets, bits come back as marks, beside the states so far.

    `known` are the slices of `docs` with what the rounds before have left. A state is a bucket of its own.
    """
    keys_of, width, name, state_of = ROUNDS[step]

    def send(batches):
        for place, _, _, here in _read(batches, length, buckets):
            found = list(keys_of(here).packed())
            if name:
                found.append((-1 - place, state_of(here), None))
            del here  # before the next one is made
            for start in range(0, len(found), 256):
                at, keys, said = zip(*found[start : start + 256])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at, pa.int64()),
                        pa.array([place] * len(at), pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(said, pa.binary()),
                    ],
                    ["bucket", "slice", "keys", "said"],
                )

    def sort(group: pa.Table) -> pa.Table:
        if group.num_rows and group["bucket"][0].as_py() < 0:
            return group.select(["bucket", "slice", "keys"]).rename_columns(["bucket", "slice", "bits"])
        bits = sorted_bucket(group.column("keys").to_pylist(), group.column("said").to_pylist(), width)
        return group.select(["bucket", "slice"]).append_column("bits", pa.array(bits, pa.binary()))

    sent = known.mapInArrow(send, "bucket long, slice long, keys binary, said binary").groupBy("bucket")
    bits = written(sent.applyInArrow(sort, "bucket long, slice long, bits binary"), f"{folder}/bits{step}")
    freed(docs.sparkSession)
    if name:
        states[name] = bits.where("bucket < 0")
    kinds = {n: F.when(F.col("kind") == n, F.col("bits")) for n in states}
    rows = bits.where("bucket >= 0").withColumn("kind", F.lit("marks"))
    for n, state in states.items():
        rows = rows.union(state.withColumn("kind", F.lit(n)))
    marks = F.collect_list(F.when(F.col("kind") == "marks", F.struct("bucket", "bits"))).alias("marks")
    facts = rows.groupBy("slice").agg(marks, *(F.max(bits_of).alias(n) for n, bits_of in kinds.items()))
    return _joined(docs, facts, rows.agg(F.sum(F.length("bits") + 32)).first()[0] or 0)


def without_repeats(
    df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", length: int = 200, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(key, n_bytes, spans, kept): each text's bytes without those covered by a repeated `length`-byte string.

    A row per row of `df`; key may be null or repeated, other columns are left out whatever their names. A
    string repeats if it starts at another place too, in the same text or another, overlapping or not;
    matches stay inside a text. Null texts are empty, and texts under `length` bytes lose nothing. Texts that
    occur twice (and are long enough) go whole: an equal row is another place. `spans` are the maximal removed
    runs (start, end), `kept` the other bytes, which need not be UTF-8 any more. No rows, no result.

    Equality is that of 64-bit hashes and of the bucket, whose number comes from further hash bits and grows
    with the data. A bucket holds the samples of about `bucket_bytes` of text. In each of four rounds a slice
    gets a bit back for each key it sent.
    """
    if length < SHORTEST:
        raise ValueError(f"repeats have {SHORTEST} bytes at least")
    kind = df.schema[key].dataType.simpleString()
    plain = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    docs = _dealt(_slices(plain, kind), f"{folder}/slices")
    total = docs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = total // bucket_bytes + 1
    known, states = docs, {}
    for step in range(len(ROUNDS)):
        known = _round(docs, known, states, step, length, buckets, folder)

    def finish(batches):
        for _, batch, i, here in _read(batches, length, buckets):
            spans, kept = zip(*here.documents())
            whole = pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "keys")[i].values,
                    pa.array(here.ends - here.starts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["key", "n_bytes", "spans", "kept"],
            )
            yield whole
            del here, spans, kept, whole

    found = known.mapInArrow(finish, f"key {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
    return found.withColumnRenamed("key", key)


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes without the passages of 200 bytes or more that occur elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = without_repeats(docs, work_folder(spark, "suffixes"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
