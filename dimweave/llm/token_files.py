"""Token ids in binary files: patched frame-of-reference blocks with an index, written and read by tasks."""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, per_worker, slices, table, work_folder, written

#: Ids in a block, the percentile of a block's offsets that its width holds, ids in a file.
BLOCK, PERCENTILE, FILE_IDS = 1024, 98, 32 << 20

#: Runs, and words, whose ids a worker keeps; emptied when full.
MEMO = 1_000_000

MAGIC = b"DWTOKEN1"
HEAD, HEAD_SIZE = "<IBH", 7  # of a block: minimum, bits of an offset, number of exceptions
FOOT, FOOT_SIZE = "<QQQQ", 32  # of a file: ids, documents, bytes of blocks, bytes of the document index


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of BLOCK ids (the last may be shorter, and is filled up with its minimum).

    A block holds each id's offset from the block's minimum, in as many bits as PERCENTILE % of its
    offsets need. Larger offsets are exceptions: place and full offset in a list at the block's end.
    """
    blocks = []
    for start in range(0, len(ids), 64 * BLOCK):
        part = ids[start : start + 64 * BLOCK].astype(np.uint32)
        rows = -(-len(part) // BLOCK)
        grid = np.resize(part, rows * BLOCK).reshape(rows, BLOCK)
        tail = len(part) - (rows - 1) * BLOCK
        grid[-1, tail:] = part[(rows - 1) * BLOCK :].min()
        least = grid.min(axis=1)
        offsets = grid - least[:, None]
        at = np.partition(offsets, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100]
        widths = np.ceil(np.log2(at.astype(np.float64) + 1)).astype(np.int64)
        packed: list[bytes] = [b""] * rows
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            bits = (offsets[own, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
            flat = np.packbits(bits.astype(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
            for row, block in zip(own, flat):
                over = np.flatnonzero(offsets[row] >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
                packed[row] = b"".join((
                    struct.pack(HEAD, int(least[row]), int(width), len(over)),
                    block.tobytes(),
                    over.astype("<u2").tobytes(),
                    offsets[row][over].astype("<u4").tobytes(),
                ))
        blocks += packed
    return blocks


def unpack_block(block: bytes) -> np.ndarray:
    least, width, exceptions = struct.unpack_from(HEAD, block)
    at = HEAD_SIZE + BLOCK * width // 8
    bits = np.frombuffer(block, np.uint8, at - HEAD_SIZE, HEAD_SIZE)
    grid = np.unpackbits(bits, bitorder="little").reshape(BLOCK, width)
    offsets = grid.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))
    places = np.frombuffer(block, "<u2", exceptions, at)
    offsets[places] = np.frombuffer(block, "<u4", exceptions, at + 2 * exceptions)
    return offsets + np.uint32(least)


def shared_file(uri: str, mode: str) -> BinaryIO:
    """A file of a store that tasks and driver share, by its address."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = f"file://{uri[5:]}"
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path, compression=None) if mode == "w" else store.open_input_file(path)


class FileWriter:
    """One file: blocks as they fill, then the documents' index, the blocks' starts and a footer."""

    def __init__(self, uri: str):
        self.uri, self.out = uri, shared_file(uri, "w")
        self.out.write(MAGIC)
        self.at, self.starts, self.held, self.n = len(MAGIC), [], np.empty(0, np.uint32), 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.pending: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids))
        self.n += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 64 * BLOCK:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate([self.held, *self.pending])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack_blocks(ids[:whole]):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.held, self.pending, self.waiting = ids[whole:], [], 0

    def close(self) -> dict:
        self._write(True)
        valid = np.array([d is not None for d in self.docs], np.uint8)
        docs = np.array([d or 0 for d in self.docs], "<i8")
        index = valid.tobytes() + docs.tobytes() + np.array(self.lengths, "<u8").tobytes()
        self.out.write(index + np.array([*self.starts, self.at], "<u8").tobytes())
        self.out.write(struct.pack(FOOT, self.n, len(self.docs), self.at, len(index)))
        self.out.close()
        return {"path": self.uri, "n_docs": len(self.docs), "n_ids": self.n}


class FileReader:
    def __init__(self, uri: str):
        self.file = shared_file(uri, "r")
        size = self.file.size()
        self.file.seek(size - FOOT_SIZE)
        self.n, n_docs, blocks_end, index_bytes = struct.unpack(FOOT, self.file.read(FOOT_SIZE))
        self.file.seek(blocks_end)
        index = self.file.read(index_bytes)
        valid = np.frombuffer(index, np.uint8, n_docs)
        docs = np.frombuffer(index, "<i8", n_docs, n_docs)
        self.docs = [int(d) if v else None for d, v in zip(docs, valid)]
        self.lengths = np.frombuffer(index, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.starts = np.frombuffer(self.file.read(size - FOOT_SIZE - blocks_end - index_bytes), "<u8").astype(np.int64)
        self.file.seek(0)
        if self.file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is no token file")

    def ids(self, start: int, end: int) -> Iterator[np.ndarray]:
        """Ids at places start to end of the file, in pieces of a few hundred blocks."""
        first, last = start // BLOCK, -(-end // BLOCK)
        for at in range(first, last, 256):
            to = min(at + 256, last)
            self.file.seek(int(self.starts[at]))
            raw = self.file.read(int(self.starts[to] - self.starts[at]))
            cuts = self.starts[at : to + 1] - self.starts[at]
            piece = np.concatenate([unpack_block(raw[a:b]) for a, b in zip(cuts, cuts[1:])])
            yield piece[max(0, start - at * BLOCK) : end - at * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, place of its first id, number of ids, their CRC-32 as 32-bit integers) in file order."""
        ends = np.cumsum(self.lengths)
        doc, crc = 0, 0
        done = 0
        for piece in self.ids(0, self.n):
            at = 0
            while at < len(piece):
                take = min(len(piece) - at, int(ends[doc]) - done)
                crc = zlib.crc32(piece[at : at + take].astype("<u4").tobytes(), crc)
                at, done = at + take, done + take
                while doc < len(self.docs) and done == ends[doc]:
                    yield self.docs[doc], int(ends[doc] - self.lengths[doc]), int(self.lengths[doc]), crc
                    doc, crc = doc + 1, 0


# Fixed values of the tokenizer's pattern, for text of ASCII and the letters À to ÿ: its runs, and what is beyond.
_RUN = re.compile(rb"(?:[a-z]++|(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)++|'(?:s|t|re|ve|m|ll|d)|[0-9]|[!-/:-@\[-`{-~]++")
_BEYOND = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f-\xc2\xc4-\xff](?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])")


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, from a memo of what stands between white space.

    Its pattern parts such a piece into runs, mostly one. A run (letters, one digit, signs, an ending
    after an apostrophe) is encoded by itself and ends with a token that says so. New runs are therefore
    encoded many at a time as one text and told apart again. A text with characters beyond ASCII and the letters À to ÿ, whose classes and normal forms
    only the tokenizer knows, or with a special token, goes to the tokenizer word by word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special)) or rb"(?!)")
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _learn_runs(self, runs: list[bytes]) -> None:
        for at in range(0, len(runs), 1000):
            part = runs[at : at + 1000]
            ids = np.array(self.batch([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("the tokenizer does not end plain runs with a token of their own")
            raw, ends = ids.tobytes(), (4 * cuts).tolist()
            self.pieces.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)]))

    def _learn_pieces(self, pieces: list[bytes]) -> None:
        parted, known = list(map(_RUN.findall, pieces)), self.pieces
        self._learn_runs(list({r for own in parted for r in own if r not in known}))
        for piece, own in zip(pieces, parted):
            if len(own) != 1:
                known[piece] = b"".join([known[r] for r in own])

    def _learn_words(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            made = self.batch([w.decode() for w in part], add_special_tokens=False)
            self.words.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(part, made))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        for memo in (self.pieces, self.words):
            if len(memo) > MEMO:
                memo.clear()
        found, new_pieces, new_words = [], set(), set()
        for text in texts:
            raw = text.encode("utf-8", "replace")
            if _BEYOND.search(raw) or self.special.search(raw):
                memo, new, own = self.words, new_words, raw.split()
            else:
                memo, new, own = self.pieces, new_pieces, raw.lower().split()
            ids = list(map(memo.get, own))
            if None in ids:
                new.update([x for x, known in zip(own, ids) if known is None])
                found.append((memo, own))
            else:
                found.append((None, b"".join(ids)))
        self._learn_pieces(list(new_pieces))
        self._learn_words(list(new_words))
        return [np.frombuffer(b"".join(map(memo.__getitem__, x)) if memo else x, "<u4") for memo, x in found]


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode texts and write their ids, each text's followed by `end_id`, in ascending order of `key`.

    Returns the manifest (part, file, path, n_docs, n_ids), itself written to `folder`: a lost task
    leaves a file that no manifest names, its retry writes another. Null keys come first, rows with
    equal keys in order of a hash of their texts; null texts have `end_id` only. A range of keys goes
    to a task, which holds a slice of texts and less than a hundred blocks at once and begins a new
    file after FILE_IDS ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker("words", lambda: WordEncoder(tokenizer), tokenizer)
        part, files, writer = TaskContext.get().partitionId(), [], None
        end = np.array([end_id], "<u4")
        for batch in slices(batches, text):
            texts = [t or "" for t in column_of(batch, text).to_pylist()]
            for doc, ids in zip(column_of(batch, key).to_pylist(), encoder.encode(texts)):
                if writer is None:
                    writer = FileWriter(f"{folder}/ids/{part:06d}-{len(files):04d}-{uuid.uuid4().hex}")
                writer.add(doc, np.concatenate((ids, end)))
                if writer.n >= FILE_IDS:
                    files.append(writer.close())
                    writer = None
        if writer is not None:
            files.append(writer.close())
        rows = [{"part": part, "file": i, **f} for i, f in enumerate(files)]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("part", pa.int64()), ("file", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
        ]))

    spark = df.sparkSession
    folder_path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/ids")
    folder_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder_path)
    tie = F.xxhash64(text)
    ordered = df.select(key, text).repartitionByRange(F.col(key).asc_nulls_first(), tie)
    ordered = ordered.sortWithinPartitions(F.col(key).asc_nulls_first(), tie)
    manifest = ordered.mapInArrow(run, "part long, file long, path string, n_docs long, n_ids long")
    return written(manifest, f"{folder}/manifest")


def read_token_files(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document of the files, read back; start counts from the first file."""
    order = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0).cast("long")))
    spread = based.select("path", "base").repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, base in zip(column_of(batch, "path").to_pylist(), column_of(batch, "base").to_pylist()):
                rows = []
                for doc, start, n, crc in FileReader(path).documents():
                    rows.append((doc, base + start, n, crc))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return spread.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to files and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    return read_token_files(write_token_files(docs, work_folder(spark, "tokens"), path, end_id=1))
