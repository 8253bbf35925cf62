"""A Bloom filter of a source's keys, probed where the target is read.

Between a key list small enough to broadcast and a full shuffle of the target there is this: some bits for each
key, in blocks of 512 that are the rows of a broadcast table. A target row looks its key's block up and stays
if all of the key's bits are set, so what goes into the shuffle are the rows that match and a few others. All
of it is built-in expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.hashing import quoted
from dimweave.operators.skew import hashes_as_it_compares

WORDS, WORD_BITS = 8, 64
# Bits set for a key, and bits a key has room for: about one row in a hundred passes by chance.
PROBES, BITS_PER_KEY = 4, 12
# Rows of the filter at most, each of nine longs: what is broadcast.
MOST_BLOCKS = 1 << 20
# Names no table column has.
BLOCK = "#block"
WORD = "#word"


def blocks_for(keys: int) -> int:
    """Blocks for that many keys, a power of two."""
    wanted = -(-keys * BITS_PER_KEY // (WORDS * WORD_BITS))
    return 1 << max(0, wanted - 1).bit_length()


def _block(names: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*map(quoted, names)), F.lit(blocks)).cast("int")


def _bits(names: list[str]) -> list[tuple[Column, Column]]:
    """(word, mask) of each bit of a key."""
    other = F.xxhash64(F.lit(1), *map(quoted, names))
    found = []
    for i in range(PROBES):
        place = F.shiftrightunsigned(other, 9 * i).bitwiseAND(F.lit(WORDS * WORD_BITS - 1))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int"))
        found.append((F.shiftright(place, 6), mask))
    return found


def key_filter(src: DataFrame, names: list[str], blocks: int) -> DataFrame:
    """The filter's blocks that hold a key; aggregated before the shuffle, as many rows as blocks at most."""
    words = []
    for j in range(WORDS):
        parts = [F.when(word == j, mask).otherwise(F.lit(0).cast("long")) for word, mask in _bits(names)]
        words.append(F.bit_or(reduce(lambda a, b: a.bitwiseOR(b), parts)).alias(f"{WORD}{j}"))
    return src.dropna(subset=names).groupBy(_block(names, blocks).alias(BLOCK)).agg(*words)


def filterable(tgt: DataFrame, src: DataFrame, names: list[str], keys: int) -> bool:
    """Whether a filter of that many keys may be broadcast, and equal keys of both sides share a hash."""
    kinds = src.select(*map(quoted, names)).schema, tgt.select(*map(quoted, names)).schema
    alike = all(a.dataType == b.dataType and hashes_as_it_compares(a.dataType) for a, b in zip(*kinds, strict=True))
    return alike and blocks_for(keys) <= MOST_BLOCKS


def possibly_held(tgt: DataFrame, src: DataFrame, names: list[str], keys: int) -> DataFrame:
    """Target rows whose key the source has, and about one in a hundred of the others; keys: its distinct keys."""
    blocks = blocks_for(keys)
    found = F.broadcast(key_filter(src.select(*map(quoted, names)), names, blocks))
    words = F.array(*[quoted(f"{WORD}{j}") for j in range(WORDS)])
    tests = [F.element_at(words, word.cast("int") + 1).bitwiseAND(mask) != 0 for word, mask in _bits(names)]
    near = tgt.dropna(subset=names).withColumn(BLOCK, _block(names, blocks)).join(found, BLOCK)
    return near.where(reduce(lambda a, b: a & b, tests)).select(*map(quoted, tgt.columns))
