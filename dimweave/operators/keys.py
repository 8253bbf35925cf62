"""Surrogate key column, and keys that are free."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from dimweave import columns as C
from dimweave.functions.hashing import quoted, surrogate_key
from dimweave.operators import checks

# Names no table column has.
FIRST = "#first"
ROWS = "#rows"
HELD = "#held"
KEY = "#key"
OLD = "#old"
LOST = "#lost"
TRY = "#try"

# Times that a row may look for a free key by one new key. Two do for 64 bits whatever the table's size.
ROUNDS = 16
# Keys that the rows left after that try in a round, all together, and at least each. A round that settles no
# row is repeated with twice as many, FRUITLESS times in a row at most.
TRIES, LEAST_TRIES, FRUITLESS = 1 << 18, 4, 4

Generator = Callable[[Sequence[str | Column]], Column]


def with_surrogate_key(
    df: DataFrame, cols: Sequence[str], out: str, generate: Generator = surrogate_key
) -> DataFrame:
    """Add a 64-bit key made of the given columns.

    For a history-keeping dimension include the version's start next to the business key, so that
    every version gets its own key.
    """
    return df.withColumn(out, generate(cols))


def taken_keys(feed: DataFrame, target: DataFrame, sid: str, dim: str) -> DataFrame:
    """Keys of a feed's inserts that not all of them can have: (key, who keeps it, whether the target has it).

    The insert with the smallest business key keeps a key unless the target holds it. Of the target one column
    is read; few keys are broadcast to it.
    """
    inserts = feed.where((quoted(C.ACTION) == C.INSERT) & quoted(sid).isNotNull())
    keys = inserts.groupBy(quoted(sid).alias(KEY)).agg(
        F.min(quoted(dim)).alias(FIRST), F.count(F.lit(1)).alias(ROWS)
    )
    held = _held(target, keys.select(KEY), sid)
    marked = keys.join(held.withColumn(HELD, F.lit(True)), KEY, "left").na.fill(False, [HELD])
    return marked.where((quoted(ROWS) > 1) | quoted(HELD)).select(KEY, FIRST, HELD)


def _held(target: DataFrame, wanted: DataFrame, sid: str) -> DataFrame:
    """Those of some distinct keys that the target has; few are broadcast to it."""
    if checks.measured_bytes(wanted) <= checks.BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    return target.select(quoted(sid).alias(KEY)).join(wanted, KEY, "left_semi").distinct()


def _moving(inserts: DataFrame, taken: DataFrame, sid: str, dim: str) -> tuple[DataFrame, Column]:
    """Inserts beside what is said of their taken key, and whether they must have another."""
    if checks.measured_bytes(taken) <= checks.BROADCAST_BYTES:
        taken = F.broadcast(taken)
    moves = quoted(KEY).isNotNull() & (quoted(HELD) | (quoted(dim) != quoted(FIRST)))
    return inserts.join(taken, quoted(sid) == quoted(KEY), "left"), moves


def _searched(
    inserts: DataFrame, target: DataFrame, sid: str, dim: str, tries: int, number: int, kind: DataType, generate: Generator
) -> DataFrame:
    """Inserts of which each lost one has looked at `tries` keys and has the first that nobody holds.

    Of those that found the same key the one with the smallest business key gets it, the others stay lost.
    """
    nth = F.explode(F.sequence(F.lit(0), F.lit(tries - 1))).alias(TRY)
    drawn = inserts.where(quoted(LOST)).select(quoted(dim), quoted(sid), nth)
    key = generate([dim, quoted(sid).cast("string"), F.lit(str(number)), quoted(TRY).cast("string")])
    drawn = drawn.withColumn(KEY, key.cast(kind))
    held = _held(target, drawn.select(KEY).distinct(), sid).union(inserts.select(quoted(sid))).distinct()
    first = drawn.join(held, KEY, "left_anti").groupBy(quoted(dim), quoted(sid)).agg(F.min_by(KEY, TRY).alias(KEY))
    found = first.groupBy(KEY).agg(F.min(F.struct(quoted(dim).alias(FIRST), quoted(sid).alias(HELD))).alias(ROWS))
    found = found.select(KEY, quoted(ROWS)[FIRST].alias(FIRST), quoted(ROWS)[HELD].alias(HELD))
    own = quoted(LOST) & (quoted(sid) == quoted(HELD)) & quoted(dim).eqNullSafe(quoted(FIRST))
    joined = inserts.join(found, own, "left").withColumn(LOST, quoted(LOST) & quoted(KEY).isNull())
    return joined.withColumn(sid, F.coalesce(quoted(KEY), quoted(sid))).select(*map(quoted, inserts.columns))


def with_free_keys(
    feed: DataFrame,
    target: DataFrame,
    sid: str,
    dim: str,
    keep: Callable[[DataFrame, int], DataFrame],
    generate: Generator = surrogate_key,
) -> DataFrame:
    """A feed whose inserts have keys of their own, free in feed and target.

    An insert whose key is taken gets one made of its business key, the taken key and the round, and is
    looked at again, so that the same feed always ends in the same keys. Where keys are so scarce that rows
    are left after ROUNDS of that, these try many keys in a round and keep the first that is free, for as
    long as some row finds one. ``keep`` writes the keys of a round and reads them back; without clashes,
    the usual case, there is one such round and the feed returns as it came. A business key has one insert
    at most, as in a Type 2 feed.
    """
    kind = target.schema[sid].dataType
    feed = feed.withColumn(sid, quoted(sid).cast(kind))
    is_insert = (quoted(C.ACTION) == C.INSERT) & quoted(sid).isNotNull()
    inserts = feed.where(is_insert).select(quoted(dim), quoted(C.ACTION), quoted(sid), quoted(sid).alias(OLD))
    columns = inserts.columns
    for number in range(ROUNDS):
        taken = keep(taken_keys(inserts, target, sid, dim), 2 * number)
        if taken.isEmpty():
            break
        joined, moves = _moving(inserts, taken, sid, dim)
        again = generate([dim, quoted(sid).cast("string"), F.lit(str(number))]).cast(kind)
        renamed = joined.withColumn(sid, F.when(moves, again).otherwise(quoted(sid)))
        inserts = keep(renamed.select(*map(quoted, columns)), 2 * number + 1)
    else:
        inserts = _with_scarce_keys(inserts, target, sid, dim, keep, kind, generate)
    if number == 0:
        return feed
    moved = inserts.where(quoted(sid) != quoted(OLD))
    moved = moved.select(quoted(dim).alias(FIRST), quoted(OLD), quoted(sid).alias(KEY))
    if checks.measured_bytes(moved) <= checks.BROADCAST_BYTES:
        moved = F.broadcast(moved)
    own = is_insert & (quoted(sid) == quoted(OLD)) & quoted(dim).eqNullSafe(quoted(FIRST))
    joined = feed.join(moved, own, "left").withColumn(sid, F.coalesce(quoted(KEY), quoted(sid)))
    return keep(joined.select(*map(quoted, feed.columns)), 2 * ROUNDS)


def _with_scarce_keys(
    inserts: DataFrame,
    target: DataFrame,
    sid: str,
    dim: str,
    keep: Callable[[DataFrame, int], DataFrame],
    kind: DataType,
    generate: Generator,
) -> DataFrame:
    """Inserts of which those whose key is taken have searched for one that is free."""
    number, fruitless = 2 * ROUNDS + 1, 0
    joined, moves = _moving(inserts, taken_keys(inserts, target, sid, dim), sid, dim)
    marked = joined.select(*map(quoted, inserts.columns), F.coalesce(moves, F.lit(False)).alias(LOST))
    inserts = keep(marked, number)
    lost = inserts.where(quoted(LOST)).count()
    while lost and fruitless < FRUITLESS:
        number += 1
        tries = max(LEAST_TRIES, (TRIES << fruitless) // lost)
        inserts = keep(_searched(inserts, target, sid, dim, tries, number, kind, generate), number)
        left = inserts.where(quoted(LOST)).count()
        fruitless, lost = fruitless + 1 if left == lost else 0, left
    clashes = taken_keys(inserts, target, sid, dim).count()
    if clashes:
        raise RuntimeError(f"{clashes} surrogate keys are still taken after {number} rounds")
    return inserts
