"""Key checks that run before a load, and the size checks behind every broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.hashing import quoted
from dimweave.operators.joins import Keys, key_list
from dimweave.operators.key_filter import filterable, possibly_held
from dimweave.operators.skew import estimated_bytes

# Most that a measured side may weigh to be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# A target that Spark estimates below this is shuffled as it is.
FILTERED_BYTES = 1024 * 1024 * 1024
# Weight of a value besides its text: pointers, length, hash slot.
VALUE_OVERHEAD = 16


class DuplicateKeyError(ValueError):
    """A load input holds more than one row for a key."""


@dataclass(frozen=True)
class KeyProfile:
    """What one aggregate over the key columns tells about an input."""

    most_rows: int
    """Rows of the key that has most of them; rows with a NULL in the key do not count."""
    key_bytes: int
    """Weight of the distinct keys."""
    keys: int = field(default=0, compare=False)
    """Their number, as far as it was counted."""

    @property
    def broadcastable(self) -> bool:
        return self.key_bytes <= BROADCAST_BYTES


def _weight(columns: Sequence[str]) -> Column:
    lengths = [F.coalesce(F.octet_length(quoted(c).cast("string")), F.lit(0)) for c in columns]
    total = F.lit(VALUE_OVERHEAD * len(columns)).cast("bigint")
    for length in lengths:
        total = total + length
    return total


def measured_bytes(df: DataFrame) -> int:
    """Weight of a DataFrame's rows, by one aggregate."""
    return df.agg(F.sum(_weight(df.columns))).first()[0] or 0


def _rows_per_key(df: DataFrame, names: list[str]) -> DataFrame:
    present = df.select(*map(quoted, names)).dropna(subset=names)
    return present.groupBy(*map(quoted, names)).agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, keys: Keys) -> DataFrame:
    """Keys with more than one row and how many. Rows with a NULL in the key match nothing and pass."""
    return _rows_per_key(df, key_list(keys)).where("row_count > 1")


def key_profile(df: DataFrame, keys: Keys) -> KeyProfile:
    names = key_list(keys)
    summary = _rows_per_key(df, names).agg(
        F.max("row_count"), F.sum(_weight(names)), F.count(F.lit(1))
    )
    most_rows, key_bytes, n = summary.first()
    return KeyProfile(most_rows or 0, key_bytes or 0, n)


def require_unique(df: DataFrame, keys: Keys, what: str = "input") -> KeyProfile:
    """Raise when a key repeats, naming at most five; otherwise return the profile."""
    profile = key_profile(df, keys)
    if profile.most_rows > 1:
        found = duplicate_keys(df, keys).limit(5).collect()
        shown = ", ".join(str(row.asDict()) for row in found)
        raise DuplicateKeyError(f"{what} repeats keys {key_list(keys)}: {shown}")
    return profile


def held_by(tgt: DataFrame, src: DataFrame, keys: Keys, profile: KeyProfile) -> DataFrame:
    """Target rows whose key the source has, when the source's keys are few enough to broadcast.

    A small delta then meets a large target without a shuffle of the target: the rows that do not
    concern it are dropped where they are read. For more keys a Bloom filter of them is broadcast, which
    lets about one row in a hundred of the others pass, unless the target is small. For a source of any
    other size the target is returned as it is.
    """
    names = key_list(keys)
    if profile.broadcastable:
        wanted = src.select(*map(quoted, names)).distinct()
        return tgt.join(F.broadcast(wanted), names, "left_semi").select(*map(quoted, tgt.columns))
    if estimated_bytes(tgt) >= FILTERED_BYTES and filterable(tgt, src, names, profile.keys):
        return possibly_held(tgt, src, names, profile.keys)
    return tgt
