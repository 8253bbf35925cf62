"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.functions.hashing import quoted

BUCKETS = 65536
# A key with fewer rows is no burden for one task, however large the table is.
HOT_ROWS = 1_000_000
# Keys listed as hot, the hottest first: what the driver holds and a filter compares with.
HOT_KEYS = 65536
# A table that Spark estimates below this has no key that would burden a task.
SMALL_BYTES = 32 * 1024 * 1024


BINARY_COLLATION = "UTF8_BINARY"
PLAIN_TYPES = (
    T.IntegralType,
    T.DecimalType,
    T.BooleanType,
    T.BinaryType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def hashes_as_it_compares(kind: T.DataType) -> bool:
    """Whether equal values of a type always share a hash: not so under a looser collation."""
    if isinstance(kind, T.StringType):
        return kind.collation == BINARY_COLLATION
    return isinstance(kind, PLAIN_TYPES)


def key_bucket(keys: Sequence[str]) -> Column:
    """Hash bucket of a key; all rows of a key share one."""
    return F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(BUCKETS)).cast("int")


def key_hash(keys: Sequence[str]) -> Column:
    """Hash by which hot keys are listed."""
    return F.xxhash64(*map(quoted, keys))


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's size, which takes no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with more than ``hot_rows`` rows, a limit that does not rise with the table.

    A count per bucket finds the buckets that could hold one; keys are counted in those only. Counts
    are aggregated before the shuffle, ``BUCKETS`` pairs and ``HOT_KEYS`` hashes at most reach the
    driver. Nothing is counted in a table of less than ``SMALL_BYTES``. Keys of types whose equal
    values may hash differently (floating point, loose collations) can't be split: a warning says so.
    """
    kinds = df.select(*map(quoted, keys)).schema
    if not all(hashes_as_it_compares(f.dataType) for f in kinds):
        warnings.warn(f"hot keys of {kinds.simpleString()} are not split", stacklevel=2)
        return []
    if hot_rows >= HOT_ROWS and estimated_bytes(df) < SMALL_BYTES:
        return []
    counts = df.groupBy(key_bucket(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    heavy = [row.bucket for row in counts.where(F.col("n") > hot_rows).collect()]
    if not heavy:
        return []
    inside = df.where(key_bucket(keys).isin(*heavy)).groupBy(key_hash(keys).alias("key"))
    found = inside.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    return sorted(row.key for row in found.orderBy(F.desc("n"), "key").limit(HOT_KEYS).collect())
