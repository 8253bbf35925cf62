"""The newest epoch of every key, kept from batch to batch.

A cleanup of the whole table counts every key anew. With an index it looks at a batch's keys only: the table
has been cleaned before, so what it holds of other keys is of one epoch each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.columns import BATCH_EPOCH
from dimweave.functions.hashing import quoted
from dimweave.operators.cleanup import NEWEST, OLDEST, latest_epoch
from dimweave.operators.joins import SOURCE, TARGET, pair, prefixed, s, t
from dimweave.operators.roles import without


def epoch_index(df: DataFrame, primary_key: Sequence[str], epoch_col: str = BATCH_EPOCH) -> DataFrame:
    """The index of a whole table: (key, newest_epoch); rows with a NULL in key or epoch are none of it."""
    key = without(primary_key, [epoch_col])
    return latest_epoch(df.dropna(subset=[*key, epoch_col]), primary_key, epoch_col).withColumnRenamed(epoch_col, NEWEST)


def batch_epochs(
    batch: DataFrame, index: DataFrame, primary_key: Sequence[str], epoch_col: str = BATCH_EPOCH
) -> DataFrame:
    """(key, newest_epoch, superseded, known) of a batch's keys.

    ``superseded`` says whether the table, with the batch in it, holds an older row of the key, be it the
    batch's own or one from before; ``known`` whether the index has this epoch already. The batch is reduced
    to a row per key before it meets the index.
    """
    key = without(primary_key, [epoch_col])
    span = batch.dropna(subset=[*key, epoch_col]).groupBy(*map(quoted, key))
    spans = span.agg(F.min(quoted(epoch_col)).alias(OLDEST), F.max(quoted(epoch_col)).alias(NEWEST))
    left = prefixed(spans, SOURCE, [*key, OLDEST, NEWEST])
    joined = pair(left, prefixed(index, TARGET, [*key, NEWEST]), key, "left")
    newest = F.greatest(s(NEWEST), t(NEWEST))
    older = F.least(s(OLDEST), t(NEWEST)) < newest
    return joined.select(
        *[s(c).alias(c) for c in key],
        newest.alias(NEWEST),
        older.alias("superseded"),
        F.coalesce(t(NEWEST) == newest, F.lit(False)).alias("known"),
    )
