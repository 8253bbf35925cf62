"""Batch cleanup: the newest load of every primary key stays, older ones are superseded.

``keep_latest_batch`` and ``stale_rows`` compare each row with its key's newest epoch in a window:
one shuffle, no join. A window keeps a key in one task, so hot keys take another way: their newest
epochs are aggregated before the shuffle and met by key and epoch in a semi or anti join, which
adaptive execution can split. Both ways give the same rows.

Most tables hold few keys with more than one load. ``superseded_keys`` names these, and once that
list is written its size is known: a short one is broadcast and the table is scanned without any
shuffle (``plans.load.run_cleanup``).

A row with a NULL in its key or epoch matches nothing: it is never kept and always stale.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.columns import BATCH_EPOCH
from dimweave.functions.hashing import quoted, sql_name
from dimweave.operators.joins import TARGET, t
from dimweave.operators.roles import without
from dimweave.operators.skew import hot_keys, key_hash

OLDEST = "oldest_epoch"
NEWEST = "newest_epoch"
# A name no table column has.
OF_KEY = "#newest"


def _key(primary_key: Sequence[str], epoch_col: str) -> list[str]:
    key = without(primary_key, [epoch_col])
    if not key:
        raise ValueError("the primary key needs a column besides the epoch")
    return key


def _unmatched(key: Sequence[str], epoch_col: str) -> Column:
    return reduce(lambda a, b: a | b, [quoted(c).isNull() for c in [*key, epoch_col]])


def latest_epoch(
    df: DataFrame, primary_key: Sequence[str], epoch_col: str = BATCH_EPOCH
) -> DataFrame:
    """Newest epoch of every key."""
    key = _key(primary_key, epoch_col)
    return df.groupBy(*map(quoted, key)).agg(F.max(quoted(epoch_col)).alias(epoch_col))


def _compare(
    df: DataFrame, key: list[str], epoch_col: str, kept: bool, hot: Sequence[int] | None
) -> DataFrame:
    """Rows that are of their key's newest epoch, or the others, those with a NULL among them.

    Rows with a NULL pass the same window, spread by a hash of the row as groups of their own.
    """
    unmatched = _unmatched(key, epoch_col)
    if hot is None:
        hot = hot_keys(df.where(~unmatched), key)
    of_hot = key_hash(key).isin(*hot) & ~unmatched if hot else F.lit(False)
    cold_rows = df.where(~of_hot) if hot else df
    if kept:
        cold_rows = cold_rows.where(~unmatched)
        spread = Window.partitionBy(*map(quoted, key))
        wanted = quoted(epoch_col) == quoted(OF_KEY)
    else:
        row = F.when(unmatched, F.xxhash64(*map(quoted, df.columns)))
        spread = Window.partitionBy(*map(quoted, key), row)
        wanted = unmatched | (quoted(epoch_col) < quoted(OF_KEY))
    newest = F.max(quoted(epoch_col)).over(spread)
    compared = cold_rows.withColumn(OF_KEY, newest).where(wanted).drop(OF_KEY)
    if not hot:
        return compared
    hot_rows = df.where(of_hot)
    how = "left_semi" if kept else "left_anti"
    matched = hot_rows.join(latest_epoch(hot_rows, key, epoch_col), [*key, epoch_col], how)
    return compared.unionByName(matched)


def keep_latest_batch(
    df: DataFrame,
    primary_key: Sequence[str],
    epoch_col: str = BATCH_EPOCH,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of their key's newest epoch, ties included.

    ``hot`` lists the hashes of hot keys; without it they are counted first (``skew.hot_keys``).
    """
    return _compare(df, _key(primary_key, epoch_col), epoch_col, True, hot)


def stale_rows(
    df: DataFrame,
    primary_key: Sequence[str],
    epoch_col: str = BATCH_EPOCH,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """The rows ``keep_latest_batch`` leaves out, those with a NULL in key or epoch among them."""
    return _compare(df, _key(primary_key, epoch_col), epoch_col, False, hot)


def superseded_keys(
    df: DataFrame, primary_key: Sequence[str], epoch_col: str = BATCH_EPOCH
) -> DataFrame:
    """Newest epoch of the keys that have an older one too."""
    key = _key(primary_key, epoch_col)
    span = df.dropna(subset=[*key, epoch_col]).groupBy(*map(quoted, key))
    spans = span.agg(F.min(quoted(epoch_col)).alias(OLDEST), F.max(quoted(epoch_col)).alias(NEWEST))
    return spans.where(F.col(OLDEST) < F.col(NEWEST)).drop(OLDEST)


def split_by_superseded(
    df: DataFrame,
    superseded: DataFrame,
    primary_key: Sequence[str],
    epoch_col: str = BATCH_EPOCH,
) -> tuple[DataFrame, DataFrame]:
    """Kept and stale rows, given the result of ``superseded_keys``."""
    key = _key(primary_key, epoch_col)
    renamed = superseded.select(
        *[quoted(c).alias(TARGET + c) for c in key], F.col(NEWEST).alias(TARGET + NEWEST)
    )
    older = quoted(epoch_col) < t(NEWEST)
    for c in key:
        older = older & (quoted(c) == t(c))
    unmatched = _unmatched(key, epoch_col)
    comparable = df.where(~unmatched)
    kept = comparable.join(renamed, older, "left_anti")
    stale = comparable.join(renamed, older, "left_semi").unionByName(df.where(unmatched))
    return kept, stale


def delete_superseded_statement(
    table: str, superseded: str, primary_key: Sequence[str], epoch_col: str = BATCH_EPOCH
) -> str:
    """Removal of older loads as one MERGE of a view with the result of ``superseded_keys``."""
    key = _key(primary_key, epoch_col)
    same = " AND ".join(f"tgt.{sql_name(c)} = src.{sql_name(c)}" for c in key)
    older = f"tgt.{sql_name(epoch_col)} < src.{sql_name(NEWEST)}"
    return f"MERGE INTO {table} AS tgt USING {superseded} AS src ON {same} AND {older} WHEN MATCHED THEN DELETE"


def delete_unmatched_statement(
    table: str, primary_key: Sequence[str], epoch_col: str = BATCH_EPOCH
) -> str:
    """Removal of the rows with a NULL in key or epoch."""
    nulls = " OR ".join(f"{sql_name(c)} IS NULL" for c in [*_key(primary_key, epoch_col), epoch_col])
    return f"DELETE FROM {table} WHERE {nulls}"
