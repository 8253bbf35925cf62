"""Publishing a load into a table of files: what a feed does not touch is neither read whole nor written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave import columns as C
from dimweave.functions.hashing import quoted
from dimweave.operators import checks
from dimweave.operators.apply import (
    GONE,
    ended_versions,
    feed_rows,
    inserted_versions,
    mark_by_sid,
    mark_expired,
    sid_hits,
)
from dimweave.operators.checks import measured_bytes
from dimweave.operators.joins import Keys, key_list
from dimweave.operators.roles import has, project, spelled
from dimweave.sources.files import remove, scratch_dir, stage
from dimweave.sources.rewrite import (
    FILE,
    append,
    drop_partitions,
    drop_rows,
    is_one_of,
    overwrite_partitions,
    partition_columns,
    recover,
)
from dimweave.spec import LoadSpec

Mark = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Touched:
    """Partitions by what a publish did to them, as lists of values; files it replaced of unpartitioned tables."""

    rewritten: tuple[tuple[Any, ...], ...] = ()
    appended: tuple[tuple[Any, ...], ...] = ()
    emptied: tuple[tuple[Any, ...], ...] = ()
    files: tuple[str, ...] = ()


def _values(rows: Sequence[Any], parts: Sequence[str]) -> tuple[tuple[Any, ...], ...]:
    return tuple(tuple(r[p] for p in parts) for r in rows)


def replace_rows(spark: SparkSession, table: str, keys: Sequence[str], mark: Mark, arrivals: DataFrame) -> Touched:
    """Take the rows that ``mark`` flags out of a table of files and put ``arrivals`` in.

    ``mark`` adds the flag to target rows, whole or reduced to ``keys`` and the partition columns; it may
    raise. ``arrivals`` must not read the table: they are read again after it has changed.

    A first pass over keys and partition columns counts each partition's rows and flagged rows. Partitions
    that lose rows are overwritten with what stays and arrives there; arrivals in other partitions are
    appended, so a history that only grows is never rewritten; a partition left without rows is dropped. In
    a table without partitions the files that hold flagged rows take the partitions' place.

    Arrivals are appended first. A load cut short in between leaves rows under a key that others still hold:
    running it again finds and replaces both, so nothing is lost. Without partitions both happen in one swap.
    """
    target, parts = spark.table(table), partition_columns(spark, table)
    narrow = target.select(*map(quoted, dict.fromkeys([*keys, *parts])))
    if not parts:
        return Touched(files=tuple(drop_rows(spark, table, *_flagged(mark, keys), arrivals)))
    counted = mark(narrow).groupBy(*map(quoted, parts)).agg(
        F.count(F.lit(1)).alias("#rows"), F.count_if(quoted(GONE)).alias("#lost")
    )
    losing = counted.where(quoted("#lost") > 0).collect()
    reached = _values(arrivals.select(*map(quoted, parts)).distinct().collect(), parts)
    rewritten = _values(losing, parts)
    emptied = _values([r for r in losing if r["#rows"] == r["#lost"]], parts)
    emptied = tuple(p for p in emptied if p not in set(reached))
    appended = tuple(p for p in reached if p not in set(rewritten))
    if appended:
        append(arrivals.where(~is_one_of(parts, rewritten)) if rewritten else arrivals, table)
    if rewritten:
        inside = is_one_of(parts, rewritten)
        staying = project(mark(target.where(inside)).where(~quoted(GONE)), target.columns)
        overwrite_partitions(staying.unionByName(arrivals.where(inside)), table)
    drop_partitions(spark, table, parts, emptied)
    return Touched(tuple(p for p in rewritten if p not in set(emptied)), appended, emptied)


def _flagged(mark: Mark, keys: Sequence[str]) -> tuple[Mark, Mark]:
    """Filters of the flagged rows, which need their keys only, and of the others."""
    def gone(target: DataFrame) -> DataFrame:
        return mark(target.select(*map(quoted, [*keys, FILE]))).where(quoted(GONE))

    def kept(target: DataFrame) -> DataFrame:
        return mark(target).where(~quoted(GONE)).drop(GONE)

    return gone, kept


def publish_dimension(
    spark: SparkSession, table: str, feed: DataFrame, spec: LoadSpec, epoch: int | None = None, **options: Any
) -> Touched:
    """Apply a staged Type 1 or Type 2 feed to a table of files; ``options`` are those of ``feed_rows``.

    The first pass is the apply's check as well: repeated keys, and inserted ones that the table holds, raise
    before anything is written. Keys of a feed that weigh little are broadcast, so the target isn't shuffled.
    """
    target = spark.table(table)
    sid = spelled(target.columns, spec.sid_key)
    hits = sid_hits(target, feed, spec)
    if measured_bytes(feed.select(quoted(sid))) <= checks.BROADCAST_BYTES:
        hits = F.broadcast(hits)
    rows = feed_rows(target, feed, epoch, **options)
    return replace_rows(spark, table, [sid], lambda df: mark_by_sid(df, hits, sid), rows)


def publish_hash_history(spark: SparkSession, table: str, feed: DataFrame, keys: Keys) -> Touched:
    """Apply a staged hash feed to a table of files: expired versions leave, ended and new ones arrive."""
    target, names = spark.table(table), key_list(keys)
    ended = ended_versions(target, feed, keys, every=False)
    folder = scratch_dir(spark)
    arrivals = stage(ended.unionByName(inserted_versions(target, feed)), folder, "arrivals", "rows")
    columns = [*names, spelled(target.columns, C.IS_CURRENT)]
    try:
        return replace_rows(spark, table, columns, lambda df: mark_expired(df, feed, keys), arrivals)
    finally:
        remove(spark, folder)


def publish_fact(
    spark: SparkSession, table: str, rows: DataFrame, epoch: int, predicate: str | Column | None = None
) -> Touched:
    """Add a batch's rows to a fact table, instead of those of an earlier run of the batch.

    A batch is known by its epoch, and by the slice it loads if there is one. A table partitioned by epoch has
    that batch's partitions overwritten. Else the table is asked for rows of the epoch, which file statistics
    answer without reading data for a new batch; if there are some, the files with those of the slice are
    rewritten without them and the rows appended. Then the slice's predicate must name columns of the table.
    """
    target, parts = spark.table(table), partition_columns(spark, table)
    if not has(target.columns, C.BATCH_EPOCH):
        append(rows, table)
        return Touched()
    name = spelled(target.columns, C.BATCH_EPOCH)
    same = quoted(name) == F.lit(epoch)
    if has(parts, C.BATCH_EPOCH) and predicate is None:
        held = _values(target.where(same).select(*map(quoted, parts)).distinct().collect(), parts)
        if not held:
            append(rows, table)
            return Touched()
        reached = _values(rows.select(*map(quoted, parts)).distinct().collect(), parts)
        if reached:
            overwrite_partitions(rows, table)
        emptied = tuple(p for p in held if p not in set(reached))
        drop_partitions(spark, table, parts, emptied)
        return Touched(rewritten=reached, emptied=emptied)
    recover(spark, table)
    known = F.coalesce(same, F.lit(False))
    if target.where(known).isEmpty():
        append(rows, table)
        return Touched()
    if predicate is not None:
        try:
            target.where(predicate)
        except AnalysisException as error:
            raise ValueError(f"{table} cannot tell the rows of the slice {predicate!r}: {error}") from error
        inside = F.expr(predicate) if isinstance(predicate, str) else predicate
        known = known & F.coalesce(inside, F.lit(False))
    filters = (lambda df: df.where(known)), (lambda df: df.where(~known))
    files = drop_rows(spark, table, *filters, None if parts else rows)
    if parts:
        append(rows, table)
    return Touched(files=tuple(files))

