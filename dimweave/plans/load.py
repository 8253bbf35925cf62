"""Loads: a spec picks the feed, the feed is staged, conformed and applied."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimweave.columns import ACTION, BATCH_EPOCH
from dimweave.functions.clock import DEFAULT_ZONE, LoadTime
from dimweave.functions.hashing import SHA256, quoted, sql_name, surrogate_key
from dimweave.operators import checks
from dimweave.operators.apply import (
    GONE,
    apply_fact,
    apply_scd2_hash,
    apply_type1,
    apply_type2,
    delete_batch_statement,
    fact_rows,
    feed_rows,
    merge_scd2_hash,
    merge_type1,
)
from dimweave.operators.checks import held_by, measured_bytes, require_unique
from dimweave.operators.cleanup import (
    NEWEST,
    delete_superseded_statement,
    delete_unmatched_statement,
    keep_latest_batch,
    split_by_superseded,
    stale_rows,
    superseded_keys,
)
from dimweave.operators.conform import RAISE, REASON, REJECT, misfits
from dimweave.operators.epoch_index import batch_epochs, epoch_index
from dimweave.operators.feeds import (
    fact_insert_feed,
    type1_upsert_feed,
    type2_hybrid_feed,
    upsert_all_matched_feed,
)
from dimweave.operators.hash_scd2 import scd2_hash_changed, scd2_hash_feed
from dimweave.operators.joins import Keys, slice_both, slice_of_source
from dimweave.operators.keys import Generator, with_free_keys, with_surrogate_key
from dimweave.operators.roles import has, spelled, without
from dimweave.operators.skew import hot_keys
from dimweave.plans.publish import (
    Touched,
    publish_dimension,
    publish_fact,
    publish_hash_history,
    replace_rows,
)
from dimweave.sources.files import (
    remove,
    scratch_dir,
    stage,
    staged_path,
    staging_dir,
    write_bucketed_table,
    write_result,
    write_scd_table,
)
from dimweave.sources.rewrite import (
    FILE,
    append,
    bucketing,
    details,
    drop_rows,
    gathered,
    partition_columns,
    recover,
)
from dimweave.spec import FACT, TYPE1, TYPE2, LoadSpec


@dataclass(frozen=True)
class Staged:
    """Folders a load has written, which its results read until ``release`` removes them."""

    staged: tuple[str, ...] = field(default=(), kw_only=True)

    def release(self, spark: SparkSession) -> None:
        for path in self.staged:
            remove(spark, path)


@dataclass(frozen=True)
class LoadResult(Staged):
    feed: DataFrame
    snapshot: DataFrame
    rejected: DataFrame | None = None
    """Feed rows that the target can't hold, with ``on_overflow='reject'``."""


@dataclass(frozen=True)
class CleanupResult(Staged):
    kept: DataFrame
    stale: DataFrame


def _batch(batch_id: str | int | None) -> str | int:
    return uuid.uuid4().hex if batch_id is None else batch_id


def _stage_name(target: str | None, kind: str) -> str:
    """A target's own name; without one a name that no other load has."""
    return target or f"{kind}_{uuid.uuid4().hex}"


def build_feed(
    spec: LoadSpec,
    src: DataFrame,
    tgt: DataFrame,
    load_ts: LoadTime,
    epoch: int | None = None,
    predicate: str | Column | None = None,
    zone: str = DEFAULT_ZONE,
    reopen: bool = False,
    hot: Sequence[int] | None = None,
    every_match: bool = False,
) -> DataFrame:
    """The change feed the spec asks for.

    ``reopen`` and ``hot`` are those of the Type 2 feed; ``every_match`` updates all known rows of a
    Type 1 target, changed or not.
    """
    kind = spec.kind
    if kind == TYPE2:
        return type2_hybrid_feed(
            src, tgt, spec, load_ts, zone, predicate, reopen=reopen, hot=hot
        )
    if kind == TYPE1 and every_match:
        return upsert_all_matched_feed(*slice_both(src, tgt, predicate), spec, load_ts)
    if kind == TYPE1:
        return type1_upsert_feed(src, tgt, spec, load_ts, predicate)
    if epoch is None:
        raise ValueError("a fact load needs an epoch")
    return fact_insert_feed(src, tgt.columns, load_ts, epoch, predicate)


def publish(
    feed: DataFrame,
    target: DataFrame,
    spec: LoadSpec,
    epoch: int | None = None,
    schema: StructType | None = None,
    on_overflow: str = RAISE,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Conform a feed to the target and return the target's next snapshot."""
    kind = spec.kind
    if kind == FACT:
        return apply_fact(target, feed, epoch, schema, on_overflow, zone)
    apply = apply_type1 if kind == TYPE1 else apply_type2
    return apply(target, feed, spec, epoch, schema, on_overflow, zone)


def _directory(df: DataFrame, staged: bool, stage_dir: str | None) -> str | None:
    return (stage_dir or staging_dir(df.sparkSession)) if staged else None


def run_load(
    spec: LoadSpec,
    src: DataFrame,
    tgt: DataFrame,
    load_ts: LoadTime,
    epoch: int | None = None,
    predicate: str | Column | None = None,
    zone: str = DEFAULT_ZONE,
    schema: StructType | None = None,
    on_overflow: str = RAISE,
    check_keys: bool = True,
    staged: bool = True,
    stage_dir: str | None = None,
    batch_id: str | int | None = None,
    reopen: bool = False,
    hot: Sequence[int] | None = None,
    every_match: bool = False,
    sid_from: Sequence[str] = (),
    key_generator: Generator = surrogate_key,
    slice_on: Keys = (),
) -> LoadResult:
    """Feed and next snapshot of one load.

    ``check_keys`` refuses a dimension source that repeats a key (it would fan out). The same
    aggregate measures the source's keys; few of them are broadcast to thin the target out before
    the feed is built. A feed that repeats a surrogate key or inserts one that the target holds makes
    the snapshot raise, staged or not (``operators.apply``).

    ``sid_from`` names source columns of which the surrogate key is made; for a Type 2 target they
    are the business key and something that differs from load to load. Such keys are looked for until
    they are free (``operators.keys.with_free_keys``); keys that come with the source are not changed.

    ``slice_on`` names partition columns of the target: only the partitions that the source has rows in
    are read for the feed. With ``on_overflow='reject'`` feed rows that the target's types can't hold are
    left out and returned as ``rejected``, each with the columns that it fails.

    The feed is staged under ``stage_dir`` or, without one, the folder in ``spark.checkpoint.dir``;
    with neither, or with ``staged=False``, it stays a lazy plan that the apply evaluates again.
    ``LoadResult.release`` removes what was staged.
    """
    kind = spec.kind
    if sid_from:
        src = with_surrogate_key(src, sid_from, spec.sid_key, key_generator)
    options = {"zone": zone, "reopen": reopen, "hot": hot, "every_match": every_match}
    rejecting, on_overflow = on_overflow == REJECT, RAISE if on_overflow == REJECT else on_overflow
    if kind == FACT:
        feed, rejected, paths = build_feed(spec, src, tgt, load_ts, epoch, predicate), None, ()
        if rejecting:
            feed, rejected, paths = _without_rejected(
                feed, schema or tgt.schema, _directory(src, staged, stage_dir), spec.target_table, batch_id
            )
        snapshot = publish(feed, tgt, spec, epoch, schema, on_overflow, zone)
        return LoadResult(feed, snapshot, rejected, staged=paths)
    directory = _directory(src, staged, stage_dir)
    join_key = spec.dim_key if kind == TYPE2 else spec.sid_key
    concerned = slice_of_source(src, tgt, slice_on) if slice_on else tgt
    if check_keys:
        checked = src if predicate is None else src.where(predicate)
        profile = require_unique(checked, join_key, "source")
        concerned = held_by(concerned, checked, join_key, profile)
    feed = build_feed(spec, src, concerned, load_ts, epoch, predicate, **options)
    paths = ()
    if directory:
        name, batch = _stage_name(spec.target_table, kind), _batch(batch_id)
        feed = stage(feed, directory, name, batch)
        paths = (staged_path(directory, name, batch),)
    if sid_from and kind == TYPE2:

        def keep(df: DataFrame, number: int) -> DataFrame:
            nonlocal paths
            if not directory:
                return df
            paths += (staged_path(directory, f"{name}_keys{number}", batch),)
            return stage(df, directory, f"{name}_keys{number}", batch)

        sid, dim = (spelled(tgt.columns, k) for k in (spec.sid_key, spec.dim_key))
        feed = with_free_keys(feed, tgt, sid, dim, keep, key_generator)
    rejected = None
    if rejecting:
        feed, rejected, more = _without_rejected(
            feed, schema or tgt.schema, directory, spec.target_table, batch_id
        )
        paths += more
    snapshot = publish(feed, tgt, spec, epoch, schema, on_overflow, zone)
    return LoadResult(feed, snapshot, rejected, staged=paths)


def _without_rejected(
    feed: DataFrame, schema: StructType, directory: str | None, target: str | None, batch_id: str | int | None
) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    """A feed's rows that the target can hold, the others with their reason, and what was staged for it."""
    held = StructType([f for f in schema.fields if has(feed.columns, f.name)])
    told, paths = feed.withColumn(REASON, misfits(feed, held)), ()
    if directory:
        name, batch = f"{_stage_name(target, 'feed')}_judged", _batch(batch_id)
        told, paths = stage(told, directory, name, batch), (staged_path(directory, name, batch),)
    fitting = told.where(quoted(REASON).isNull()).drop(REASON)
    return fitting, told.where(quoted(REASON).isNotNull()), paths


# Providers whose tables take MERGE.
ROW_LEVEL = ("delta", "iceberg", "hudi")


def takes_merge(spark: SparkSession, table: str) -> bool:
    return details(spark, table).get("provider", "").lower() in ROW_LEVEL


def switch_table(spark: SparkSession, snapshot: DataFrame, table: str) -> str:
    """Make a table of files consist of ``snapshot``, which may read the table; returns its old location.

    The rows are written beside the present ones, then the table's location changes: readers see the
    old or the new rows, a failed write leaves the table as it was, and the old files stay until the
    caller removes them. Of a partitioned table the catalog's partitions are registered anew after
    that, which is no single step.
    """
    known = details(spark, table)
    old = known["location"].rstrip("/")
    new = f"{old.rsplit('#', 1)[0]}#{uuid.uuid4().hex}"
    parts = partition_columns(spark, table)
    columns = spark.table(table).columns
    buckets = bucketing(spark, table)
    writer = gathered(snapshot.select(*map(quoted, columns)), parts if buckets else [], buckets).write
    writer = writer.format(known.get("provider", "parquet"))
    writer = writer.partitionBy(*parts) if parts else writer
    if buckets:  # only tables are written in buckets: one that lives until the files are there
        draft = f"draft_{uuid.uuid4().hex}"
        writer = writer.bucketBy(buckets.n, *buckets.columns).option("path", new)
        (writer.sortBy(*buckets.sorted_by) if buckets.sorted_by else writer).saveAsTable(draft)
        spark.sql(f"DROP TABLE {draft}")
    else:
        writer.save(new)
    if not parts:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    else:
        registered = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        for spec in registered:
            values = ", ".join(f"`{k}`='{v}'" for k, v in (p.split("=", 1) for p in spec.split("/")))
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return old


def _staged(spark: SparkSession, options: dict[str, Any]) -> dict[str, Any]:
    """Options of a load that changes its own target: its feed must be on disk before."""
    if not options.get("staged", True):
        raise ValueError("a load into its table stages the feed")
    return {**options, "stage_dir": options.get("stage_dir") or staging_dir(spark) or scratch_dir(spark)}


def _load_fact(
    spark: SparkSession, table: str, rows: DataFrame, epoch: int, predicate: str | Column | None, in_place: bool
) -> Touched | None:
    if not in_place:
        return publish_fact(spark, table, rows, epoch, predicate)
    if has(rows.columns, BATCH_EPOCH):
        spark.sql(delete_batch_statement(table, BATCH_EPOCH, epoch, predicate))
    append(rows, table)
    return None


def load_table(
    spark: SparkSession,
    spec: LoadSpec,
    load_ts: LoadTime,
    epoch: int | None = None,
    snapshot_path: str | None = None,
    reject_path: str | None = None,
    **options: Any,
) -> Touched | None:
    """Load the spec's source table into its target table.

    A table whose format takes MERGE gets one. In a table of plain files only the partitions, or files, that
    hold rows of the feed are rewritten, and what arrives elsewhere is appended; the result says which
    (``plans.publish``). A fact batch that runs again replaces the rows of its earlier run. With
    ``snapshot_path`` the next snapshot goes there and the table stays; Type 2 snapshots then get the
    history layout. Rows that the target can't hold are added to ``reject_path``, if there is one, before
    the others are published. ``options`` are those of ``run_load``.
    """
    kind, table = spec.kind, spec.target_table
    in_place = takes_merge(spark, table)
    if not in_place:
        recover(spark, table)
    src, tgt = spark.table(spec.source_table), spark.table(table)
    options = {"schema": tgt.schema, **options}
    if reject_path:
        options["on_overflow"] = REJECT
    if kind == FACT and not reject_path:
        predicate = options.get("predicate")
        feed = build_feed(spec, src, tgt, load_ts, epoch, predicate)
        rows = fact_rows(feed, options["schema"], epoch, options.get("on_overflow", RAISE))
        return _load_fact(spark, table, rows, epoch, predicate, in_place)
    if not snapshot_path:
        options = _staged(spark, options)
    result = run_load(spec, src, tgt, load_ts, epoch, **options)
    casts = {k: options[k] for k in ("schema", "on_overflow", "zone") if k in options}
    if reject_path:
        casts["on_overflow"] = RAISE
        write_result(result.rejected, reject_path, mode="append")
    try:
        if kind == FACT:
            rows = fact_rows(result.feed, options["schema"], epoch)
            return _load_fact(spark, table, rows, epoch, options.get("predicate"), in_place)
        if not snapshot_path and in_place:
            tagged = StructType([*casts["schema"].fields, *[f for f in result.feed.schema if f.name == ACTION]])
            merge_type1(feed_rows(tgt, result.feed, epoch, **{**casts, "schema": tagged}), table, spec)
            return None
        if not snapshot_path:
            return publish_dimension(spark, table, result.feed, spec, epoch, **casts)
        if kind == TYPE2:
            write_scd_table(result.snapshot, snapshot_path, spec.dim_key)
        else:
            write_result(result.snapshot, snapshot_path, mode="errorifexists")
        return None
    finally:
        result.release(spark)


def load_history_table(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Keys,
    attributes: Sequence[str],
    load_ts: LoadTime,
    **options: Any,
) -> Touched | None:
    """``run_scd2_hash`` into a table, merged or published as ``load_table`` does it."""
    options, in_place = _staged(spark, options), takes_merge(spark, table)
    if not in_place:
        recover(spark, table)
    result = run_scd2_hash(
        source, spark.table(table), keys, attributes, load_ts, target_name=table, **options
    )
    try:
        if in_place:
            merge_scd2_hash(result.feed, table, keys, attributes)
            return None
        return publish_hash_history(spark, table, result.feed, keys)
    finally:
        result.release(spark)


def _by_superseded(
    superseded: DataFrame, key: Sequence[str], epoch_col: str
) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """Filters of a table's stale rows, which need key and epoch only, and of the others; few keys are broadcast."""
    if measured_bytes(superseded) <= checks.BROADCAST_BYTES:
        superseded = F.broadcast(superseded)

    def gone(target: DataFrame) -> DataFrame:
        narrow = target.select(*map(quoted, dict.fromkeys([*key, epoch_col, FILE])))
        return split_by_superseded(narrow, superseded, key, epoch_col)[1]

    def kept(target: DataFrame) -> DataFrame:
        return split_by_superseded(target, superseded, key, epoch_col)[0]

    return gone, kept


def cleanup_table(
    spark: SparkSession,
    spec: LoadSpec,
    epoch_col: str = BATCH_EPOCH,
    stage_dir: str | None = None,
    batch_id: str | int | None = None,
) -> list[str]:
    """Reduce the spec's target table to the newest load of each primary key; returns the files replaced.

    Keys loaded more than once are staged and weighed first. A table whose format has row-level operations
    deletes the older rows in place; in a table of plain files those files are rewritten that hold stale
    rows, the others stay as they are.
    """
    if not spec.primary_key:
        raise ValueError("a cleanup needs the spec's primary key")
    table, key = spec.target_table, spec.primary_key
    directory = stage_dir or staging_dir(spark) or scratch_dir(spark)
    name, batch = f"{_stage_name(table, 'table')}_superseded", _batch(batch_id)
    recover(spark, table)
    superseded = stage(superseded_keys(spark.table(table), key, epoch_col), directory, name, batch)
    try:
        if takes_merge(spark, table):
            view = f"superseded_{uuid.uuid4().hex}"
            superseded.createOrReplaceTempView(view)
            spark.sql(delete_superseded_statement(table, view, key, epoch_col))
            spark.sql(delete_unmatched_statement(table, key, epoch_col))
            spark.catalog.dropTempView(view)
            return []
        return drop_rows(spark, table, *_by_superseded(superseded, key, epoch_col))
    finally:
        remove(spark, staged_path(directory, name, batch))


def build_epoch_index(
    spark: SparkSession, spec: LoadSpec, index_table: str, buckets: int, epoch_col: str = BATCH_EPOCH, **options: str
) -> None:
    """Write the newest epoch of each key of a cleaned target table, in buckets by key.

    With as many buckets as shuffle partitions, or more, only a batch's side of the join is shuffled.
    """
    index = epoch_index(spark.table(spec.target_table), spec.primary_key, epoch_col)
    write_bucketed_table(index, index_table, without(spec.primary_key, [epoch_col]), buckets, **options)


def cleanup_batch(
    spark: SparkSession,
    spec: LoadSpec,
    batch: DataFrame,
    index_table: str,
    epoch_col: str = BATCH_EPOCH,
    stage_dir: str | None = None,
) -> list[str]:
    """``cleanup_table`` after a batch was added to a cleaned table, by the batch and the index alone.

    What is superseded follows from the batch's keys and their epochs in the index; the table is read to
    find the files with rows of these keys, and only if there are some. Then the index learns the batch's
    epochs; a run cut short before that finds the same rows again. Tables of files only.
    """
    table, key = spec.target_table, without(spec.primary_key, [epoch_col])
    directory = stage_dir or staging_dir(spark) or scratch_dir(spark)
    for changed in (table, index_table):
        recover(spark, changed)
    name = _stage_name(table, "table")
    found = batch_epochs(batch, spark.table(index_table), spec.primary_key, epoch_col)
    found = stage(found, directory, f"{name}_batch", "epochs")
    try:
        nulls = batch.where(" OR ".join(f"{sql_name(c)} IS NULL" for c in [*key, epoch_col]))
        superseded = found.where("superseded").select(*map(quoted, key), NEWEST)
        files = []
        if not (superseded.isEmpty() and nulls.isEmpty()):
            files = drop_rows(spark, table, *_by_superseded(superseded, spec.primary_key, epoch_col))
        learned = found.where("NOT known").select(*map(quoted, key), NEWEST)
        if not learned.isEmpty():
            keys = learned.select(*[quoted(c).alias(f"#{c}") for c in key])
            if measured_bytes(keys) <= checks.BROADCAST_BYTES:
                keys = F.broadcast(keys)

            def mark(rows: DataFrame) -> DataFrame:
                same = [quoted(c) == quoted(f"#{c}") for c in key]
                joined = rows.join(keys, reduce(lambda a, b: a & b, same), "left")
                return joined.select(*map(quoted, rows.columns), quoted(f"#{key[0]}").isNotNull().alias(GONE))

            replace_rows(spark, index_table, key, mark, learned)
        return files
    finally:
        remove(spark, staged_path(directory, f"{name}_batch", "epochs"))


def run_scd2_hash(
    src: DataFrame,
    tgt: DataFrame,
    keys: Keys,
    attributes: Sequence[str],
    load_ts: LoadTime,
    algorithm: str = SHA256,
    check_keys: bool = True,
    staged: bool = True,
    stage_dir: str | None = None,
    batch_id: str | int | None = None,
    target_name: str | None = None,
) -> LoadResult:
    """Hash-based history load: changed rows, expire/insert feed, next snapshot.

    ``target_name`` names the staged folders; without it they get names of their own.
    """
    concerned = tgt
    if check_keys:
        concerned = held_by(tgt, src, keys, require_unique(src, keys, "source"))
    directory = _directory(src, staged, stage_dir)
    batch, name, paths = _batch(batch_id), _stage_name(target_name, "history"), []
    changed = scd2_hash_changed(src, concerned, keys, attributes, load_ts, algorithm)
    if directory:
        changed = stage(changed, directory, f"{name}_changed", batch)
        paths.append(staged_path(directory, f"{name}_changed", batch))
    feed = scd2_hash_feed(changed, concerned, keys, attributes, load_ts)
    if directory:
        feed = stage(feed, directory, f"{name}_feed", batch)
        paths.append(staged_path(directory, f"{name}_feed", batch))
    return LoadResult(feed, apply_scd2_hash(tgt, feed, keys), staged=tuple(paths))


def run_cleanup(
    df: DataFrame,
    primary_key: Sequence[str],
    epoch_col: str = BATCH_EPOCH,
    staged: bool = True,
    stage_dir: str | None = None,
    batch_id: str | int | None = None,
    target_name: str | None = None,
) -> CleanupResult:
    """Split a table into each key's newest load and the loads it supersedes.

    With a staging folder the keys loaded more than once are written and weighed first. Up to
    ``BROADCAST_BYTES`` of them are broadcast, and the table is scanned without a shuffle; beyond
    that, or without a folder, rows are compared by ``keep_latest_batch`` and ``stale_rows``.
    """
    directory = _directory(df, staged, stage_dir)
    if directory:
        found = superseded_keys(df, primary_key, epoch_col)
        name, batch = f"{_stage_name(target_name, 'table')}_superseded", _batch(batch_id)
        superseded = stage(found, directory, name, batch)
        paths = (staged_path(directory, name, batch),)
        if measured_bytes(superseded) <= checks.BROADCAST_BYTES:
            split = split_by_superseded(df, F.broadcast(superseded), primary_key, epoch_col)
            return CleanupResult(*split, staged=paths)
        remove(df.sparkSession, paths[0])
    hot = hot_keys(df, without(primary_key, [epoch_col]))
    return CleanupResult(
        keep_latest_batch(df, primary_key, epoch_col, hot),
        stale_rows(df, primary_key, epoch_col, hot),
    )
