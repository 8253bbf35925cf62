"""Feeds applied to a target. Each function returns the next snapshot as a DataFrame.

A snapshot reads the target it replaces, so it is written to a new location
(``sources.files.write_scd_table``). Catalogs with row-level operations can run ``merge_type1`` and
``merge_scd2_hash`` in place instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimweave import columns as C
from dimweave.functions.clock import DEFAULT_ZONE
from dimweave.functions.hashing import quoted, sql_name
from dimweave.operators.conform import RAISE, conform
from dimweave.operators.feeds import with_epoch_of
from dimweave.operators.hash_scd2 import VERSION_COLUMNS
from dimweave.operators.joins import (
    SOURCE,
    TARGET,
    Keys,
    current_slice,
    key_list,
    pair_reduced,
    prefixed,
    s,
    t,
)
from dimweave.operators.roles import has, project, spelled, without
from dimweave.spec import LoadSpec

# Names no table column has.
HIT = "#hit"
SID = "#sid"
GONE = "#gone"


def feed_rows(
    target: DataFrame,
    feed: DataFrame,
    epoch: int | None = None,
    schema: StructType | None = None,
    on_overflow: str = RAISE,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """A feed's rows as the target will hold them."""
    return conform(
        with_epoch_of(feed, target.columns, epoch), schema or target.schema, on_overflow, zone
    )


def sid_hits(target: DataFrame, feed: DataFrame, spec: LoadSpec) -> DataFrame:
    """Each surrogate key of a feed once, in the target's type, with its action; repeated keys raise.

    A feed without action tags updates what it meets and may repeat keys.
    """
    sid = spelled(target.columns, spec.sid_key)
    tagged = has(feed.columns, C.ACTION)
    action = quoted(C.ACTION) if tagged else F.lit(C.UPDATE)
    text = F.coalesce(quoted(sid).cast("string"), F.lit(""))
    repeated = F.raise_error(F.concat(F.lit("the feed repeats surrogate key "), text))
    return (
        feed.select(quoted(sid).cast(target.schema[sid].dataType).alias(sid), action.alias(HIT))
        .where(quoted(sid).isNotNull())
        .groupBy(quoted(sid))
        .agg(F.count(F.lit(1)).alias("#rows"), F.max(HIT).alias(HIT))
        .select(
            quoted(sid).alias(SID),
            F.when((quoted("#rows") > 1) & F.lit(tagged), repeated.cast("string"))
            .otherwise(quoted(HIT))
            .alias(HIT),
        )
    )


def mark_by_sid(rows: DataFrame, hits: DataFrame, sid: str) -> DataFrame:
    """Target rows with a column that says whether the feed replaces them.

    A key that the feed inserts and the target holds raises: the join that finds the rows to replace is
    the check, which needs no scan of its own and holds whether the feed is staged or not.
    """
    text = F.coalesce(quoted(sid).cast("string"), F.lit(""))
    held = F.raise_error(F.concat(F.lit("the target already holds surrogate key "), text))
    replaced = F.when(quoted(HIT) == C.INSERT, held.cast("boolean")).otherwise(quoted(HIT).isNotNull())
    joined = rows.join(hits, quoted(sid) == quoted(SID), "left")
    return joined.select(*map(quoted, rows.columns), replaced.alias(GONE))


def _replace_by_sid(
    target: DataFrame,
    feed: DataFrame,
    spec: LoadSpec,
    epoch: int | None,
    schema: StructType | None,
    on_overflow: str,
    zone: str,
) -> DataFrame:
    """Rows that the feed updates give way, its other rows are added.

    A feed that repeats a surrogate key, or inserts one the target holds, would leave two rows under
    it or drop one of another key; both raise (``sid_hits``, ``mark_by_sid``).
    """
    rows = feed_rows(target, feed, epoch, schema, on_overflow, zone)
    marked = mark_by_sid(target, sid_hits(target, feed, spec), spelled(target.columns, spec.sid_key))
    return project(marked.where(~quoted(GONE)), target.columns).unionByName(rows)


def apply_type1(
    target: DataFrame,
    feed: DataFrame,
    spec: LoadSpec,
    epoch: int | None = None,
    schema: StructType | None = None,
    on_overflow: str = RAISE,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Feed rows replace the target row with their surrogate key or are added.

    ``schema`` carries char/varchar lengths where the target DataFrame's own schema has none.
    """
    return _replace_by_sid(target, feed, spec, epoch, schema, on_overflow, zone)


def apply_type2(
    target: DataFrame,
    feed: DataFrame,
    spec: LoadSpec,
    epoch: int | None = None,
    schema: StructType | None = None,
    on_overflow: str = RAISE,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Closed and overwritten versions replace their row, opened versions are added.

    Rows match on the surrogate key, so that key must differ from version to version.
    """
    return _replace_by_sid(target, feed, spec, epoch, schema, on_overflow, zone)


def fact_rows(
    feed: DataFrame,
    target_schema: StructType | str,
    epoch: int | None = None,
    on_overflow: str = RAISE,
) -> DataFrame:
    """The conformed rows a fact load appends. Writing only these leaves the target unread."""
    if isinstance(target_schema, str):
        target_schema = StructType.fromDDL(target_schema)
    return conform(
        with_epoch_of(feed, target_schema.fieldNames(), epoch), target_schema, on_overflow
    )


def delete_batch_statement(table: str, epoch_col: str, epoch: int, predicate: str | None = None) -> str:
    """Removal of a batch's earlier run, for catalogs that support row-level operations."""
    if not isinstance(predicate, str | None):
        raise ValueError("the slice's predicate has to be text")
    slice_only = f" AND ({predicate})" if predicate is not None else ""
    return f"DELETE FROM {table} WHERE {sql_name(epoch_col)} = {int(epoch)}{slice_only}"


def apply_fact(
    target: DataFrame,
    feed: DataFrame,
    epoch: int | None = None,
    schema: StructType | None = None,
    on_overflow: str = RAISE,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Target plus the appended rows; ``zone`` is that of validity columns, if it has any."""
    return target.unionByName(fact_rows(feed, schema or target.schema, epoch, on_overflow))


def expiring_keys(feed: DataFrame, keys: Keys) -> DataFrame:
    """Keys whose current version a hash feed ends, target-prefixed, with their end date."""
    names = key_list(keys)
    return (
        prefixed(
            feed.where(F.col(C.MERGE_ACTION) == C.MERGE_EXPIRE), TARGET, [*names, C.END_DATE]
        )
        .groupBy(*[TARGET + n for n in names])
        .agg(F.max(t(C.END_DATE)).alias(TARGET + C.END_DATE), F.lit(True).alias(TARGET + HIT))
    )


def inserted_versions(target: DataFrame, feed: DataFrame) -> DataFrame:
    """A hash feed's new versions as the target holds them; columns it doesn't have are NULL."""
    inserted = feed.where(F.col(C.MERGE_ACTION) == C.MERGE_INSERT)
    missing = [f for f in target.schema.fields if not has(inserted.columns, f.name)]
    inserted = inserted.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return conform(inserted, target.schema)


def mark_expired(rows: DataFrame, feed: DataFrame, keys: Keys) -> DataFrame:
    """Target rows (keys and current flag among them) with whether a hash feed ends them."""
    joined = pair_reduced(
        prefixed(rows, SOURCE, rows.columns), expiring_keys(feed, keys), keys, "left"
    )
    ends = t(HIT).isNotNull() & F.coalesce(s(C.IS_CURRENT), F.lit(False))
    return joined.select(*[s(c).alias(c) for c in rows.columns], ends.alias(GONE))


def ended_versions(target: DataFrame, feed: DataFrame, keys: Keys, every: bool = True) -> DataFrame:
    """Current versions after a hash feed: those it names ended, the others, if ``every``, as they are."""
    current = prefixed(current_slice(target, C.IS_CURRENT), SOURCE, target.columns)
    joined = pair_reduced(current, expiring_keys(feed, keys), keys, "left" if every else "inner")
    hit = t(HIT).isNotNull()
    ended = {
        C.END_DATE: F.when(hit, t(C.END_DATE)).otherwise(s(C.END_DATE)),
        C.IS_CURRENT: F.when(hit, F.lit(False)).otherwise(s(C.IS_CURRENT)),
    }
    return joined.select(*[ended.get(c.lower(), s(c)).alias(c) for c in target.columns])


def apply_scd2_hash(target: DataFrame, feed: DataFrame, keys: Keys) -> DataFrame:
    """End the current versions named by expire rows and add the insert rows.

    Target columns the feed doesn't have are NULL in inserted rows.

    Only the current slice takes part in the join; history passes through, and with a table
    partitioned by the current flag its partition is scanned but never shuffled.
    """
    history = target.where(~F.coalesce(quoted(C.IS_CURRENT), F.lit(False)))
    next_current = ended_versions(target, feed, keys)
    return history.unionByName(next_current).unionByName(inserted_versions(target, feed))


def merge_type1_statement(table: str, source: str, columns: Sequence[str], sid: str, tagged: bool) -> str:
    """The Type 1 or Type 2 apply as one MERGE of a view whose rows carry the table's columns.

    With action tags an insert that meets a held key raises in its own branch: the target is read once.
    """
    key = sql_name(sid)
    given = [f"src.{sql_name(c)}" for c in columns]
    branches = []
    if tagged:
        text = f"concat('the target already holds surrogate key ', src.{key})"
        branches.append(
            f"WHEN MATCHED AND src.{sql_name(C.ACTION)} = '{C.INSERT}'"
            f" THEN UPDATE SET {key} = raise_error({text})"
        )
    sets = ", ".join(f"tgt.{sql_name(c)} = {value}" for c, value in zip(columns, given))
    branches.append(f"WHEN MATCHED THEN UPDATE SET {sets}")
    names = ", ".join(map(sql_name, columns))
    branches.append(f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(given)})")
    head = f"MERGE INTO {table} AS tgt USING {source} AS src ON tgt.{key} = src.{key}"
    return " ".join([head, *branches])


def once_by_sid(rows: DataFrame, sid: str) -> DataFrame:
    """Rows in which a repeated surrogate key raises: a MERGE would take two new rows of one key."""
    text = F.coalesce(quoted(sid).cast("string"), F.lit(""))
    repeated = F.raise_error(F.concat(F.lit("the feed repeats surrogate key "), text))
    n = F.count(F.lit(1)).over(Window.partitionBy(quoted(sid)))
    kind = rows.schema[sid].dataType
    checked = F.when((n > 1) & quoted(sid).isNotNull(), repeated.cast(kind)).otherwise(quoted(sid))
    return rows.withColumn(sid, checked)


def merge_type1(feed: DataFrame, table: str, spec: LoadSpec) -> None:
    """The Type 1 or Type 2 apply as one MERGE, for catalogs that support row-level operations.

    The feed must already be conformed and carry the table's columns; with action tags besides, repeated
    keys raise, and so does an inserted key that the table holds.
    """
    tagged = has(feed.columns, C.ACTION)
    sid = spelled(feed.columns, spec.sid_key)
    columns = without(feed.columns, [C.ACTION])
    rows = once_by_sid(feed, sid) if tagged else feed
    view = f"merge_feed_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        feed.sparkSession.sql(merge_type1_statement(table, view, columns, sid, tagged))
    finally:
        feed.sparkSession.catalog.dropTempView(view)


def merge_scd2_hash(
    feed: DataFrame, table: str, keys: Keys, attributes: Sequence[str]
) -> None:
    """The hash-history apply as one MERGE, for catalogs that support row-level operations."""
    same_key = " AND ".join(
        f"{table}.{sql_name(k)} = src.{sql_name(k)}" for k in key_list(keys)
    )
    expiring = f"src.{C.MERGE_ACTION} = '{C.MERGE_EXPIRE}'"
    inserted = [*key_list(keys), *attributes, *VERSION_COLUMNS]
    (
        feed.alias("src")
        .mergeInto(table, F.expr(f"{same_key} AND {table}.{C.IS_CURRENT} AND {expiring}"))
        .whenMatched()
        .update({c: F.col(f"src.{c}") for c in (C.END_DATE, C.IS_CURRENT)})
        .whenNotMatched(F.expr(f"src.{C.MERGE_ACTION} = '{C.MERGE_INSERT}'"))
        .insert({c: F.col(f"src.{sql_name(c)}") for c in inserted})
        .merge()
    )
