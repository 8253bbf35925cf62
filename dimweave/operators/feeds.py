"""Change feeds: what a source would insert into or update in a target."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave import columns as C
from dimweave.functions import audit, versions
from dimweave.functions.clock import DEFAULT_ZONE, LoadTime
from dimweave.functions.hashing import digest_norm, hash_raw, quoted
from dimweave.operators.conform import NULL, declared_type, fit, wall_stamps
from dimweave.operators.joins import (
    SOURCE,
    TARGET,
    join_versions,
    pair,
    pair_reduced,
    prefixed,
    s,
    slice_both,
    t,
    unprefixed,
)
from dimweave.operators.roles import has, roles, spelled, without
from dimweave.spec import LoadSpec

OPEN = "open"
CLOSE = "close"
OVERWRITE = "overwrite"
BRANCHES = (OPEN, CLOSE, OVERWRITE)

# Names no table column has.
DIGEST = "#digest"
DIGEST1 = "#digest1"
DIGEST2 = "#digest2"


def as_stored(src: DataFrame, tgt: DataFrame, names: Sequence[str]) -> list[str | Column]:
    """Source columns as the target would store them, to be compared with what it holds.

    A value its type can't hold is NULL here and so differs; whether it may be loaded is for the apply.
    """
    fields, found = {f.name: f for f in tgt.schema.fields}, []
    for name in names:
        wanted = declared_type(fields[name])
        given = declared_type(src.schema[spelled(src.columns, name)])
        found.append(name if given == wanted else fit(quoted(name), wanted, NULL))
    return found


# Whole-number types, each of which holds all values of those before it.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def key_as_in(src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """The source with its key in the target's type, where that is a wider whole number."""
    name = spelled(src.columns, key)
    given, wanted = type(src.schema[name].dataType), type(tgt.schema[key].dataType)
    if given in WHOLE and wanted in WHOLE and WHOLE.index(given) < WHOLE.index(wanted):
        return src.withColumn(name, quoted(name).cast(tgt.schema[key].dataType))
    return src


def _named(block: dict[str, Column]) -> list[Column]:
    return [expr.alias(name) for name, expr in block.items()]


def rows_for_action(feed: DataFrame, flag: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of a feed with one action, without the tag."""
    chosen = columns or without(feed.columns, [C.ACTION])
    return feed.where(F.col(C.ACTION) == flag).select(*map(quoted, chosen))


def fact_insert_feed(
    src: DataFrame,
    target_columns: list[str],
    load_ts: LoadTime,
    epoch: int,
    predicate: str | Column | None = None,
) -> DataFrame:
    """Every source row of the slice as a fact insert."""
    if predicate is not None:
        src = src.where(predicate)
    business = without(target_columns, C.AUDIT, [C.BATCH_EPOCH])
    return src.select(
        *[quoted(c).alias(c) for c in business],
        *_named(audit.fact_block(F.col(C.BATCH_SID), load_ts)),
        F.lit(epoch).cast("bigint").alias(C.BATCH_EPOCH),
        F.lit(C.INSERT).alias(C.ACTION),
    )


def type1_upsert_feed(
    src: DataFrame,
    tgt: DataFrame,
    spec: LoadSpec,
    load_ts: LoadTime,
    predicate: str | Column | None = None,
) -> DataFrame:
    """New rows, and known rows whose normalised attributes differ.

    One left join on the surrogate key serves both branches. The target side is reduced to its key,
    insert stamp and a 16-byte digest before it is shuffled.
    """
    src, tgt = slice_both(src, wall_stamps(tgt), predicate)
    role = roles(tgt.columns, spec)
    sid = spelled(tgt.columns, spec.sid_key)
    src = key_as_in(src, tgt, sid)
    digest = {DIGEST: digest_norm(as_stored(src, tgt, role.type1_upsert))}
    held = {DIGEST: digest_norm(role.type1_upsert)}
    joined = pair(
        prefixed(src, SOURCE, [*role.business, C.BATCH_SID], digest),
        prefixed(tgt, TARGET, [sid, C.INSERTED_BY, C.INSERTED_AT], held),
        sid,
        "left",
    )
    is_new = t(sid).isNull()
    stamps = audit.choose(
        is_new,
        audit.insert_block(s(C.BATCH_SID), load_ts),
        audit.update_block(s(C.BATCH_SID), load_ts, t(C.INSERTED_BY), t(C.INSERTED_AT)),
    )
    return joined.where(is_new | (s(DIGEST) != t(DIGEST))).select(
        *unprefixed(SOURCE, role.business),
        *_named(stamps),
        F.when(is_new, C.INSERT).otherwise(C.UPDATE).alias(C.ACTION),
    )


def upsert_all_matched_feed(
    src: DataFrame, tgt: DataFrame, spec: LoadSpec, load_ts: LoadTime
) -> DataFrame:
    """New rows and every known row, without change detection, tag or exact copies.

    Here the batch epoch, when the target has one, is an ordinary column and the batch id is 1. The
    target's copies of key and stamps are dropped before the join, which is narrow; the source's are
    dropped after it, where rows of a key are together already.
    """
    tgt = wall_stamps(tgt)
    sid = spelled(tgt.columns, spec.sid_key)
    src = key_as_in(src, tgt, sid)
    business = without(tgt.columns, C.AUDIT)
    joined = pair(
        prefixed(src, SOURCE, business),
        prefixed(tgt, TARGET, [sid, C.INSERTED_BY, C.INSERTED_AT]).distinct(),
        sid,
        "left",
    )
    is_new = t(sid).isNull()
    stamps = audit.choose(
        is_new,
        audit.insert_block(F.lit(1), load_ts),
        audit.update_block(F.lit(1), load_ts, t(C.INSERTED_BY), t(C.INSERTED_AT)),
    )
    return joined.select(*unprefixed(SOURCE, business), *_named(stamps)).distinct()


def type1_hybrid_feed(
    src: DataFrame, tgt: DataFrame, spec: LoadSpec, load_ts: LoadTime
) -> DataFrame:
    """Type 1 values of business keys that differ, as they stand, from some version of the key.

    A NULL on either side hides a change. A value differs from some version when it differs from the
    smallest or the largest of them, so the target is reduced to these two hashes per key: however
    long a history is, it is one row in the join.
    """
    dim = spelled(tgt.columns, spec.dim_key)
    src = key_as_in(src, tgt, dim)
    attributes = [spelled(tgt.columns, c) for c in spec.scd_type1_attributes]
    digest = {DIGEST: F.unhex(hash_raw(as_stored(src, tgt, attributes)))}
    source = prefixed(src, SOURCE, [dim, *attributes, C.BATCH_SID], digest).distinct()
    known = tgt.where(quoted(spec.sid_key).isNotNull())
    seen = prefixed(known, TARGET, [dim], {DIGEST: F.unhex(hash_raw(attributes))}).groupBy(t(dim))
    seen = seen.agg(F.min(t(DIGEST)).alias(TARGET + DIGEST1), F.max(t(DIGEST)).alias(TARGET + DIGEST2))
    differs = (s(DIGEST) != t(DIGEST1)) | (s(DIGEST) != t(DIGEST2))
    return pair_reduced(source, seen, dim, "inner").where(differs).select(
        s(dim).cast(tgt.schema[dim].dataType).alias(dim),
        *unprefixed(SOURCE, attributes),
        F.lit(C.ETL_USER).alias(C.UPDATED_BY),
        audit.utc_time(load_ts).alias(C.UPDATED_AT),
        s(C.BATCH_SID).alias(C.BATCH_SID),
        F.lit(C.UPDATE).alias(C.ACTION),
    )


def type2_hybrid_feed(
    src: DataFrame,
    tgt: DataFrame,
    spec: LoadSpec,
    load_ts: LoadTime,
    zone: str = DEFAULT_ZONE,
    predicate: str | Column | None = None,
    branches: Collection[str] = BRANCHES,
    reopen: bool = False,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Versions to open, close and overwrite in a dimension with Type 1 and Type 2 attributes.

    Source rows meet every version of their business key in one join, and each pair names the
    branches it feeds: a current version with a Type 2 change is closed and its successor opened; any
    version that stays as it is but has other Type 1 values is overwritten; a source row without a
    version is opened. ``hot`` lists the hashes of keys with very long histories; without it they are
    counted first (``joins.join_versions``).

    A key that has history but no current version is not opened again unless ``reopen`` is set.
    """
    unknown = set(branches) - set(BRANCHES)
    if unknown:
        raise ValueError(f"unknown branches {sorted(unknown)}")
    src, tgt = slice_both(src, wall_stamps(tgt, zone), predicate)
    role = roles(tgt.columns, spec)
    sid, dim = spelled(tgt.columns, spec.sid_key), spelled(tgt.columns, spec.dim_key)
    src = key_as_in(src, tgt, dim)
    held_digests = {DIGEST1: digest_norm(role.type1), DIGEST2: digest_norm(role.type2)}
    digests = {
        DIGEST1: digest_norm(as_stored(src, tgt, role.type1)),
        DIGEST2: digest_norm(as_stored(src, tgt, role.type2)),
    }
    from_source = [sid, dim, *role.type1, *role.type2, C.BATCH_SID]
    from_target = [
        sid, dim, C.EFFECTIVE, C.EXPIRATION, C.CURRENT, *role.type2, C.INSERTED_BY, C.INSERTED_AT,
    ]
    source = prefixed(src, SOURCE, from_source, digests)
    target = prefixed(tgt, TARGET, from_target, held_digests)

    known = t(sid).isNotNull()
    current = t(C.CURRENT) == C.YES
    new_version = s(DIGEST2) != t(DIGEST2)
    opens = ~known | (current & new_version)
    closes = known & current & new_version
    overwrites = (
        known
        & (s(DIGEST1) != t(DIGEST1))
        & ((t(C.CURRENT) == C.NO) | (current & ~new_version))
    )
    wanted = {OPEN: opens, CLOSE: closes, OVERWRITE: overwrites}
    either = F.lit(False)
    for name in branches:
        either = either | wanted[name]
    both = OPEN in branches and CLOSE in branches
    kinds = F.when(F.lit(both) & opens & closes, F.array(F.lit(OPEN), F.lit(CLOSE)))
    for name in branches:
        kinds = kinds.when(wanted[name], F.array(F.lit(name)))
    if OPEN in branches:
        held = current | ~known if reopen else None
        joined = join_versions(source, target, dim, hot, held)
    else:
        joined = pair(source, target, dim, "inner")
    rows = joined.where(either).withColumn("kind", F.explode(kinds))

    is_open, is_close = F.col("kind") == OPEN, F.col("kind") == CLOSE
    opened = versions.open_block(load_ts, zone)
    closed = versions.close_block(t(C.EFFECTIVE), load_ts, zone)
    stamps = audit.choose(
        is_open,
        audit.insert_block(s(C.BATCH_SID), load_ts),
        audit.update_block(s(C.BATCH_SID), load_ts, t(C.INSERTED_BY), t(C.INSERTED_AT)),
    )

    def newest_key(name: str) -> Column:
        return F.when(is_open, s(name)).otherwise(t(name)).alias(name)

    return rows.select(
        newest_key(sid),
        newest_key(dim),
        *[
            F.when(is_open, opened[c]).when(is_close, closed[c]).otherwise(t(c)).alias(c)
            for c in (C.EFFECTIVE, C.EXPIRATION, C.CURRENT)
        ],
        *unprefixed(SOURCE, role.type1),
        *[F.when(is_open, s(c)).otherwise(t(c)).alias(c) for c in role.type2],
        *_named(stamps),
        F.when(is_open, C.INSERT).otherwise(C.UPDATE).alias(C.ACTION),
    )


def with_epoch_of(feed: DataFrame, target_columns: list[str], epoch: int | None) -> DataFrame:
    """Add the run's epoch to a feed that lacks it while the target has the column."""
    if has(target_columns, C.BATCH_EPOCH) and not has(feed.columns, C.BATCH_EPOCH):
        if epoch is None:
            raise ValueError(f"the target has {C.BATCH_EPOCH}: the load needs an epoch")
        return audit.with_batch_epoch(feed, epoch)
    return feed
