"""Hash-based history: change detection by a stored row hash, then an expire/insert feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave import columns as C
from dimweave.functions.clock import LoadTime, utc_time
from dimweave.functions.hashing import SHA256, changed_sha2, quoted
from dimweave.functions.versions import prepare_scd2
from dimweave.operators.joins import (
    NEWEST,
    SOURCE,
    TARGET,
    Keys,
    flag_is,
    join_current,
    key_list,
    pair_reduced,
    prefixed,
    rows_to_expire,
    s,
    t,
    unprefixed,
)

# Names no table column has.
CURRENT = "#current"
ROW = "#row"

VERSION_COLUMNS = (C.ROW_HASH, C.EFFECTIVE_DATE, C.END_DATE, C.IS_CURRENT, C.VERSION)


def scd2_hash_changed(
    src: DataFrame,
    tgt: DataFrame,
    keys: Keys,
    attributes: Sequence[str],
    load_ts: LoadTime,
    algorithm: str = SHA256,
) -> DataFrame:
    """Prepared source rows whose key has no current version or one with another hash."""
    prepared = prepare_scd2(src, attributes, load_ts, algorithm)
    joined = join_current(prepared, tgt, keys, [C.ROW_HASH])
    changed = joined.where(changed_sha2(SOURCE + C.ROW_HASH, TARGET + C.ROW_HASH))
    return changed.select(*unprefixed(SOURCE, prepared.columns))


def scd2_hash_expire(
    changed: DataFrame, tgt: DataFrame, keys: Keys, load_ts: LoadTime
) -> DataFrame:
    """Expire rows: keys and version of the current rows to end."""
    return rows_to_expire(tgt, changed, keys).select(
        *map(quoted, key_list(keys)),
        utc_time(load_ts).alias(C.END_DATE),
        F.lit(False).alias(C.IS_CURRENT),
        quoted(C.VERSION).alias(C.VERSION),
        F.lit(C.MERGE_EXPIRE).alias(C.MERGE_ACTION),
    )


def scd2_hash_feed(
    changed: DataFrame,
    tgt: DataFrame,
    keys: Keys,
    attributes: Sequence[str],
    load_ts: LoadTime,
) -> DataFrame:
    """Insert rows with their next version, and expire rows padded with typed NULLs.

    One join serves both: the target comes as one row per key with its newest version and its current
    ones, of which a sound history has one. A changed row then yields its insert and an expire row for
    each of them. ``changed`` has a key once, as its check says.
    """
    names = key_list(keys)
    current = F.when(flag_is(tgt, C.IS_CURRENT, True), quoted(C.VERSION))
    held = (
        tgt.select(*[quoted(n).alias(TARGET + n) for n in names], quoted(C.VERSION).alias("v"), current.alias("c"))
        .groupBy(*[TARGET + n for n in names])
        .agg(F.max("v").alias(TARGET + NEWEST), F.collect_list("c").alias(TARGET + CURRENT))
    )
    columns = [*names, *attributes, *VERSION_COLUMNS]
    joined = pair_reduced(prefixed(changed, SOURCE, columns), held, names, "left")
    insert, expire = F.lit(C.MERGE_INSERT), F.lit(C.MERGE_EXPIRE)
    number = F.coalesce(t(NEWEST) + 1, F.lit(1)).cast("int")
    one = lambda action, version: F.struct(action.alias("action"), version.cast("int").alias("version"))
    ended = F.transform(F.coalesce(t(CURRENT), F.array().cast("array<int>")), lambda v: one(expire, v))
    rows = joined.withColumn(ROW, F.explode(F.concat(F.array(one(insert, number)), ended)))
    is_new = F.col(f"`{ROW}`.action") == C.MERGE_INSERT
    fixed = {
        C.END_DATE: F.when(is_new, s(C.END_DATE)).otherwise(utc_time(load_ts)),
        C.IS_CURRENT: F.when(is_new, s(C.IS_CURRENT)).otherwise(F.lit(False)),
        C.VERSION: F.col(f"`{ROW}`.version"),
        **{n: s(n) for n in names},
    }
    return rows.select(
        *[fixed.get(c, F.when(is_new, s(c))).alias(c) for c in columns],
        F.col(f"`{ROW}`.action").alias(C.MERGE_ACTION),
    )
