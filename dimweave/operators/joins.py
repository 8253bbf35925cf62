"""Source to target matching.

No side is hinted as broadcast here: Spark broadcasts a side only when its size is below
``spark.sql.autoBroadcastJoinThreshold`` (``checks.held_by`` does so after weighing). Beyond it the
joins are written so that adaptive execution can split a hot key. It can split either side of an
inner join but only the left side of a left, semi or anti join, so a side that may hold many rows
per key is no right side of those; where only the keys of such a side matter they are reduced to one
row per key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave import columns as C
from dimweave.functions.hashing import quoted, sql_name
from dimweave.operators.skew import hashes_as_it_compares, hot_keys, key_bucket, key_hash

SOURCE = "s__"
TARGET = "t__"
# Names no table column has.
BUCKET = "#bucket"
NEWEST = "#newest"

Keys = str | Sequence[str]


def key_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def prefixed(
    df: DataFrame,
    prefix: str,
    columns: Sequence[str],
    expressions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The given columns and expressions under one side's prefix; everything else is pruned."""
    extra = {prefix + name: expr for name, expr in (expressions or {}).items()}
    named = [f"{sql_name(c)} AS {sql_name(prefix + c)}" for c in columns]
    return (df.withColumns(extra) if extra else df).selectExpr(*named, *map(sql_name, extra))


def unprefixed(prefix: str, columns: Sequence[str]) -> list[Column]:
    """One side's columns under their own names."""
    return [quoted(prefix + c).alias(c) for c in columns]


def s(name: str) -> Column:
    return quoted(SOURCE + name)


def t(name: str) -> Column:
    return quoted(TARGET + name)


def pair(left: DataFrame, right: DataFrame, keys: Keys, how: str) -> DataFrame:
    """Equi join of a source-prefixed with a target-prefixed side."""
    condition = None
    for key in key_list(keys):
        equal = s(key) == t(key)
        condition = equal if condition is None else condition & equal
    return left.join(right, condition, how)


def comparable_buckets(left: DataFrame, right: DataFrame, keys: Keys) -> bool:
    """Whether equal keys of a source-prefixed and a target-prefixed side share a bucket."""
    names = key_list(keys)
    kinds = left.select(*map(s, names)).schema, right.select(*map(t, names)).schema
    return all(
        a.dataType == b.dataType and hashes_as_it_compares(a.dataType)
        for a, b in zip(*kinds, strict=True)
    )


def pair_reduced(left: DataFrame, reduced: DataFrame, keys: Keys, how: str) -> DataFrame:
    """``pair`` with a target side that an aggregate has reduced to one row per key.

    Spark would join right on the aggregate's partitioning, a form adaptive execution cannot split
    when the left side has a hot key. The key's bucket as a further join key changes no match but
    puts a shuffle of the reduced rows below the join.
    """
    names = key_list(keys)
    if not comparable_buckets(left, reduced, names):
        return pair(left, reduced, names, how)
    left = left.withColumn(SOURCE + BUCKET, key_bucket([SOURCE + n for n in names]))
    reduced = reduced.withColumn(TARGET + BUCKET, key_bucket([TARGET + n for n in names]))
    return pair(left, reduced, [*names, BUCKET], how).drop(SOURCE + BUCKET, TARGET + BUCKET)


def join_versions(
    source: DataFrame,
    target: DataFrame,
    key: str,
    hot: Sequence[int] | None = None,
    held: Column | None = None,
) -> DataFrame:
    """Each source row with every version of its key, or with NULLs when the target lacks the key.

    One left join does it, but cannot be split when a key has a very long history: the target is its
    right side. Hot keys, counted first unless ``hot`` lists their hashes, therefore go through an
    inner join, which can, and an anti join against the target's distinct keys.

    ``held`` narrows down which target rows count as holding a key; a source row then comes with its
    versions and, when none of them counts, once more with NULLs.
    """
    if held is not None or not comparable_buckets(source, target, key):
        return _join_apart(source, target, key, held)
    if hot is None:
        hot = hot_keys(target, [TARGET + key])
    if not hot:
        return pair(source, target, key, "left")
    hot_source, hot_target = (
        F.coalesce(key_hash([side + key]).isin(*hot), F.lit(False)) for side in (SOURCE, TARGET)
    )
    together = pair(source.where(~hot_source), target.where(~hot_target), key, "left")
    apart = _join_apart(source.where(hot_source), target.where(hot_target), key, None)
    return together.unionByName(apart)


def _join_apart(
    source: DataFrame, target: DataFrame, key: str, held: Column | None
) -> DataFrame:
    """Matches by an inner join, the rest by an anti join, in which rows without a key meet nothing."""
    holders = target if held is None else target.where(held)
    alone = pair_reduced(source, holders.select(t(key)).distinct(), key, "left_anti")
    matched = pair(source, target, key, "inner")
    return matched.unionByName(alone, allowMissingColumns=True)


def slice_both(
    src: DataFrame, tgt: DataFrame, predicate: str | Column | None
) -> tuple[DataFrame, DataFrame]:
    """Restrict a load to one slice on both sides, before any join, so the scans prune.

    A key the target holds in another slice only is a new key.
    """
    if predicate is None:
        return src, tgt
    return src.where(predicate), tgt.where(predicate)


def slice_of_source(src: DataFrame, tgt: DataFrame, columns: Keys) -> DataFrame:
    """Target rows of the partitions that the source has rows in, NULL partitions among them.

    The source says which, when it is read: with a selective source Spark prunes the target's partitions
    at run time. The list is broadcast; it has no more rows than the target has partitions that matter.
    A key the target holds in another partition only is a new key, as with ``slice_both``.
    """
    names = key_list(columns)
    wanted = F.broadcast(src.select(*[quoted(c).alias(SOURCE + c) for c in names]).distinct())
    same = None
    for name in names:
        equal = quoted(name) == s(name)
        same = equal if same is None else same & equal
    plain = tgt.join(wanted, same, "left_semi")
    anywhere_null = " OR ".join(f"{sql_name(c)} IS NULL" for c in names)
    loose = None
    for name in names:
        equal = quoted(name).eqNullSafe(s(name))
        loose = equal if loose is None else loose & equal
    return plain.unionByName(tgt.where(anywhere_null).join(wanted, loose, "left_semi"))


def current_slice(tgt: DataFrame, flag_col: str = C.CURRENT) -> DataFrame:
    return tgt.where(flag_is(tgt, flag_col, True))


def history_slice(tgt: DataFrame, flag_col: str = C.CURRENT) -> DataFrame:
    return tgt.where(flag_is(tgt, flag_col, False))


def flag_is(tgt: DataFrame, flag_col: str, current: bool) -> Column:
    """Test of a boolean or a 'Y'/'N' flag column."""
    if dict((n.lower(), d) for n, d in tgt.dtypes)[flag_col.lower()] == "boolean":
        return quoted(flag_col) == F.lit(current)
    return quoted(flag_col) == F.lit(C.YES if current else C.NO)


def new_keys(src: DataFrame, tgt: DataFrame, keys: Keys) -> DataFrame:
    """Source rows whose key the target does not hold; the target is reduced to its keys first."""
    names = key_list(keys)
    held = prefixed(tgt, TARGET, names).distinct()
    alone = pair_reduced(prefixed(src, SOURCE, src.columns), held, names, "left_anti")
    return alone.select(*unprefixed(SOURCE, src.columns))


def matched_keys(src: DataFrame, tgt: DataFrame, keys: Keys) -> DataFrame:
    """Source and target rows that share a key, prefixed by side."""
    return pair(
        prefixed(src, SOURCE, src.columns), prefixed(tgt, TARGET, tgt.columns), keys, "inner"
    )


def join_left(src: DataFrame, tgt: DataFrame, keys: Keys) -> DataFrame:
    """All source rows with their target rows or NULLs, prefixed by side."""
    return pair(
        prefixed(src, SOURCE, src.columns), prefixed(tgt, TARGET, tgt.columns), keys, "left"
    )


def join_current(
    src: DataFrame, tgt: DataFrame, keys: Keys, columns: Sequence[str], flag_col: str = C.IS_CURRENT
) -> DataFrame:
    """All source rows with the named columns of their current target row."""
    current = current_slice(tgt, flag_col)
    return pair(
        prefixed(src, SOURCE, src.columns),
        prefixed(current, TARGET, [*key_list(keys), *columns]),
        keys,
        "left",
    )


def rows_to_expire(
    tgt: DataFrame, changed: DataFrame, keys: Keys, flag_col: str = C.IS_CURRENT
) -> DataFrame:
    """Current target rows of the changed keys; composite keys must match as a whole."""
    wanted = changed.select(*map(quoted, key_list(keys)))
    return current_slice(tgt, flag_col).join(wanted, key_list(keys), "left_semi")


def next_version(changed: DataFrame, tgt: DataFrame, keys: Keys) -> DataFrame:
    """Changed rows with the version that follows the newest one of their key, 1 for a new key.

    The target's versions are reduced to one row per key before the shuffle, so a key with a long
    history costs no more than any other. A NULL in the key meets nothing, so such rows are new.
    """
    names = key_list(keys)
    newest = (
        prefixed(tgt, TARGET, [*names, C.VERSION])
        .groupBy(*[TARGET + n for n in names])
        .agg(F.max(t(C.VERSION)).alias(TARGET + NEWEST))
    )
    rest = [c for c in changed.columns if c.lower() != C.VERSION]
    joined = pair_reduced(prefixed(changed, SOURCE, rest), newest, names, "left")
    return joined.select(
        *unprefixed(SOURCE, rest),
        F.coalesce(t(NEWEST) + 1, F.lit(1)).cast("int").alias(C.VERSION),
    )
