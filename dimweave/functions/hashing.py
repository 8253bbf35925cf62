"""Change hashes and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators between hashed values.
VALUE_DELIMITER = "*#*"
ROW_HASH_SEPARATOR = "|"

SHA256 = "sha256"
MD5 = "md5"
XXH64 = "xxh64"


def sql_name(name: str) -> str:
    """An exact name as SQL text, dots and blanks included."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by its exact name."""
    return F.col(sql_name(name))


def _columns(cols: Sequence[str | Column]) -> list[Column]:
    return [quoted(c) if isinstance(c, str) else c for c in cols]


def _delimited(values: list[Column]) -> Column:
    parts: list[Column] = []
    for value in values:
        if parts:
            parts.append(F.lit(VALUE_DELIMITER))
        parts.append(value)
    return F.concat(*parts) if parts else F.lit("")


def norm_text(col: str | Column) -> Column:
    """Text form in which case, outer spaces and NULL against '' are no difference."""
    (value,) = _columns([col])
    return F.coalesce(F.trim(F.upper(value.cast("string"))), F.lit(""))


def hash_norm(cols: Sequence[str | Column]) -> Column:
    """MD5 of the normalised values. No columns give a constant: nothing ever changes."""
    return F.md5(_delimited([norm_text(c) for c in cols]))


def digest_norm(cols: Sequence[str | Column]) -> Column:
    """``hash_norm`` as 16 bytes, half of what the hex text costs in a shuffle."""
    return F.unhex(hash_norm(cols))


def hash_raw(cols: Sequence[str | Column]) -> Column:
    """MD5 of the values as they are; NULL as soon as one value is NULL."""
    return F.md5(_delimited([c.cast("string") for c in _columns(cols)]))


def row_hash(cols: Sequence[str | Column], algorithm: str = SHA256) -> Column:
    """Text hash over the attribute values; case matters, NULL equals ''.

    SHA-256 unless told otherwise. MD5 costs less to compute and store, XXH64 least of all; neither
    withstands values made to collide. A table keeps one algorithm for life.
    """
    values = [F.coalesce(c.cast("string"), F.lit("")) for c in _columns(cols)]
    text = F.concat_ws(ROW_HASH_SEPARATOR, *values)
    if algorithm == SHA256:
        return F.sha2(text, 256)
    if algorithm == MD5:
        return F.md5(text)
    if algorithm == XXH64:
        return F.lower(F.hex(F.xxhash64(text)))
    raise ValueError(f"unknown row hash {algorithm!r}")


def surrogate_key(cols: Sequence[str | Column], separator: str = VALUE_DELIMITER) -> Column:
    """64-bit key: the low 8 bytes of SHA-1 read as a signed long, 0 when all values are blank."""
    values = [F.coalesce(c.cast("string"), F.lit("")) for c in _columns(cols)]
    if not values:
        raise ValueError("a surrogate key needs a column")
    text = values[0] if len(values) == 1 else F.concat_ws(separator, *values)
    blank = reduce(lambda a, b: a & b, [value == "" for value in values])
    low_half = F.substring(F.sha1(text), 25, 16)
    return F.when(blank, F.lit(0).cast("bigint")).otherwise(
        F.conv(low_half, 16, -10).cast("bigint")
    )


def changed_md5(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    return hash_norm(left) != hash_norm(right)


def unchanged_md5(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    return hash_norm(left) == hash_norm(right)


def changed_md5_raw(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    """NULL, so not reported by a filter, when a value on either side is NULL."""
    return hash_raw(left) != hash_raw(right)


def changed_sha2(source_hash: str | Column, target_hash: str | Column) -> Column:
    """True for a key without target hash and for a differing hash."""
    source, target = _columns([source_hash, target_hash])
    return target.isNull() | (source != target)
