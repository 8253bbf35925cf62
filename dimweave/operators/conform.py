"""Casts of a feed to the schema of its target."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    CharType,
    DataType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
)

from dimweave import columns as C
from dimweave.functions.clock import DEFAULT_ZONE, instant_of, utc_wall
from dimweave.functions.hashing import quoted

RAISE = "raise"
NULL = "null"
REJECT = "reject"

# The column that says why a row was rejected.
REASON = "reject_reason"

# Fixed value: the field metadata key under which a Spark table keeps a char or varchar length.
LENGTH_METADATA = "__CHAR_VARCHAR_TYPE_STRING"


def declared_type(field: StructField) -> DataType:
    """The field's type with the length a catalog table hides in the metadata."""
    stored = (field.metadata or {}).get(LENGTH_METADATA)
    return DataType.fromDDL(stored) if stored else field.dataType


def fit(value: Column, wanted: DataType, on_overflow: str = RAISE) -> Column:
    """Cast one value. Text is cut to a declared length and ``char`` padded to it."""
    if isinstance(wanted, VarcharType):
        return F.substring(value.cast("string"), 1, wanted.length)
    if isinstance(wanted, CharType):
        return F.rpad(F.substring(value.cast("string"), 1, wanted.length), wanted.length, " ")
    return value.cast(wanted) if on_overflow == RAISE else value.try_cast(wanted)


# Stamps that feeds carry as wall clocks: of UTC, and of the zone of the validity columns.
UTC_STAMPS = {c.lower() for c in (C.INSERTED_AT, C.UPDATED_AT, C.EFFECTIVE_DATE, C.END_DATE)}
LOCAL_STAMPS = {c.lower() for c in (C.EFFECTIVE, C.EXPIRATION)}


def stamp_zone(name: str, zone: str) -> str | None:
    """Whose wall clock a stamp column shows; None for other columns."""
    if name.lower() in UTC_STAMPS:
        return "UTC"
    return zone if name.lower() in LOCAL_STAMPS else None


def wall_stamps(df: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """A target whose ``timestamp`` stamps are told as the wall clocks that feeds carry."""
    told = {}
    for f in df.schema.fields:
        of = stamp_zone(f.name, zone)
        if of and isinstance(f.dataType, TimestampType):
            utc = utc_wall(quoted(f.name))
            told[f.name] = utc if of == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(of), utc)
    return df.withColumns(told) if told else df


def conform(
    df: DataFrame,
    target_schema: StructType | str,
    on_overflow: str = RAISE,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """The target's columns, in its order and types. Other columns are dropped, missing ones raise.

    A value that does not fit its type raises under ANSI mode, or becomes NULL with
    ``on_overflow='null'``. Audit and validity stamps that go into ``timestamp`` columns are read as
    the wall clock they show, UTC or that of ``zone``, whatever the session's zone.
    """
    if on_overflow not in (RAISE, NULL):
        raise ValueError(f"on_overflow must be {RAISE!r} or {NULL!r}, not {on_overflow!r}")
    if isinstance(target_schema, str):
        target_schema = StructType.fromDDL(target_schema)
    walls = {f.name.lower() for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)}

    def value(f: StructField) -> Column:
        of = stamp_zone(f.name, zone)
        if of and isinstance(f.dataType, TimestampType) and f.name.lower() in walls:
            return instant_of(quoted(f.name), of)
        return fit(quoted(f.name), declared_type(f), on_overflow)

    return df.select(*[value(f).alias(f.name) for f in target_schema.fields])


def misfits(df: DataFrame, target_schema: StructType | str) -> Column:
    """Names of the target columns that can't hold a row's value, joined by commas; NULL for a row that fits.

    That is a value its type can't express, or a NULL where the target takes none. Texts are cut to their
    length as ever.
    """
    if isinstance(target_schema, str):
        target_schema = StructType.fromDDL(target_schema)
    walls = {f.name.lower() for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)}
    reasons = []
    for f in target_schema.fields:
        value, wrong = quoted(f.name), F.lit(False)
        stamp = stamp_zone(f.name, DEFAULT_ZONE) and f.name.lower() in walls
        if not (stamp and isinstance(f.dataType, TimestampType)):
            wrong = value.isNotNull() & fit(value, declared_type(f), NULL).isNull()
        if not f.nullable:
            wrong = wrong | value.isNull()
        reasons.append(F.when(wrong, F.lit(f.name)))
    text = F.concat_ws(", ", *reasons)
    return F.when(text != "", text)


def split_fit(
    df: DataFrame,
    target_schema: StructType | str,
    keep: Callable[[DataFrame], DataFrame],
    zone: str = DEFAULT_ZONE,
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the target, conformed to it, and the others as they came with ``reject_reason``.

    ``keep`` writes all rows with their reasons once and reads them back; both results are scans of that.
    """
    told = keep(df.withColumn(REASON, misfits(df, target_schema)))
    fitting = told.where(quoted(REASON).isNull()).drop(REASON)
    return conform(fitting, target_schema, zone=zone), told.where(quoted(REASON).isNotNull())
