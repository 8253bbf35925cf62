"""Column roles: which target columns are audit, key, validity, Type 1 or Type 2."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from dimweave import columns as C
from dimweave.functions.hashing import sql_name
from dimweave.spec import LoadSpec


def without(columns: Sequence[str], *removed: Iterable[str | None]) -> list[str]:
    """Columns minus the removed names, whatever their case, in the original order."""
    gone = {name.lower() for names in removed for name in names if name}
    return [c for c in columns if c.lower() not in gone]


def spelled(columns: Sequence[str], name: str) -> str:
    """The table's own spelling of a column name."""
    for c in columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"column {name!r} is not among {list(columns)}")


def has(columns: Sequence[str], name: str) -> bool:
    return any(c.lower() == name.lower() for c in columns)


@dataclass(frozen=True)
class RoleSet:
    business: tuple[str, ...]
    """All columns but the audit block and the batch epoch."""
    type1_upsert: tuple[str, ...]
    """What a Type 1 dimension compares: business columns minus the two keys."""
    type1: tuple[str, ...]
    """What a Type 2 dimension overwrites in place."""
    type2: tuple[str, ...]
    """What opens a new version when it changes."""


def roles(columns: Sequence[str], spec: LoadSpec) -> RoleSet:
    business = without(columns, C.AUDIT, [C.BATCH_EPOCH])
    keys = [spec.sid_key, spec.dim_key]
    validity = [C.EFFECTIVE, C.EXPIRATION, C.CURRENT]
    type2 = [spelled(columns, name) for name in spec.scd_type2_attributes]
    return RoleSet(
        business=tuple(business),
        type1_upsert=tuple(without(business, keys)),
        type1=tuple(without(business, keys, validity, type2)),
        type2=tuple(type2),
    )


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.selectExpr(*[f"{sql_name(c)} AS {sql_name(c)}" for c in columns])
