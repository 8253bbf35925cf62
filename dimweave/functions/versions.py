"""Validity columns of history-keeping dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave import columns as C
from dimweave.functions.audit import no_time
from dimweave.functions.clock import DEFAULT_ZONE, LoadTime, local_time, utc_time
from dimweave.functions.hashing import SHA256, row_hash


def open_block(load_ts: LoadTime, zone: str = DEFAULT_ZONE) -> dict[str, Column]:
    """A version that starts one second after the load's local time and has no end."""
    return {
        C.EFFECTIVE: local_time(load_ts, zone) + F.expr("INTERVAL '1' SECOND"),
        C.EXPIRATION: no_time(),
        C.CURRENT: F.lit(C.YES),
    }


def close_block(
    effective: Column, load_ts: LoadTime, zone: str = DEFAULT_ZONE
) -> dict[str, Column]:
    """A version that ends at the load's local time and keeps its start."""
    return {
        C.EFFECTIVE: effective,
        C.EXPIRATION: local_time(load_ts, zone),
        C.CURRENT: F.lit(C.NO),
    }


def open_version(df: DataFrame, load_ts: LoadTime, zone: str = DEFAULT_ZONE) -> DataFrame:
    return df.withColumns(open_block(load_ts, zone))


def close_version(df: DataFrame, load_ts: LoadTime, zone: str = DEFAULT_ZONE) -> DataFrame:
    return df.withColumns(close_block(F.col(C.EFFECTIVE), load_ts, zone))


def prepare_scd2(
    src: DataFrame, attributes: Sequence[str], load_ts: LoadTime, algorithm: str = SHA256
) -> DataFrame:
    """Source rows as first versions of a hash-versioned dimension."""
    return src.withColumns(
        {
            C.ROW_HASH: row_hash(attributes, algorithm),
            C.EFFECTIVE_DATE: utc_time(load_ts),
            C.END_DATE: no_time(),
            C.IS_CURRENT: F.lit(True),
            C.VERSION: F.lit(1),
        }
    )
