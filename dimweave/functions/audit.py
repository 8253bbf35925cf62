"""Audit column blocks. Each function returns expressions by column name, in target order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave import columns as C
from dimweave.functions.clock import LoadTime, utc_time


def no_name() -> Column:
    return F.lit(None).cast("string")


def no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def insert_block(batch_sid: Column, load_ts: LoadTime) -> dict[str, Column]:
    """A new dimension row: inserted now, never updated."""
    return {
        C.INSERTED_BY: F.lit(C.ETL_USER),
        C.INSERTED_AT: utc_time(load_ts),
        C.UPDATED_BY: no_name(),
        C.UPDATED_AT: no_time(),
        C.BATCH_SID: batch_sid,
    }


def fact_block(batch_sid: Column, load_ts: LoadTime) -> dict[str, Column]:
    """A fact row: inserted and updated stamps are the same."""
    return {
        C.INSERTED_BY: F.lit(C.ETL_USER),
        C.INSERTED_AT: utc_time(load_ts),
        C.UPDATED_BY: F.lit(C.ETL_USER),
        C.UPDATED_AT: utc_time(load_ts),
        C.BATCH_SID: batch_sid,
    }


def update_block(
    batch_sid: Column, load_ts: LoadTime, inserted_by: Column, inserted_at: Column
) -> dict[str, Column]:
    """An updated row: the insert stamp is carried over from the target."""
    return {
        C.INSERTED_BY: inserted_by,
        C.INSERTED_AT: inserted_at,
        C.UPDATED_BY: F.lit(C.ETL_USER),
        C.UPDATED_AT: utc_time(load_ts),
        C.BATCH_SID: batch_sid,
    }


def choose(is_new: Column, new: dict[str, Column], old: dict[str, Column]) -> dict[str, Column]:
    """Pick one of two blocks row by row."""
    return {name: F.when(is_new, new[name]).otherwise(old[name]) for name in new}


def audit_insert(df: DataFrame, load_ts: LoadTime) -> DataFrame:
    return df.withColumns(insert_block(F.col(C.BATCH_SID), load_ts))


def audit_update(
    df: DataFrame, load_ts: LoadTime, inserted_by: str, inserted_at: str
) -> DataFrame:
    """Stamp joined rows; the two names say where the target's insert stamp was joined in."""
    block = update_block(F.col(C.BATCH_SID), load_ts, F.col(inserted_by), F.col(inserted_at))
    return df.withColumns(block)


def with_batch_epoch(df: DataFrame, epoch: int) -> DataFrame:
    return df.withColumn(C.BATCH_EPOCH, F.lit(epoch).cast("bigint"))
