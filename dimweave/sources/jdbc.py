"""JDBC targets."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.functions.hashing import quoted

# Rows per round trip; drivers default to as few as 10.
FETCH_SIZE = "10000"
BATCH_SIZE = "10000"


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    single_task: bool = False,
) -> DataFrame:
    """Read a table in parallel ranges of ``partition_column``, or by one task if ``single_task`` says so.

    Missing bounds are asked from the database in one aggregate query. A table whose partition column
    is NULL throughout, or that is empty, has no ranges and is read by one task.
    """
    props = {"fetchsize": FETCH_SIZE, **(properties or {})}
    if single_task:
        return spark.read.jdbc(url, table, properties=props)
    if partition_column is None:
        raise ValueError("name a partition_column, or pass single_task=True to read by one task")
    if not num_partitions:
        raise ValueError("a partitioned read needs num_partitions")
    if lower_bound is None or upper_bound is None:
        column = F.col(partition_column)
        low, high = (
            spark.read.jdbc(url, table, properties={**props, "pushDownAggregate": "true"})
            .agg(F.min(column), F.max(column))
            .first()
        )
        if low is None:
            return spark.read.jdbc(url, table, properties=props)
        lower_bound = low if lower_bound is None else lower_bound
        upper_bound = high if upper_bound is None else upper_bound
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=str(lower_bound),
        upperBound=str(upper_bound),
        numPartitions=num_partitions,
        properties=props,
    )


def _literal(value: Any) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, bool) or not isinstance(value, int | float | Decimal):
        raise ValueError(f"no ranges over values like {value!r}")
    return str(value)


def depth_predicates(rows: DataFrame, column: str, parts: int) -> list[str]:
    """Conditions that part rows by a number, date or timestamp column into about equally many each.

    The cuts are approximate percentiles. A value with more rows than a part should have gets a part of its
    own; there are fewer parts then. Rows with a NULL are in the first.
    """
    shares = [i / parts for i in range(1, parts)]
    name, found = quoted(column), []
    if shares:
        found = rows.agg(F.percentile_approx(name, shares, 100 * parts)).first()[0] or []
    cuts = [_literal(v) for v in dict.fromkeys(found)]
    if not cuts:
        return ["1 = 1"]
    first = [f"{column} < {cuts[0]} OR {column} IS NULL"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [*first, *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc_evenly(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
    **bounds: int | str,
) -> DataFrame:
    """Read a table in ranges of about equally many rows, however skewed the column.

    The column alone is read first, in even ranges, to find the cuts (``depth_predicates``).
    """
    props = {"fetchsize": FETCH_SIZE, **(properties or {})}
    column = read_jdbc(
        spark, url, table, properties, partition_column, num_partitions=num_partitions, **bounds
    ).select(quoted(partition_column))
    predicates = depth_predicates(column, partition_column, num_partitions)
    return spark.read.jdbc(url, table, predicates=predicates, properties=props)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    df.write.mode("append").jdbc(url, table, properties=_write(properties))


def stage_jdbc(
    feed: DataFrame,
    url: str,
    target: str,
    batch_id: str | int,
    properties: Mapping[str, str] | None = None,
    schema_owner: str | None = None,
) -> str:
    """Replace the batch's staging table ``TMP_<target>_<batch>`` and return its name."""
    name = f"TMP_{target}_{batch_id}"
    table = f"{schema_owner}.{name}" if schema_owner else name
    feed.write.mode("overwrite").jdbc(url, table, properties=_write(properties))
    return table


def _write(properties: Mapping[str, str] | None) -> dict[str, str]:
    return {"batchsize": BATCH_SIZE, **(properties or {})}
