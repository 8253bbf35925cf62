"""Catalog tables and SQL scripts."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from dimweave.sources.files import DEFAULT_FORMAT, write_result


def _name(table: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in table.split("."))


def _text(value: Any) -> str:
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def add_partition(
    spark: SparkSession, table: str, partition: Mapping[str, Any], location: str
) -> None:
    """Register a directory as a table partition; nothing happens when the partition exists.

    The look-up comes first because Spark's in-memory catalog moves an existing partition to the new
    location in spite of IF NOT EXISTS.
    """
    spec = ", ".join(f"{_name(c)} = {_text(v)}" for c, v in partition.items())
    if not spark.sql(f"SHOW PARTITIONS {_name(table)} PARTITION ({spec})").isEmpty():
        return
    spark.sql(
        f"ALTER TABLE {_name(table)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {_text(location)}"
    )


def read_script(spark: SparkSession, path: str) -> str:
    """Text of one script file: a file beside the driver, else any file system Spark reads."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as script:
            text = script.read()
    else:
        found = spark.read.text(path, wholetext=True).first()
        text = found[0] if found else ""
    return text.strip().rstrip(";")


def sql_script(
    spark: SparkSession, path: str, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Result of the one statement in a script file; ``:name`` markers take the parameters."""
    return spark.sql(read_script(spark, path), args=dict(params or {}))


def run_sql_script(
    spark: SparkSession,
    path: str,
    out: str,
    fmt: str = DEFAULT_FORMAT,
    params: Mapping[str, Any] | None = None,
) -> None:
    """Run a script file and replace the output with its result."""
    write_result(sql_script(spark, path, params), out, fmt)
