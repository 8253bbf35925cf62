"""Changing a table of files in place: only the files or partitions that hold the rows concerned.

``drop_rows`` writes the rows that stay in the files concerned to a hidden folder of the table, notes there
which files they replace, and then swaps them in. The note is the point of no return: a swap that was cut
short is finished by the next call (``recover``), one without a note never happened. Between the two moves of
a swap a reader may see rows of both generations, never fewer than the table holds.

``overwrite_partitions`` and ``drop_partitions`` are Spark's own dynamic overwrite and ALTER TABLE.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.functions.hashing import quoted, sql_name

# Names no table column has.
FILE = "#file"
FOLDER = "__folder"
# Folders that begin like this are no data for Spark's readers.
PENDING = "_rewrite-"
# Rows that come from no file of the table.
NEW = "new"
JOURNAL = "journal.json"


def details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: location, provider and the like, by name."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"].lower(): r["data_type"] for r in rows}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


@dataclass(frozen=True)
class Buckets:
    """How a table's rows are dealt to files."""

    n: int
    columns: tuple[str, ...]
    sorted_by: tuple[str, ...]

    def of_row(self) -> Column:
        """The bucket in which Spark looks for a row."""
        return F.pmod(F.hash(*map(quoted, self.columns)), F.lit(self.n))


def bucketing(spark: SparkSession, table: str) -> Buckets | None:
    known = details(spark, table)
    if "num buckets" not in known:
        return None
    columns, order = (tuple(re.findall("`([^`]+)`", known.get(k, ""))) for k in ("bucket columns", "sort columns"))
    return Buckets(int(known["num buckets"]), columns, order)


def gathered(rows: DataFrame, parts: Sequence[str], buckets: Buckets | None) -> DataFrame:
    """Rows so that a write makes few files: a task per bucket, else as many as a partition fills."""
    if buckets:
        dealt = rows.repartition(buckets.n, *map(quoted, buckets.columns))
        return dealt.sortWithinPartitions(*map(quoted, [*parts, *buckets.sorted_by]))
    return rows.hint("rebalance", *parts) if parts else rows


def is_one_of(columns: Sequence[str], found: Sequence[Sequence[Any]]) -> Column:
    """Whether the columns have one of these lists of values, NULLs among them: a filter that prunes partitions."""
    if len(columns) == 1:
        plain = [values[0] for values in found if values[0] is not None]
        test = quoted(columns[0]).isin(*plain) if plain else F.lit(False)
        test = F.coalesce(test, F.lit(False))
        return test | quoted(columns[0]).isNull() if len(plain) < len(found) else test
    tests = [
        reduce(lambda a, b: a & b, [quoted(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, values)]) for values in found
    ]
    while len(tests) > 1:  # a balanced tree, however many partitions
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + (tests[-1:] if len(tests) % 2 else [])
    return tests[0] if tests else F.lit(False)


# --- partitions -----------------------------------------------------------------------------------


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of a write whose options do not reach it."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def append(rows: DataFrame, table: str) -> None:
    """Add rows to a table, whatever the order of their columns."""
    spark = rows.sparkSession
    buckets = bucketing(spark, table)
    dealt = gathered(rows, partition_columns(spark, table), buckets) if buckets else rows
    dealt.select(*map(quoted, spark.table(table).columns)).write.insertInto(table)


def overwrite_partitions(rows: DataFrame, table: str) -> None:
    """Replace the partitions that ``rows`` have by them; the rows may come from the table itself.

    Rows gather by bucket or partition first (``gathered``), lest each task write a file for each.
    """
    spark = rows.sparkSession
    columns, parts = spark.table(table).columns, partition_columns(spark, table)
    ordered = gathered(rows.select(*map(quoted, columns)), parts, bucketing(spark, table))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ordered.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def _partition_text(value: Any) -> str:
    if value is None:
        return "NULL"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def drop_partitions(spark: SparkSession, table: str, columns: Sequence[str], found: Sequence[Sequence[Any]]) -> None:
    """Remove partitions with their files, which Spark leaves where a table is external."""
    if not found:
        return
    inside = spark.table(table).where(is_one_of(columns, found))
    files = [r[0] for r in inside.select(F.col("_metadata.file_path")).distinct().collect()]
    for values in found:
        spec = ", ".join(f"{sql_name(c)} = {_partition_text(v)}" for c, v in zip(columns, values))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    for file in files:
        path = _path(spark, _decoded(spark, file))
        _store(spark, path).delete(path, False)
    spark.catalog.refreshTable(table)


# --- files ----------------------------------------------------------------------------------------


def _path(spark: SparkSession, name):
    """A path from its plain text or from a URI."""
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _store(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _decoded(spark: SparkSession, file: str) -> str:
    """A file's path as Hadoop writes it; Spark tells it with escapes."""
    return _path(spark, spark._jvm.java.net.URI(file)).toString()


def _read_text(spark: SparkSession, path) -> str:
    stream = _store(spark, path).open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path, text: str) -> None:
    """Write a small file under another name and rename it: it is there whole or not at all."""
    store, draft = _store(spark, path), _path(spark, f"{path.toString()}.draft")
    stream = store.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    store.rename(draft, path)


def _files_below(spark: SparkSession, path) -> list:
    found, store = [], _store(spark, path)
    listing = store.listFiles(path, True)
    while listing.hasNext():
        found.append(listing.next().getPath())
    return found


def _finish(spark: SparkSession, pending) -> None:
    """Swap in what a journal names; may be repeated from any point."""
    journal = json.loads(_read_text(spark, _path(spark, f"{pending.toString()}/{JOURNAL}")))
    store = _store(spark, pending)
    for source, goal in journal["moves"]:
        if store.exists(_path(spark, source)):
            store.rename(_path(spark, source), _path(spark, goal))
    for file in journal["gone"]:
        store.delete(_path(spark, file), False)
    store.delete(pending, True)


def recover(spark: SparkSession, table: str) -> int:
    """Finish rewrites of a table that were cut short, and forget those that never got their journal; how many."""
    location = _path(spark, details(spark, table)["location"])
    store, left = _store(spark, location), 0
    if not store.exists(location):
        return 0
    for status in store.listStatus(location):
        pending = status.getPath()
        if not pending.getName().startswith(PENDING):
            continue
        left += 1
        if store.exists(_path(spark, f"{pending.toString()}/{JOURNAL}")):
            _finish(spark, pending)
        else:
            store.delete(pending, True)
    if left:
        spark.catalog.refreshTable(table)
    return left


def drop_rows(
    spark: SparkSession,
    table: str,
    gone: Callable[[DataFrame], DataFrame],
    kept: Callable[[DataFrame], DataFrame],
    arrivals: DataFrame | None = None,
) -> list[str]:
    """Remove rows from a table of files by rewriting the files that hold some; returns the files replaced.

    ``gone`` and ``kept`` filter the table into the rows to remove and all others. The first runs over the
    whole table, but reads no more columns than it names; the second over the files concerned, without a
    shuffle of its own. Nothing else is read or moved. What the driver holds is the list of these files.
    ``arrivals`` come in with the same swap; a table with partitions takes none here. Rows of a bucketed
    table stay in their bucket, which a file's name tells.
    """
    recover(spark, table)
    parts = partition_columns(spark, table)
    if parts and arrivals is not None:
        raise ValueError(f"{table} has partitions: append rows to it apart")
    known = details(spark, table)
    location = known["location"].rstrip("/")
    target = spark.table(table).withColumn(FILE, F.col("_metadata.file_path"))
    concerned = gone(target).select(quoted(FILE).alias("file")).distinct().collect()
    files = sorted(r["file"] for r in concerned)
    if not files:
        if arrivals is not None:
            append(arrivals, table)
        return []
    pending = f"{location}/{PENDING}{uuid.uuid4().hex}"
    columns = [c for c in spark.table(table).columns if c not in parts]
    buckets = bucketing(spark, table)
    mark = F.hex(F.xxhash64(F.regexp_replace(quoted(FILE), "/[^/]*$", "")))
    home, fresh = F.lit(""), F.lit("")
    if buckets:
        home, fresh = F.regexp_extract(quoted(FILE), r"_(\d+)(?:\.[^/]*)?$", 1), F.lpad(buckets.of_row().cast("string"), 5, "0")
    rows = kept(target.where(quoted(FILE).isin(*files)))
    rows = rows.select(*map(quoted, columns), F.concat_ws("-", mark, home).alias(FOLDER))
    if arrivals is not None:
        dealt = gathered(arrivals.select(*map(quoted, columns)), [], buckets)
        rows = rows.unionByName(dealt.select("*", F.concat_ws("-", F.lit(NEW), fresh).alias(FOLDER)))
    writer = rows.write.format(known.get("provider", "parquet"))
    writer.partitionBy(FOLDER).save(f"{pending}/rows")
    folders = spark.createDataFrame([(f.rsplit("/", 1)[0],) for f in files], "folder string").distinct()
    goal = {r[0]: _decoded(spark, r[1]) for r in folders.select(F.hex(F.xxhash64("folder")), "folder").collect()}
    goal[NEW] = location
    moves = []
    for path in _files_below(spark, _path(spark, f"{pending}/rows")):
        folder = path.getParent().getName()
        if folder.startswith(f"{FOLDER}="):
            mark, bucket = folder.split("=", 1)[1].split("-")
            stem, end = path.getName().split(".", 1)
            moves.append((path.toString(), f"{goal[mark]}/{stem}{'_' + bucket if bucket else ''}.{end}"))
    journal = {"moves": moves, "gone": [_decoded(spark, f) for f in files]}
    _write_text(spark, _path(spark, f"{pending}/{JOURNAL}"), json.dumps(journal))
    _finish(spark, _path(spark, pending))
    spark.catalog.refreshTable(table)
    return journal["gone"]
