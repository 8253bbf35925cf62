"""File sources, results, staged feeds and the layout of history tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dimweave import columns as C
from dimweave.functions.hashing import quoted
from dimweave.operators.joins import Keys, key_list

DEFAULT_FORMAT = "parquet"


def read_source(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    columns: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """A load source. ``fmt='avro'`` needs the spark-avro package on the cluster."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(*map(quoted, columns)) if columns else df


def write_result(
    df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite"
) -> None:
    df.write.format(fmt).mode(mode).save(path)


def staging_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for intermediate results, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the place all executors share, removed when the driver ends.

    That is the folder in ``spark.checkpoint.dir``, or the warehouse where none is named.
    """
    base = staging_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{uuid.uuid4().hex}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return str(store.makeQualified(path).toString())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged_path(directory: str, target: str, batch_id: str | int) -> str:
    return f"{directory.rstrip('/')}/TMP_{target}_{batch_id}"


def stage(
    feed: DataFrame, directory: str, target: str, batch_id: str | int, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """Write a feed to its batch's staging folder, replacing an earlier try, and read it back.

    An apply uses its feed more than once; from here on that is a scan, not the feed's joins again,
    and it outlives the loss of the executors that computed it.
    """
    path = staged_path(directory, target, batch_id)
    write_result(feed, path, fmt)
    return feed.sparkSession.read.schema(feed.schema).format(fmt).load(path)


def write_scd_table(
    df: DataFrame,
    path: str,
    keys: Keys,
    flag_col: str = C.CURRENT,
    date_cols: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    mode: str = "errorifexists",
) -> None:
    """Write a history table partitioned by its current flag, below dates if given, sorted by key.

    Rebalancing, unlike a repartition by key, lets adaptive execution size the files and split a key
    with a very long history. With dates rows gather by partition, lest every task write a file per
    date. Sorting by partition first is the order the partitioned writer needs, so it adds no sort
    of its own; sorting by key gives narrow key ranges per row group.
    """
    names, parts = key_list(keys), [*date_cols, flag_col]
    spread = parts if date_cols else [*parts, *names]
    (
        df.hint("rebalance", *spread)
        .sortWithinPartitions(*parts, *names)
        .write.format(fmt)
        .mode(mode)
        .partitionBy(*parts)
        .save(path)
    )


def write_bucketed_table(
    df: DataFrame,
    table: str,
    keys: Keys,
    buckets: int,
    parts: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    **options: str,
) -> None:
    """Write a catalog table whose rows lie in ``buckets`` by their key, sorted by it.

    Joins on the key then find the rows where they are: only the other side is shuffled, load after load
    (``sources.rewrite`` keeps the layout). A bucket of a partition should fill a file. A row's bucket
    follows from the key's type too, so the key is of one type on both sides of a join.
    """
    names = key_list(keys)
    dealt = df.repartition(buckets, *map(quoted, names)).sortWithinPartitions(*parts, *map(quoted, names))
    writer = dealt.write.format(fmt).options(**options).bucketBy(buckets, *names).sortBy(*names)
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)
