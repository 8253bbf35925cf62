"""Files, scripts, partitions, layout, JDBC calls."""

from collections import Counter
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dimweave.operators import apply
from dimweave.sources import catalog, files, jdbc
from dimweave.spec import LoadSpec


def test_result_round_trip_replaces_output(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_result(spark.range(5), path)
    files.write_result(spark.range(3), path)
    assert files.read_source(spark, path).count() == 3
    files.write_result(spark.range(3), str(tmp_path / "csv"), "csv")
    assert files.read_source(spark, str(tmp_path / "csv"), "csv", inferSchema="true").count() == 3


def test_stage_replaces_an_earlier_try(spark, tmp_path):
    first = files.stage(spark.range(5), str(tmp_path) + "/", "dim", 12)
    assert first.count() == 5
    again = files.stage(spark.range(2), str(tmp_path), "dim", 12)
    assert sorted(r.id for r in again.collect()) == [0, 1]
    assert (tmp_path / "TMP_dim_12").is_dir()


def test_script_with_comment_and_parameter(spark, tmp_path):
    script = tmp_path / "job.sql"
    script.write_text("SELECT id -- the key\nFROM range(10)\nWHERE id >= :low;\n")
    out = str(tmp_path / "out")
    catalog.run_sql_script(spark, str(script), out, params={"low": 7})
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [7, 8, 9]
    assert catalog.sql_script(spark, f"file://{script}", {"low": 9}).count() == 1


def test_partition_registration(spark, tmp_path):
    quoted = tmp_path / "it's here"
    for name, rows in (("day=1", 3), ("it's here", 4)):
        spark.range(rows).write.parquet(str(tmp_path / name))
    spark.sql("CREATE TABLE loads (id bigint, day string, kind string) USING parquet "
              f"PARTITIONED BY (day, kind) LOCATION '{tmp_path}/table'")  # fmt: skip
    try:
        catalog.add_partition(spark, "loads", {"day": 1, "kind": "a"}, str(tmp_path / "day=1"))
        catalog.add_partition(spark, "default.loads", {"day": 2, "kind": "b"}, str(quoted))
        catalog.add_partition(spark, "loads", {"day": 2, "kind": "b"}, str(tmp_path / "day=1"))
        counts = {r.day: r["count"] for r in spark.table("loads").groupBy("day").count().collect()}
        assert counts == {"1": 3, "2": 4}
    finally:
        spark.sql("DROP TABLE loads")


def test_history_table_layout(spark, tmp_path):
    path = str(tmp_path / "dim")
    df = spark.range(1000).select(
        (F.col("id") % 100).alias("dim"),
        F.when(F.col("id") % 5 == 0, "Y").otherwise("N").alias("CURRENT_IND"),
        F.col("id").alias("sid"),
    )
    files.write_scd_table(df, path, "dim")
    assert {p.name for p in (tmp_path / "dim").iterdir() if p.is_dir()} == {
        "CURRENT_IND=Y", "CURRENT_IND=N",
    }
    back = spark.read.parquet(path)
    assert Counter(back.select(*df.columns).collect()) == Counter(df.collect())
    plan = back.where("CURRENT_IND = 'Y'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(CURRENT_IND" in plan
    with pytest.raises(AnalysisException):
        files.write_scd_table(df, path, "dim")


def test_history_table_by_date_and_flag(spark, tmp_path):
    path = str(tmp_path / "dim")
    df = spark.range(60).selectExpr(
        "id AS dim", "if(id % 2 = 0, 'Y', 'N') AS CURRENT_IND", "date'2024-01-01' + int(id % 3) AS day"
    )
    files.write_scd_table(df, path, "dim", date_cols=["day"])
    assert len(list((tmp_path / "dim").rglob("*.parquet"))) == 6
    back = spark.read.parquet(path).where("day = '2024-01-02' AND CURRENT_IND = 'Y'")
    assert back.count() == 10
    assert (tmp_path / "dim" / "day=2024-01-02" / "CURRENT_IND=Y").is_dir()


def test_long_history_is_written_by_many_tasks(spark, tmp_path):
    """One key holds a third of the rows; its file is split all the same."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(0, 90000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("dim"),
            F.lit("N").alias("CURRENT_IND"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        path = str(tmp_path / "dim")
        files.write_scd_table(df, path, "dim")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = spark.read.parquet(path).where("dim = 0")
    per_file = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 30000 and max(per_file) <= 15000


def test_jdbc_read_calls():
    spark = MagicMock()
    with pytest.raises(ValueError, match="single_task"):
        jdbc.read_jdbc(spark, "jdbc:x", "t", {"user": "u"})
    jdbc.read_jdbc(spark, "jdbc:x", "t", {"user": "u"}, single_task=True)
    spark.read.jdbc.assert_called_with(
        "jdbc:x", "t", properties={"fetchsize": "10000", "user": "u"}
    )
    jdbc.read_jdbc(spark, "jdbc:x", "t", None, "id", 1, 100, 8)
    spark.read.jdbc.assert_called_with(
        "jdbc:x", "t", column="id", lowerBound="1", upperBound="100", numPartitions=8,
        properties={"fetchsize": "10000"},
    )
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:x", "t", partition_column="id")


def test_jdbc_read_asks_for_missing_bounds(spark):
    reader = MagicMock()
    reader.read.jdbc.return_value.agg.return_value.first.return_value = (3, 90)
    jdbc.read_jdbc(reader, "jdbc:x", "t", partition_column="id", num_partitions=4)
    assert reader.read.jdbc.call_args.kwargs["lowerBound"] == "3"
    assert reader.read.jdbc.call_args.kwargs["upperBound"] == "90"


def test_jdbc_write_calls():
    df = MagicMock()
    jdbc.append_jdbc(df, "jdbc:x", "t")
    df.write.mode.assert_called_with("append")
    df.write.mode.return_value.jdbc.assert_called_with(
        "jdbc:x", "t", properties={"batchsize": "10000"}
    )
    assert jdbc.stage_jdbc(df, "jdbc:x", "dim", 12, schema_owner="stg") == "stg.TMP_dim_12"
    df.write.mode.assert_called_with("overwrite")


def test_merge_is_left_to_capable_catalogs(spark):
    """A plain parquet table has no row-level operations: Spark says so, nothing is lost."""
    spark.sql("CREATE TABLE plain_dim (sid bigint) USING parquet")
    try:
        with pytest.raises(Exception, match="MERGE"):
            spec = LoadSpec("DIM", "Type1", "sid", "sid")
            apply.merge_type1(spark.range(2).toDF("sid"), "plain_dim", spec)
        feed = spark.sql("SELECT 1 AS sid, 'x' AS a, 'h' AS row_hash, now() AS effective_date,"
                         " now() AS end_date, true AS is_current, 1 AS version,"
                         " 'INSERT' AS merge_action")  # fmt: skip
        spark.sql("CREATE TABLE plain_hash (sid bigint, a string, row_hash string, effective_date"
                  " timestamp, end_date timestamp, is_current boolean, version int) USING parquet")
        with pytest.raises(Exception, match="MERGE"):
            apply.merge_scd2_hash(feed, "plain_hash", "sid", ["a"])
    finally:
        spark.sql("DROP TABLE IF EXISTS plain_dim")
        spark.sql("DROP TABLE IF EXISTS plain_hash")
