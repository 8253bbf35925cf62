"""Loads from catalog table to catalog table."""

from datetime import datetime

import pytest

from dimweave import LoadSpec
from dimweave.plans.load import load_table

LOAD = "2024-01-15 06:30:00"
AUDIT = (
    "INSERTED_BY_USER_NAME varchar(10), INSERTED_UTC_DATETIME timestamp,"
    " UPDATED_BY_USER_NAME varchar(10), UPDATED_UTC_DATETIME timestamp, ETL_BATCH_SID int,"
    " BATCH_LOAD_EPOCH bigint"
)


@pytest.fixture
def tables(spark):
    spark.sql("CREATE TABLE src (sid bigint, dim string, a string, b string, ETL_BATCH_SID int)"
              " USING parquet")  # fmt: skip
    spark.sql("INSERT INTO src VALUES (1, 'A', 'long text', 'q', 9), (2, 'B', 'x', 'p', 9)")
    spark.sql(f"CREATE TABLE fact (dim string, a varchar(4), {AUDIT}) USING parquet")
    spark.sql(f"CREATE TABLE plain (sid bigint, dim string, a varchar(4), {AUDIT}) USING parquet")
    spark.sql("CREATE TABLE history (sid bigint, dim string, EFFECTIVE_DATETIME timestamp,"
              " EXPIRATION_DATETIME timestamp, CURRENT_IND char(1), a string, b string,"
              f" {AUDIT}) USING parquet")  # fmt: skip
    spark.sql("INSERT INTO history VALUES (10, 'A', timestamp'2023-01-01', NULL, 'Y', 'x', 'p',"
              " 'SEED', timestamp'2023-01-01', NULL, NULL, 1, 1)")  # fmt: skip
    yield
    for name in ("src", "fact", "plain", "history"):
        spark.sql(f"DROP TABLE {name}")


def test_fact_is_appended_in_place(spark, tables):
    spec = LoadSpec("FACT", source_table="src", target_table="fact")
    load_table(spark, spec, LOAD, 77, predicate="sid = 1")
    load_table(spark, spec, LOAD, 78)
    rows = spark.table("fact").collect()
    assert sorted((r.dim, r.a, r.BATCH_LOAD_EPOCH) for r in rows) == [
        ("A", "long", 77), ("A", "long", 78), ("B", "x", 78),
    ]
    assert {r.INSERTED_UTC_DATETIME for r in rows} == {datetime(2024, 1, 15, 6, 30)}


def test_type1_snapshot(spark, tables, tmp_path):
    spec = LoadSpec("DIM", "Type1", "sid", "dim", source_table="src", target_table="plain")
    path = str(tmp_path / "next")
    load_table(spark, spec, LOAD, 77, path, stage_dir=str(tmp_path))
    rows = spark.read.parquet(path).collect()
    assert sorted((r.sid, r.a, r.BATCH_LOAD_EPOCH) for r in rows) == [(1, "long", 77), (2, "x", 77)]


def test_type2_snapshot(spark, tables, tmp_path):
    spec = LoadSpec(
        "DIM", "Type2", "sid", "dim", scd_type2_attributes=("b",),
        source_table="src", target_table="history",
    )
    path = str(tmp_path / "next")
    load_table(spark, spec, LOAD, 77, path, stage_dir=str(tmp_path))
    rows = spark.read.parquet(path).collect()
    assert sorted((r.sid, r.CURRENT_IND, r.a, r.b, r.INSERTED_BY_USER_NAME) for r in rows) == [
        (1, "Y", "long text", "q", "ETL"),
        (2, "Y", "x", "p", "ETL"),
        (10, "N", "long text", "p", "SEED"),
    ]
    closed = next(r for r in rows if r.sid == 10)
    assert closed.EXPIRATION_DATETIME == datetime(2024, 1, 15, 6, 30)  # half past midnight in Chicago


def test_dimension_is_loaded_into_its_table(spark, tables, tmp_path):
    spec = LoadSpec("DIM", "Type1", "sid", "dim", source_table="src", target_table="plain")
    old = load_table(spark, spec, LOAD, 77, stage_dir=str(tmp_path))
    rows = spark.table("plain").collect()
    assert sorted((r.sid, r.a, r.BATCH_LOAD_EPOCH) for r in rows) == [(1, "long", 77), (2, "x", 77)]
    assert old and not list(tmp_path.iterdir())  # what was staged is gone
    load_table(spark, spec, "2024-02-01 00:00:00", 78)
    assert sorted(spark.table("plain").collect()) == sorted(rows)


def test_partitioned_history_is_switched(spark, tables):
    from dimweave.plans.load import switch_table

    spark.sql("CREATE TABLE parted (k int, p string) USING parquet PARTITIONED BY (p)")
    try:
        spark.sql("INSERT INTO parted VALUES (1, 'a'), (2, 'b')")
        following = spark.table("parted").selectExpr("k + 10 AS k", "if(k = 1, 'c', p) AS p")
        switch_table(spark, following, "parted")
        assert sorted(map(tuple, spark.table("parted").collect())) == [(11, "c"), (12, "b")]
        spark.sql("INSERT INTO parted VALUES (3, 'd')")
        assert spark.table("parted").where("p = 'd'").count() == 1
    finally:
        spark.sql("DROP TABLE parted")


def test_cleanup_and_hash_history_end_in_their_tables(spark, tables):
    from dimweave.plans.load import cleanup_table, load_history_table

    spark.sql("CREATE TABLE loads (k int, v string, BATCH_LOAD_EPOCH bigint) USING parquet")
    spark.sql("CREATE TABLE hist (dim string, a string, row_hash string, effective_date timestamp_ntz,"
              " end_date timestamp_ntz, is_current boolean, version int, note string) USING parquet")  # fmt: skip
    try:
        spark.sql("INSERT INTO loads VALUES (1, 'old', 1), (1, 'new', 2), (2, 'only', 1)")
        cleanup_table(spark, LoadSpec("FACT", primary_key=("k",), target_table="loads"))
        assert sorted(r.v for r in spark.table("loads").collect()) == ["new", "only"]
        for text in ("x", "x", "y"):
            source = spark.createDataFrame([("A", text)], "dim string, a string")
            load_history_table(spark, source, "hist", "dim", ["a"], LOAD)
        rows = spark.table("hist").collect()
        assert sorted((r.a, r.version, r.is_current, r.note) for r in rows) == [
            ("x", 1, False, None), ("y", 2, True, None),
        ]
    finally:
        for name in ("loads", "hist"):
            spark.sql(f"DROP TABLE {name}")
