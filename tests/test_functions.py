"""Hashes, keys, casts."""

import hashlib
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import models
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, ArithmeticException
from pyspark.sql import functions as F

from dimweave.functions import hashing
from dimweave.operators.conform import conform
from dimweave.operators.keys import with_surrogate_key

CHECKED = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_normalised_hash(spark):
    df = spark.createDataFrame([("  Ab ", None, 5), ("aB", "", 5)], "x string, y string, z int")
    first, second = df.select(hashing.hash_norm(["x", "y", "z"])).collect()
    assert first[0] == second[0] == hashlib.md5(b"AB*#**#*5").hexdigest()


def test_only_spaces_are_trimmed(spark):
    df = spark.createDataFrame([("\ta",)], "x string")
    assert df.select(hashing.norm_text("x")).first()[0] == "\tA"


def test_raw_hash_is_null_with_any_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    first, second = df.select(hashing.hash_raw(["x", "y"])).collect()
    assert first[0] is None and second[0] == hashlib.md5(b"a*#*b").hexdigest()


def test_row_hash(spark):
    df = spark.createDataFrame([("a", None, 2)], "x string, y string, z int")
    got = df.select(hashing.row_hash(["x", "y", "z"])).first()[0]
    assert got == hashlib.sha256(b"a||2").hexdigest()


def test_row_hash_algorithms(spark):
    df = spark.createDataFrame([("a",)], "x string")
    md5, xxh64 = df.select(
        hashing.row_hash(["x"], hashing.MD5), hashing.row_hash(["x"], hashing.XXH64)
    ).first()
    assert md5 == hashlib.md5(b"a").hexdigest()
    assert xxh64 == xxhash.xxh64(b"a", seed=42).hexdigest()
    with pytest.raises(ValueError):
        hashing.row_hash(["x"], "crc32")


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([("a",)], "`x.y z` string")
    assert df.select(hashing.row_hash(["x.y z"])).first()[0] == hashlib.sha256(b"a").hexdigest()


@CHECKED
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=30))
def test_surrogate_key_equals_model(spark, texts):
    texts = [t and t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.sid for r in with_surrogate_key(df, ["x"], "sid").select("sid").collect()]
    assert got == [models.sid64(t) for t in texts]


def test_surrogate_key_of_blank_parts_is_zero(spark):
    df = spark.createDataFrame([(None, ""), ("", "a"), ("a", "")], "x string, y string")
    zero, second, first = (r.sid for r in with_surrogate_key(df, ["x", "y"], "sid").collect())
    assert zero == 0 and second != first
    assert first == models.sid64("a*#*")


def test_conform_cuts_pads_and_orders(spark):
    df = spark.createDataFrame(
        [("abcdef", "ab", 1.127, "7", 1)], "v string, c string, d double, i string, x int"
    )
    row = conform(df, "i int, v varchar(3), c char(4), d decimal(5,2)").first()
    assert row.asDict() == {"i": 7, "v": "abc", "c": "ab  ", "d": Decimal("1.13")}
    assert list(row.asDict()) == ["i", "v", "c", "d"]


def test_conform_overflow(spark):
    df = spark.createDataFrame([(12345.6,)], "d double")
    with pytest.raises(ArithmeticException):
        conform(df, "d decimal(5,2)").collect()
    assert conform(df, "d decimal(5,2)", on_overflow="null").first().d is None
    with pytest.raises(ValueError):
        conform(df, "d decimal(5,2)", on_overflow="clip")


def test_conform_misses_a_column(spark):
    with pytest.raises(AnalysisException):
        conform(spark.range(1), "other int")


def test_conform_reads_lengths_of_a_catalog_table(spark):
    spark.sql("CREATE TABLE sized (v varchar(2), c char(3), n decimal(4,1)) USING parquet")
    try:
        df = spark.createDataFrame([("abc", "z", 7)], "v string, c string, n int")
        row = conform(df, spark.table("sized").schema).first()
    finally:
        spark.sql("DROP TABLE sized")
    assert (row.v, row.c, float(row.n)) == ("ab", "z  ", 7.0)


def test_changed_tests(spark):
    df = spark.createDataFrame([("a", " A"), ("a", None), ("a", "b")], "x string, y string")
    rows = df.select(
        hashing.changed_md5(["x"], ["y"]),
        hashing.unchanged_md5(["x"], ["y"]),
        hashing.changed_md5_raw(["x"], ["y"]),
        hashing.changed_sha2("x", "y"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (False, True, True, True), (True, False, None, True), (True, False, True, True),
    ]


def test_digest_is_the_hash_in_bytes(spark):
    row = spark.range(1).select(
        hashing.digest_norm([F.lit("a")]).alias("d"), hashing.hash_norm([F.lit("a")]).alias("h")
    )
    first = row.first()
    assert bytes(first.d).hex() == first.h


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_load_time_and_stamps_in_any_session_zone(spark, zone):
    from dimweave.functions.clock import instant_of, utc_time
    from dimweave.operators.conform import conform, wall_stamps

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        wanted = datetime(2024, 3, 9, 23, 30)
        aware = datetime(2024, 3, 9, 18, 30, tzinfo=timezone(timedelta(hours=-5)))
        column = F.timestamp_seconds(F.lit(1710027000))
        given = [
            "2024-03-09 23:30:00", "2024-03-09T18:30:00-05:00", aware, column, F.lit("2024-03-09T23:30:00Z"),
            F.lit("2024-03-10 05:00:00 +05:30"), F.lit("2024-03-09 23:30:00"), F.lit("2024-03-09 23:30:00").cast("timestamp_ntz"),
        ]
        row = spark.range(1).select(*[utc_time(x).alias(f"c{i}") for i, x in enumerate(given)]).first()
        assert set(row) == {wanted}
        # in the hour that New York's clocks show twice, too
        odd = spark.range(1).select(F.timestamp_micros(F.lit(1730611800123456)).alias("t"))
        back = odd.select(F.unix_micros(instant_of(utc_time(F.col("t")))).alias("m")).first()
        assert back.m == 1730611800123456
        stamps = spark.range(1).select(
            utc_time(wanted.isoformat(" ")).alias("INSERTED_UTC_DATETIME"), F.lit("2024-03-09 17:30:00").cast("timestamp_ntz").alias("EXPIRATION_DATETIME")
        )
        stored = conform(stamps, "INSERTED_UTC_DATETIME timestamp, EXPIRATION_DATETIME timestamp")
        seconds = stored.select(F.unix_timestamp("INSERTED_UTC_DATETIME"), F.unix_timestamp("EXPIRATION_DATETIME")).first()
        assert tuple(seconds) == (1710027000, 1710027000)
        assert wall_stamps(stored).first() == stamps.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
