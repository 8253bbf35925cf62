"""What the plans look like: joins, pruning, skew."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from dimweave import LoadSpec
from dimweave import columns as C
from dimweave.examples import fixtures as X
from dimweave.examples import queries as registered
from dimweave.operators import cleanup, feeds, hash_scd2, joins, skew

SF_DIR = "/root/testdata/sf0.001"
LOAD = "2024-01-15 06:30:00"
ROWS = 240_000


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df):
    """Joins of the plan before adaptive execution, by type."""
    return re.findall(r"(?:HashJoin|SortMergeJoin) .*?(Inner|LeftOuter|LeftAnti|LeftSemi)", physical(df))


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_python_and_no_pairing_of_all_rows(spark, name):
    plan = physical(contract.queries()[name](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "NestedLoop", "Pandas"):
        assert node not in plan


def test_filter_and_columns_reach_the_scan(spark):
    plan = contract.queries()["scan_source"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_slice_reaches_both_scans(spark):
    orders = X.table(spark, SF_DIR, "orders")
    src, tgt = joins.slice_both(orders, orders, "o_orderstatus = 'F'")
    plan = physical(joins.new_keys(src, tgt, "o_orderkey"))
    assert len(re.findall(r"Scan parquet .*?DataFilters: \[.*?= F", plan)) == 2


def test_joins_per_feed(spark):
    queries = contract.queries()
    assert initial(queries["type1_upsert_feed"](spark, SF_DIR)) == ["LeftOuter"]
    assert initial(queries["type2_hybrid_feed"](spark, SF_DIR)) == ["LeftOuter"]
    assert initial(queries["type2_expire_rows"](spark, SF_DIR)) == ["Inner"]
    assert initial(queries["scd2_hash_changed"](spark, SF_DIR)) == ["LeftOuter"]
    assert initial(queries["cleanup_keep_latest"](spark, SF_DIR)) == []


def test_target_is_reduced_before_its_shuffle(spark):
    """Of the Type 1 attributes only a digest leaves the target's side."""
    feed = feeds.type2_hybrid_feed(
        X.type2_source(spark, SF_DIR), X.type2_target(spark, SF_DIR), X.CUSTOMER_TYPE2, LOAD
    )
    plan = physical(feed)
    assert "t__#digest1" in plan and "t__name" not in plan and "t__segment" not in plan


@pytest.fixture
def small_skew(spark):
    """Thresholds that make a third of a small table a skewed partition; no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def third(hot):
    """A third of the rows share one key."""
    return F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id"))


def moment():
    return F.lit("2023-01-01").cast("timestamp_ntz")


def final_plan(df):
    """Run the whole query and return the plan adaptive execution ended with."""
    total = df.select(F.count(F.lit(1)), F.max(F.struct(*df.columns)))
    rows = total.collect()[0][0]
    return rows, physical(total).split("Initial Plan")[0]


def test_long_history_is_split(spark, small_skew):
    spec = LoadSpec(
        "DIM", "Type2", "sid", "dim", scd_type1_attributes=("a",), scd_type2_attributes=("b",)
    )
    target = spark.range(0, ROWS, 1, 16).select(
        F.col("id").alias("sid"),
        third(0).alias("dim"),
        moment().alias(C.EFFECTIVE),
        moment().alias(C.EXPIRATION),
        F.when(F.col("id") % 3 == 0, "N").otherwise("Y").alias(C.CURRENT),
        F.md5(F.col("id").cast("string")).alias("a"),
        F.lit("b").alias("b"),
        F.lit("SEED").alias(C.INSERTED_BY),
        moment().alias(C.INSERTED_AT),
    )
    source = spark.range(0, ROWS, 1, 16).select(
        (F.col("id") + ROWS).alias("sid"),
        F.col("id").alias("dim"),
        F.lit("x").alias("a"),
        F.lit("b").alias("b"),
        F.lit(1).alias(C.BATCH_SID),
    )
    hot = skew.hot_keys(target, ["dim"], hot_rows=ROWS // 10)
    assert len(hot) == 1
    rows, plan = final_plan(feeds.type2_hybrid_feed(source, target, spec, LOAD, hot=hot))
    assert "SortMergeJoin(skew=true)" in plan
    # every version is overwritten, keys divisible by 3 other than 0 are new
    assert rows == ROWS + ROWS // 3 - 1


def test_hot_source_key_is_split(spark, small_skew):
    spec = LoadSpec("DIM", "Type1", "sid", "dim")
    source = spark.range(0, ROWS, 1, 16).select(
        third(0).alias("sid"),
        F.col("id").alias("dim"),
        F.md5(F.col("id").cast("string")).alias("a"),
        F.lit(1).alias(C.BATCH_SID),
    )
    target = spark.range(0, ROWS, 1, 16).select(
        F.col("id").alias("sid"),
        F.col("id").alias("dim"),
        F.lit("x").alias("a"),
        F.lit("SEED").alias(C.INSERTED_BY),
        moment().alias(C.INSERTED_AT),
    )
    rows, plan = final_plan(feeds.type1_upsert_feed(source, target, spec, LOAD))
    assert "SortMergeJoin(skew=true)" in plan and rows == ROWS
    current = target.select("sid", F.lit("h").alias(C.ROW_HASH), F.lit(True).alias(C.IS_CURRENT))
    changed = hash_scd2.scd2_hash_changed(source, current, "sid", ["a"], LOAD)
    rows, plan = final_plan(changed)
    assert "SortMergeJoin(skew=true)" in plan and rows == ROWS


def test_hot_source_key_meets_reduced_targets(spark, small_skew):
    """Anti and left joins against one row per key: the left side is split all the same."""
    source = spark.range(0, ROWS, 1, 16).select(
        third(-1).alias("s__dim"), F.md5(F.col("id").cast("string")).alias("s__a")
    )
    held = spark.range(0, ROWS, 1, 16).select((F.col("id") % 1000).alias("t__dim")).distinct()
    rows, plan = final_plan(joins.pair_reduced(source, held, "dim", "left_anti"))
    assert "SortMergeJoin(skew=true)" in plan and rows == ROWS - 666
    changed = source.select(F.col("s__dim").alias("dim"), F.col("s__a").alias("a"))
    target = spark.range(0, ROWS, 1, 16).select(third(-1).alias("dim"), F.lit(2).alias("version"))
    numbered = joins.next_version(changed, target, "dim")
    rows, plan = final_plan(numbered)
    assert "SortMergeJoin(skew=true)" in plan and rows == ROWS
    assert numbered.where("version = 3").count() == ROWS


def test_keys_of_unlike_types_still_match(spark):
    source = spark.createDataFrame([(1,), (3,)], "s__dim int")
    reduced = spark.sql("SELECT CAST(id AS decimal(10,2)) AS t__dim FROM range(1, 3)")
    assert joins.pair_reduced(source, reduced, "dim", "left_anti").collect() == [(3,)]
    loose = spark.createDataFrame([("A",), ("b",)], "s__dim string collate utf8_lcase")
    held = spark.createDataFrame([("a",)], "t__dim string collate utf8_lcase")
    assert joins.pair_reduced(loose, held, "dim", "left_anti").collect() == [("b",)]
    assert skew.hot_keys(loose, ["s__dim"], hot_rows=0) == []


@pytest.mark.parametrize("kept", [True, False])
def test_hot_key_of_a_cleanup_is_split(spark, small_skew, kept):
    """Half of the hot key's rows tie at its newest epoch."""
    df = spark.range(0, ROWS, 1, 16).select(
        third(0).alias("k"),
        F.when(F.col("id") % 6 == 0, 9).otherwise(F.col("id") % 7).alias("e"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    hot = skew.hot_keys(df, ["k"], hot_rows=ROWS // 10)
    assert len(hot) == 1
    run = cleanup.keep_latest_batch if kept else cleanup.stale_rows
    rows, plan = final_plan(run(df, ["k"], "e", hot=hot))
    assert "SortMergeJoin(skew=true)" in plan
    assert rows == (ROWS - ROWS // 6 if kept else ROWS // 6)


def test_writer_adds_no_sort(spark, tmp_path):
    """The layout's own order satisfies the partitioned writer."""
    from dimweave.sources import files

    df = spark.range(1000).selectExpr("id % 10 AS dim", "if(id % 2 = 0, 'Y', 'N') AS CURRENT_IND")
    wanted = df.hint("rebalance", "dim").sortWithinPartitions("CURRENT_IND", "dim")
    assert physical(wanted).count("Sort ") == 1
    files.write_scd_table(df, str(tmp_path / "t"), "dim")


def scans_and_shuffles(df):
    plan = physical(df)
    return len(re.findall(r"Scan parquet|FileScan parquet", plan)), plan.count("Exchange hashpartitioning")


def test_inputs_are_read_once(spark, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        queries = registered.queries()
        assert scans_and_shuffles(queries["next_version"](spark, SF_DIR))[0] <= 3
        assert scans_and_shuffles(queries["scd2_hash_feed"](spark, SF_DIR))[0] <= 5
        assert scans_and_shuffles(queries["cleanup_stale_rows"](spark, SF_DIR))[0] == 1
        assert scans_and_shuffles(queries["upsert_all_matched_feed"](spark, SF_DIR))[1] <= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_limit_does_not_rise_with_the_table(spark):
    few = spark.range(0, 4000).select(F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("k"))
    many = spark.range(0, 400_000).select(F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("k"))
    found = [skew.hot_keys(df, ["k"], hot_rows=1500) for df in (few, many)]
    assert found[0] == found[1] and len(found[0]) == 1


def test_long_history_is_one_row_in_the_type1_hybrid_feed(spark, small_skew):
    spec = LoadSpec("DIM", "Type2", "sid", "dim", scd_type1_attributes=("a",))
    source = spark.range(0, ROWS, 1, 16).select(
        F.col("id").alias("sid"), third(-1).alias("dim"), F.md5(F.col("id").cast("string")).alias("a"), F.lit(1).alias(C.BATCH_SID)
    )
    target = spark.range(0, ROWS, 1, 16).select(F.col("id").alias("sid"), third(-1).alias("dim"), F.lit("x").alias("a"))
    rows, plan = final_plan(feeds.type1_hybrid_feed(source, target, spec, LOAD))
    assert "SortMergeJoin(skew=true)" in plan and rows == ROWS
    rows, plan = final_plan(joins.new_keys(source.drop("sid"), target.select("dim").where("dim > 0"), "dim"))
    assert "SortMergeJoin(skew=true)" in plan
