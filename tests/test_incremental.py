"""Key filters, epoch indexes and free surrogate keys."""

import random
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from dimweave import LoadSpec
from dimweave.functions.hashing import surrogate_key
from dimweave.operators import checks, conform, epoch_index, joins, key_filter, keys
from dimweave.plans import load
from dimweave.sources import files, jdbc

LOAD = "2024-01-15 06:30:00"


# --- key filter -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 42, 43, 20_000])
def test_no_key_is_lost_and_few_others_pass(spark, n):
    names = ["k", "name"]
    src = spark.range(n).selectExpr("id * 7 AS k", "concat('n', id) AS name")
    tgt = spark.range(200_000).selectExpr("id AS k", "concat('n', id DIV 7) AS name", "'x' AS payload")
    tgt = tgt.union(spark.createDataFrame([(None, "n1", "y"), (7, None, "y")], "k long, name string, payload string"))
    passed = key_filter.possibly_held(tgt, src, names, n)
    assert passed.columns == tgt.columns
    held = passed.join(src, names, "left_semi").count()
    assert held == tgt.join(src, names, "left_semi").count() == min(n, 28_572)
    assert passed.count() - held <= 0.02 * 200_000
    assert passed.where("payload = 'y'").count() == 0


def test_blocks():
    assert [key_filter.blocks_for(n) for n in (0, 1, 42, 43, 85, 86, 10**6)] == [1, 1, 1, 2, 2, 4, 32768]


def test_the_filter_stands_below_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(checks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(checks, "FILTERED_BYTES", 0)
    src = spark.range(500).selectExpr("id * 40 AS sid", "id * 40 AS dim")
    tgt = spark.range(20_000).selectExpr("id AS sid", "id AS dim", "'x' AS a")
    profile = checks.require_unique(src, "sid")
    assert profile.keys == 500 and not profile.broadcastable
    near = checks.held_by(tgt, src, "sid", profile)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan
    assert 500 <= near.count() <= 500 + 0.02 * 20_000
    # Keys of other types, too many keys and small targets are left to the join.
    assert checks.held_by(tgt, src.selectExpr("CAST(sid AS int) AS sid"), "sid", profile) is tgt
    monkeypatch.setattr(key_filter, "MOST_BLOCKS", 1)
    assert checks.held_by(tgt, src, "sid", profile) is tgt
    monkeypatch.setattr(checks, "FILTERED_BYTES", 1 << 60)
    assert checks.held_by(tgt, src, "sid", profile) is tgt


def test_a_load_is_the_same_with_the_filter(spark, monkeypatch, tmp_path):
    from dimweave.examples import fixtures as X

    sf = "/root/testdata/sf0.001"
    source, target = X.type2_source(spark, sf).where("cust_id % 3 = 0"), X.type2_target(spark, sf)
    want = load.run_load(X.CUSTOMER_TYPE2, source, target, X.LOAD_TS, X.EPOCH, check_keys=False).snapshot.collect()
    monkeypatch.setattr(checks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(checks, "FILTERED_BYTES", 0)
    got = load.run_load(X.CUSTOMER_TYPE2, source, target, X.LOAD_TS, X.EPOCH, stage_dir=str(tmp_path)).snapshot.collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


# --- epoch index ----------------------------------------------------------------------------------

SPEC = LoadSpec("FACT", primary_key=("k", "j"), target_table="loads")


def test_batches_by_index_equal_the_whole_cleanup(spark):
    rng = random.Random(3)
    spark.sql("CREATE TABLE loads (k int, j string, v int, BATCH_LOAD_EPOCH bigint) USING parquet")
    schema, every = spark.table("loads").schema, []
    try:
        load.build_epoch_index(spark, SPEC, "loads_index", 2)
        for number in range(5):
            batch = []
            for v in range(40):
                epoch = rng.choice([number, number, number + 1, max(0, number - 2), None])
                batch.append((rng.choice([None, *range(25)]), rng.choice("ab"), 100 * number + v, epoch))
            every += batch
            rows = spark.createDataFrame(batch, schema)
            rows.write.insertInto("loads")
            load.cleanup_batch(spark, SPEC, rows, "loads_index")
            newest = {}
            for k, j, _, epoch in every:
                if k is not None and epoch is not None:
                    newest[k, j] = max(epoch, newest.get((k, j), epoch))
            want = sorted(r for r in every if r[3] is not None and newest.get((r[0], r[1])) == r[3])
            assert sorted(map(tuple, spark.table("loads").collect())) == want
            index = {(r.k, r.j): r.newest_epoch for r in spark.table("loads_index").collect()}
            assert index == newest
    finally:
        spark.sql("DROP TABLE loads")
        spark.sql("DROP TABLE IF EXISTS loads_index")


def test_a_batch_of_new_keys_does_not_touch_the_table(spark, monkeypatch):
    spark.sql("CREATE TABLE loads (k int, j string, v int, BATCH_LOAD_EPOCH bigint) USING parquet")
    try:
        spark.sql("INSERT INTO loads VALUES (1, 'a', 1, 1)")
        load.build_epoch_index(spark, SPEC, "loads_index", 2)
        batch = spark.createDataFrame([(2, "a", 2, 2), (2, "a", 3, 2)], spark.table("loads").schema)
        batch.write.insertInto("loads")
        with monkeypatch.context() as only:
            only.setattr(load, "drop_rows", None)
            assert load.cleanup_batch(spark, SPEC, batch, "loads_index") == []
        assert spark.table("loads").count() == 3 and spark.table("loads_index").count() == 2
        empty = batch.where("false")
        assert load.cleanup_batch(spark, SPEC, empty, "loads_index") == []
    finally:
        spark.sql("DROP TABLE loads")
        spark.sql("DROP TABLE IF EXISTS loads_index")


def test_only_the_batch_side_is_shuffled(spark):
    index = spark.range(1000).selectExpr("CAST(id AS int) AS k", "'a' AS j", "id AS newest_epoch")
    files.write_bucketed_table(index, "loads_index", ["k", "j"], 8)  # as many as shuffle partitions
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.createDataFrame([(1, "a", 5)], "k int, j string, BATCH_LOAD_EPOCH bigint")
        found = epoch_index.batch_epochs(batch, spark.table("loads_index"), ["k", "j"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert [tuple(r) for r in found.collect()] == [(1, "a", 5, True, False)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE loads_index")


# --- free keys ------------------------------------------------------------------------------------


def short(bits):
    return lambda cols: surrogate_key(cols).bitwiseAND(F.lit((1 << bits) - 1))


def test_inserts_get_keys_of_their_own(spark, tmp_path):
    target = spark.range(60).selectExpr("id * 3 AS sid", "concat('t', id) AS dim")
    feed = spark.range(100).selectExpr("concat('d', id) AS dim", "'I' AS action_flag")
    feed = keys.with_surrogate_key(feed, ["dim"], "sid", short(8))
    more = spark.createDataFrame([("t1", "U", 3), ("t2", "U", 6), ("none", "I", None)], "dim string, action_flag string, sid bigint")
    feed = feed.unionByName(more)
    kept = []

    def keep(df, number):
        kept.append(number)
        return files.stage(df, str(tmp_path), "feed", number)

    done = keys.with_free_keys(feed, target, "sid", "dim", keep, short(8)).collect()
    assert len(kept) > 2  # some were taken
    inserted = [r.sid for r in done if r.action_flag == "I" and r.sid is not None]
    assert len(inserted) == len(set(inserted)) == 100
    assert not set(inserted) & {3 * i for i in range(60)}
    assert sorted((r.dim, r.sid) for r in done if r.action_flag == "U") == [("t1", 3), ("t2", 6)]
    assert [r.sid for r in done if r.dim == "none"] == [None]
    again = keys.with_free_keys(feed.repartition(3), target, "sid", "dim", keep, short(8)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, done))


def test_no_room_for_keys(spark):
    feed = keys.with_surrogate_key(spark.range(20).selectExpr("id AS dim", "'I' AS action_flag"), ["dim"], "sid", short(2))
    target = spark.createDataFrame([], "sid bigint")
    with pytest.raises(RuntimeError, match="still taken"):
        keys.with_free_keys(feed, target, "sid", "dim", lambda df, n: spark.createDataFrame(df.collect(), df.schema), short(2))


def test_scarce_keys_are_all_found(spark, tmp_path):
    """As many inserts as there are free keys: the last ones are not found by one new key a round."""
    bits, held = 8, 60
    target = spark.range(held).selectExpr("id * 2 AS sid")
    feed = spark.range((1 << bits) - held).selectExpr("concat('d', id) AS dim", "'I' AS action_flag", "id AS v")
    feed = keys.with_surrogate_key(feed, ["dim"], "sid", short(bits))

    def keep(df, number):
        return files.stage(df, str(tmp_path), "feed", number)

    done = keys.with_free_keys(feed, target, "sid", "dim", keep, short(bits)).collect()
    assert sorted(r.sid for r in done) == sorted(set(range(1 << bits)) - {2 * i for i in range(held)})
    assert sorted((r.dim, r.v) for r in done) == sorted((f"d{i}", i) for i in range((1 << bits) - held))


def test_a_load_with_clashing_keys(spark, tmp_path):
    target = spark.sql(
        "SELECT id AS sid, concat('d', id) AS dim, timestamp_ntz'2023-01-01' AS EFFECTIVE_DATETIME, CAST(NULL AS timestamp_ntz) AS EXPIRATION_DATETIME,"
        " 'Y' AS CURRENT_IND, 'x' AS a, 'p' AS b, 'S' AS INSERTED_BY_USER_NAME, timestamp_ntz'2023-01-01' AS INSERTED_UTC_DATETIME,"
        " CAST(NULL AS string) AS UPDATED_BY_USER_NAME, CAST(NULL AS timestamp_ntz) AS UPDATED_UTC_DATETIME, 1 AS ETL_BATCH_SID FROM range(40)"
    )
    source = spark.sql("SELECT concat('d', id) AS dim, 'x' AS a, if(id < 20, 'q', 'p') AS b, 9 AS ETL_BATCH_SID FROM range(60)")
    spec = LoadSpec("DIM", "Type2", "sid", "dim", scd_type2_attributes=("b",))
    options = {"sid_from": ["dim", "ETL_BATCH_SID"], "key_generator": short(7), "stage_dir": str(tmp_path)}
    result = load.run_load(spec, source, target, LOAD, **options)
    rows = result.snapshot.collect()
    assert len(rows) == 80 and len({r.sid for r in rows}) == 80
    once = load.run_load(spec, source, target, LOAD, **{**options, "key_generator": surrogate_key})
    assert len(once.staged) == 2  # the feed, and that no key was taken
    result.release(spark)
    once.release(spark)
    assert not list(tmp_path.iterdir())


# --- rejects --------------------------------------------------------------------------------------


def test_rows_that_do_not_fit_come_with_their_columns(spark, tmp_path):
    rows = [("1", "x", 1.5, "2024-01-01"), ("no", "y", 1.5, "never"), ("3", "long text", 1e9, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "k string, v string, n double, d string")
    schema = "k int NOT NULL, v varchar(4), n decimal(5,2), d date"
    fit, rejected = conform.split_fit(df, schema, lambda d: files.stage(d, str(tmp_path), "told", 1))
    assert [(r.k, r.v, str(r.n), str(r.d)) for r in fit.collect()] == [(1, "x", "1.50", "2024-01-01")]
    assert sorted((r.k or "", r.reject_reason) for r in rejected.collect()) == [("", "k"), ("3", "n"), ("no", "k, d")]
    assert rejected.columns == [*df.columns, "reject_reason"]


@pytest.mark.parametrize("kind", ["DIM", "FACT"])
def test_a_load_rejects_what_does_not_fit(spark, tmp_path, kind):
    audit = ("INSERTED_BY_USER_NAME string, INSERTED_UTC_DATETIME timestamp, UPDATED_BY_USER_NAME string,"
             " UPDATED_UTC_DATETIME timestamp, ETL_BATCH_SID int, BATCH_LOAD_EPOCH bigint")  # fmt: skip
    spark.sql(f"CREATE TABLE tgt (sid bigint, dim string, n decimal(5,2), {audit}) USING parquet")
    spark.createDataFrame([(1, "A", 1e9, 9), (2, "B", 2.5, 9)], "sid bigint, dim string, n double, ETL_BATCH_SID int").createOrReplaceTempView("src")
    spec = LoadSpec(kind, "Type1", "sid", "dim", source_table="src", target_table="tgt")
    try:
        load.load_table(spark, spec, LOAD, 7, reject_path=str(tmp_path / "rejected"), stage_dir=str(tmp_path / "stage"))
        assert [(r.sid, str(r.n)) for r in spark.table("tgt").collect()] == [(2, "2.50")]
        rejected = spark.read.parquet(str(tmp_path / "rejected")).collect()
        assert [(r.sid, r.n, r.reject_reason) for r in rejected] == [(1, 1e9, "n")]
        assert not list((tmp_path / "stage").iterdir())
    finally:
        spark.sql("DROP TABLE tgt")
        spark.catalog.dropTempView("src")


# --- slices, ranges -------------------------------------------------------------------------------


def test_the_source_prunes_the_targets_partitions(spark):
    rows = spark.range(300).selectExpr("id", "if(id % 10 = 0, NULL, CAST(id % 10 AS int)) AS p")
    rows.write.partitionBy("p").saveAsTable("parted")
    spark.sql("CREATE TABLE wanted (p int, v int) USING parquet")
    spark.sql("INSERT INTO wanted VALUES (3, 1), (4, 1), (5, 0), (NULL, 1), (99, 1)")
    try:
        src, tgt = spark.table("wanted").where("v = 1"), spark.table("parted")
        found = joins.slice_of_source(src, tgt, "p")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan
        assert sorted(r.id for r in found.collect()) == [i for i in range(300) if i % 10 in (0, 3, 4)]
        assert found.columns == tgt.columns
    finally:
        spark.sql("DROP TABLE parted")
        spark.sql("DROP TABLE wanted")


def test_ranges_of_a_skewed_column(spark):
    rows = spark.range(20_000).selectExpr("CAST(pow(2, id / 1250) AS bigint) * 1000 + id AS k")
    rows = rows.union(spark.range(50).selectExpr("CAST(NULL AS bigint)"))
    found = jdbc.depth_predicates(rows, "k", 8)
    sizes = [rows.where(p).count() for p in found]
    assert len(sizes) == 8 and sum(sizes) == 20_050
    assert max(sizes) <= 2 * min(sizes)
    hot = spark.range(1000).selectExpr("if(id < 900, 7, id) AS k")
    parts = jdbc.depth_predicates(hot, "k", 4)
    assert sum(hot.where(p).count() for p in parts) == 1000
    assert jdbc.depth_predicates(rows.where("k IS NULL"), "k", 4) == ["1 = 1"] == jdbc.depth_predicates(rows, "k", 1)
    days = spark.sql("SELECT date_add(date'2024-01-01', CAST(id AS int)) AS d, timestamp_seconds(id) AS t FROM range(100)")
    for column in ("d", "t"):
        assert sum(days.where(p).count() for p in jdbc.depth_predicates(days, column, 5)) == 100
    with pytest.raises(ValueError, match="no ranges"):
        jdbc._literal("text")


def test_even_jdbc_read_calls(spark):
    reader = MagicMock()
    reader.read.jdbc.return_value.select.return_value = spark.range(100).withColumnRenamed("id", "k")
    jdbc.read_jdbc_evenly(reader, "jdbc:x", "t", "k", 2, lower_bound=0, upper_bound=99)
    first, second = reader.read.jdbc.call_args_list
    assert first.kwargs["column"] == "k" and first.kwargs["numPartitions"] == 2
    low, high = second.kwargs["predicates"]
    assert low.endswith("OR k IS NULL") and high.startswith("k >= ")
