"""Loads and cleanups that leave alone what they do not touch."""

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from dimweave import LoadSpec
from dimweave.operators import apply, cleanup
from dimweave.plans import load, publish
from dimweave.plans.load import cleanup_table, load_history_table, load_table
from dimweave.sources import rewrite
from dimweave.sources.files import remove, write_bucketed_table

AUDIT = (
    "INSERTED_BY_USER_NAME string, INSERTED_UTC_DATETIME timestamp_ntz, UPDATED_BY_USER_NAME string,"
    " UPDATED_UTC_DATETIME timestamp_ntz, ETL_BATCH_SID int, BATCH_LOAD_EPOCH bigint"
)
SEED = "'SEED', timestamp_ntz'2023-01-01', NULL, NULL, 1, CAST(1 AS bigint)"
LOAD = "2024-01-15 06:30:00"
TYPE1 = LoadSpec("DIM", "Type1", "sid", "dim", source_table="src", target_table="tgt")
TYPE2 = LoadSpec("DIM", "Type2", "sid", "dim", scd_type2_attributes=("b",), source_table="src", target_table="tgt")


@pytest.fixture
def sql(spark):
    made = []

    def run(text):
        if text.startswith("CREATE TABLE"):
            made.append(text.split()[2])
        return spark.sql(text)

    yield run
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def files(spark, table):
    found = spark.table(table).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {r.f for r in found}


def source(sql, rows):
    sql("CREATE TABLE src (sid bigint, dim string, a string, b string, ETL_BATCH_SID int) USING parquet")
    sql(f"INSERT INTO src VALUES {rows}")


def partitioned(sql, rows, part="b"):
    sql(f"CREATE TABLE tgt (sid bigint, dim string, a string, {AUDIT}, {part} string) USING parquet PARTITIONED BY ({part})")
    for row in rows:
        sid, dim, a, b = row
        sql(f"INSERT INTO tgt VALUES ({sid}, '{dim}', '{a}', {SEED}, {b})")


def shown(spark):
    return sorted(((r.sid, r.a, r.b) for r in spark.table("tgt").collect()), key=repr)


def test_only_touched_partitions_are_written(spark, sql):
    partitioned(sql, [(1, "A", "x", "'p'"), (2, "B", "x", "'q'"), (3, "C", "x", "'r'"), (4, "D", "x", "NULL"), (5, "E", "x", "'a:b \\'c'")])
    before = files(spark, "tgt")
    # 1 changes in place, 2 moves from q to r, 5 changes, 6 is new in a new partition, 3 and 4 stay.
    source(sql, "(1,'A','y','p',9), (2,'B','x','r',9), (3,'C','x','r',9), (4,'D','x',NULL,9), (5,'E','z','a:b \\'c',9), (6,'F','x','s t',9)")
    done = load_table(spark, TYPE1, LOAD, 7)
    want = [(1, "y", "p"), (2, "x", "r"), (3, "x", "r"), (4, "x", None), (5, "z", "a:b 'c"), (6, "x", "s t")]
    assert shown(spark) == sorted(want, key=repr)
    assert set(done.rewritten) == {("p",), ("a:b 'c",)}
    assert set(done.appended) == {("r",), ("s t",)}
    assert done.emptied == (("q",),)
    stayed = {f for f in before if "b=r" in f or "b=__HIVE" in f}
    assert len(stayed) == 2 and stayed <= files(spark, "tgt")
    assert not [r for r in spark.sql("SHOW PARTITIONS tgt").collect() if r[0] == "b=q"]
    again = files(spark, "tgt")
    assert load_table(spark, TYPE1, LOAD, 8) == publish.Touched()
    assert files(spark, "tgt") == again


def test_null_partition_and_several_columns(spark, sql):
    sql(f"CREATE TABLE tgt (sid bigint, dim string, a string, {AUDIT}, b string, d date) USING parquet PARTITIONED BY (b, d)")
    sql(f"INSERT INTO tgt VALUES (1, 'A', 'x', {SEED}, NULL, date'2024-01-01'), (2, 'B', 'x', {SEED}, 'p', NULL), (3, 'C', 'x', {SEED}, 'p', date'2024-01-01')")
    before = files(spark, "tgt")
    sql("CREATE TABLE src (sid bigint, dim string, a string, b string, d date, ETL_BATCH_SID int) USING parquet")
    sql("INSERT INTO src VALUES (1, 'A', 'y', NULL, date'2024-01-01', 9), (2, 'B', 'x', 'p', date'2024-02-02', 9)")
    done = load_table(spark, TYPE1, LOAD, 7)
    rows = sorted((r.sid, r.a, r.b, str(r.d)) for r in spark.table("tgt").collect())
    assert rows == [(1, "y", None, "2024-01-01"), (2, "x", "p", "2024-02-02"), (3, "x", "p", "2024-01-01")]
    assert len(done.rewritten) == len(done.appended) == len(done.emptied) == 1
    assert len(before & files(spark, "tgt")) == 1


def test_an_emptied_partition_of_an_external_table_stays_empty(spark, sql, tmp_path):
    sql(f"CREATE TABLE tgt (sid bigint, dim string, a string, {AUDIT}, b string) USING parquet PARTITIONED BY (b) LOCATION '{tmp_path}/t'")
    sql(f"INSERT INTO tgt VALUES (1, 'A', 'x', {SEED}, 'p')")
    for part in ("q", "p", "q"):
        source(sql, f"(1,'A','x','{part}',9)")
        load_table(spark, TYPE1, LOAD, 7)
        assert shown(spark) == [(1, "x", part)]
        sql("DROP TABLE src")


def history(sql):
    sql(f"CREATE TABLE tgt (sid bigint, dim string, EFFECTIVE_DATETIME timestamp_ntz, EXPIRATION_DATETIME timestamp_ntz, a string, b string, {AUDIT},"
        " CURRENT_IND string) USING parquet PARTITIONED BY (CURRENT_IND)")  # fmt: skip
    for sid, dim, a, b, flag in [(10, "A", "x", "p", "Y"), (11, "A", "x", "o", "N"), (12, "B", "x", "p", "Y")]:
        sql(f"INSERT INTO tgt VALUES ({sid}, '{dim}', timestamp_ntz'2023-01-01', NULL, '{a}', '{b}', {SEED}, '{flag}')")


def test_history_partition_only_grows(spark, sql):
    history(sql)
    past = {f for f in files(spark, "tgt") if "CURRENT_IND=N" in f}
    source(sql, "(101,'A','x','q',9), (102,'B','x','p',9), (103,'C','x','p',9)")
    done = load_table(spark, TYPE2, LOAD, 7)
    rows = sorted((r.sid, r.b, r.CURRENT_IND) for r in spark.table("tgt").collect())
    assert rows == [(10, "p", "N"), (11, "o", "N"), (12, "p", "Y"), (101, "q", "Y"), (103, "p", "Y")]
    assert done.rewritten == (("Y",),) and done.appended == (("N",),)
    assert past <= files(spark, "tgt")


def test_a_load_cut_short_is_run_again(spark, sql, monkeypatch):
    history(sql)
    source(sql, "(101,'A','x','q',9), (102,'B','y','p',9)")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(publish, "overwrite_partitions", fails)
        with pytest.raises(RuntimeError, match="lost"):
            load_table(spark, TYPE2, LOAD, 7)
    assert spark.table("tgt").count() == 4  # the closed version stands beside the open one
    load_table(spark, TYPE2, LOAD, 7)
    rows = sorted((r.sid, r.a, r.b, r.CURRENT_IND) for r in spark.table("tgt").collect())
    assert rows == [(10, "x", "p", "N"), (11, "x", "o", "N"), (12, "y", "p", "Y"), (101, "x", "q", "Y")]


def test_an_inserted_key_that_is_held_stops_the_load_before_it_writes(spark, sql):
    history(sql)
    before = files(spark, "tgt")
    source(sql, "(11,'Z','x','q',9)")
    with pytest.raises(Exception, match="already holds surrogate key 11"):
        load_table(spark, TYPE2, LOAD, 7)
    assert files(spark, "tgt") == before


@pytest.mark.parametrize("part", ["", "PARTITIONED BY (is_current)"])
def test_hash_history(spark, sql, part):
    sql("CREATE TABLE tgt (dim string, a string, row_hash string, effective_date timestamp_ntz, end_date timestamp_ntz,"
        f" version int, note string, is_current boolean) USING parquet {part}")  # fmt: skip
    seen = []
    for text in ("x", "x", "y", "z"):
        rows = [("A", text), (None, text), ("B", "same")]
        done = load_history_table(spark, spark.createDataFrame(rows, "dim string, a string"), "tgt", "dim", ["a"], LOAD)
        seen.append(done)
    rows = sorted((r.dim or "", r.a, r.version, r.is_current) for r in spark.table("tgt").collect())
    # A NULL key meets nothing: its row is new each time.
    assert [r for r in rows if r[0]] == [("A", "x", 1, False), ("A", "y", 2, False), ("A", "z", 3, True), ("B", "same", 1, True)]
    assert len([r for r in rows if not r[0]]) == 4
    if part:
        assert seen[3].rewritten == ((True,),) and seen[3].appended == ((False,),)


def test_unpartitioned_table_keeps_its_other_files(spark, sql):
    sql(f"CREATE TABLE tgt (sid bigint, dim string, a string, b string, {AUDIT}) USING parquet")
    for sid in (1, 2, 3):
        sql(f"INSERT INTO tgt VALUES ({sid}, 'd{sid}', 'x', 'p', {SEED})")
    before = files(spark, "tgt")
    source(sql, "(2,'d2','y','p',9), (4,'d4','x','p',9)")
    done = load_table(spark, TYPE1, LOAD, 7)
    assert shown(spark) == [(1, "x", "p"), (2, "y", "p"), (3, "x", "p"), (4, "x", "p")]
    assert len(done.files) == 1 and len(before & files(spark, "tgt")) == 2
    assert load_table(spark, TYPE1, LOAD, 8).files == ()


# --- facts ----------------------------------------------------------------------------------------

FACT = LoadSpec("FACT", source_table="src", target_table="tgt")


@pytest.mark.parametrize("part", ["", "PARTITIONED BY (BATCH_LOAD_EPOCH)", "PARTITIONED BY (BATCH_LOAD_EPOCH, b)", "PARTITIONED BY (b)"])
def test_a_batch_that_runs_again_replaces_its_rows(spark, sql, part):
    sql(f"CREATE TABLE tgt (dim string, a string, {AUDIT.replace(', BATCH_LOAD_EPOCH bigint', '')}, BATCH_LOAD_EPOCH bigint, b string) USING parquet {part}")
    source(sql, "(1,'A','x','p',9), (2,'B','x','q',9)")
    load_table(spark, FACT, LOAD, 77)
    first = files(spark, "tgt")
    load_table(spark, FACT, LOAD, 78)
    sql("INSERT OVERWRITE src VALUES (1,'A','new','p',9), (3,'C','new','r',9)")
    load_table(spark, FACT, LOAD, 78)
    load_table(spark, FACT, LOAD, 78)
    rows = sorted((r.BATCH_LOAD_EPOCH, r.dim, r.a, r.b) for r in spark.table("tgt").collect())
    assert rows == [(77, "A", "x", "p"), (77, "B", "x", "q"), (78, "A", "new", "p"), (78, "C", "new", "r")]
    assert first <= files(spark, "tgt")
    sql("TRUNCATE TABLE src")
    load_table(spark, FACT, LOAD, 78)
    assert {r.BATCH_LOAD_EPOCH for r in spark.table("tgt").collect()} == {77}


def test_slices_of_a_batch_are_told_apart(spark, sql):
    sql(f"CREATE TABLE tgt (dim string, a string, b string, {AUDIT}) USING parquet")
    source(sql, "(1,'A','x','p',9), (2,'B','x','q',9)")
    for name in ("p", "q", "p", "q", "q"):
        load_table(spark, FACT, LOAD, 77, predicate=f"b = '{name}'")
    assert sorted(r.dim for r in spark.table("tgt").collect()) == ["A", "B"]
    with pytest.raises(ValueError, match="cannot tell"):
        load_table(spark, FACT, LOAD, 77, predicate="sid = 1")


# --- cleanup --------------------------------------------------------------------------------------

LOADS = LoadSpec("FACT", primary_key=("k",), target_table="loads")


@pytest.mark.parametrize("part", ["", "PARTITIONED BY (p)"])
def test_cleanup_rewrites_only_files_with_stale_rows(spark, sql, part):
    sql(f"CREATE TABLE loads (k int, v string, BATCH_LOAD_EPOCH bigint, p string) USING parquet {part}")
    sql("INSERT INTO loads SELECT /*+ COALESCE(1) */ * FROM VALUES (1, 'old', 1, 'a'), (7, 'stays', 1, 'a')")
    sql("INSERT INTO loads VALUES (1, 'new', 2, 'b c'), (1, 'tie', 2, 'b c')")
    sql("INSERT INTO loads VALUES (2, 'only', 1, 'a'), (3, 'only', 1, NULL)")
    sql("INSERT INTO loads VALUES (NULL, 'no key', 9, 'a'), (5, 'no epoch', NULL, 'b c')")
    before = files(spark, "loads")
    replaced = cleanup_table(spark, LOADS)
    assert sorted(r.v for r in spark.table("loads").collect()) == ["new", "only", "only", "stays", "tie"]
    assert {r.v: r.p for r in spark.table("loads").collect()}["stays"] == "a"
    after = files(spark, "loads")
    assert replaced and len(before & after) == len(before) - len(replaced)
    assert all(not os.path.exists(unquote(f).removeprefix("file:")) for f in replaced)
    assert cleanup_table(spark, LOADS) == [] and files(spark, "loads") == after


def test_cleanup_beyond_the_broadcast_limit(spark, sql, monkeypatch):
    monkeypatch.setattr("dimweave.operators.checks.BROADCAST_BYTES", 0)
    sql("CREATE TABLE loads (k int, v string, BATCH_LOAD_EPOCH bigint) USING parquet")
    sql("INSERT INTO loads VALUES (1, 'old', 1), (1, 'new', 2)")
    sql("INSERT INTO loads VALUES (2, 'only', 2)")
    assert len(cleanup_table(spark, LOADS)) == 1
    assert sorted(r.v for r in spark.table("loads").collect()) == ["new", "only"]


@pytest.mark.parametrize("moment", ["before the journal", "after the journal", "half way"])
def test_a_rewrite_cut_short(spark, sql, monkeypatch, moment):
    sql("CREATE TABLE loads (k int, v string, BATCH_LOAD_EPOCH bigint) USING parquet")
    sql("INSERT INTO loads SELECT /*+ COALESCE(1) */ * FROM VALUES (1, 'old', 1), (4, 'stays', 1)")
    sql("INSERT INTO loads VALUES (1, 'new', 2)")
    sql("INSERT INTO loads SELECT /*+ COALESCE(1) */ * FROM VALUES (2, 'older', 1), (2, 'newer', 2)")
    finish = rewrite._finish

    def lost(*_):
        raise RuntimeError("lost")

    def half(session, pending):
        store = rewrite._store(session, pending)
        journal = rewrite.json.loads(rewrite._read_text(session, rewrite._path(session, f"{pending.toString()}/{rewrite.JOURNAL}")))
        source, goal = journal["moves"][0]
        store.rename(rewrite._path(session, source), rewrite._path(session, goal))
        lost()

    with monkeypatch.context() as broken:
        if moment == "before the journal":
            broken.setattr(rewrite, "_write_text", lost)
        else:
            broken.setattr(rewrite, "_finish", lost if moment == "after the journal" else half)
        with pytest.raises(RuntimeError, match="lost"):
            cleanup_table(spark, LOADS)
    assert rewrite._finish is finish
    spark.catalog.refreshTable("loads")
    assert spark.table("loads").where("v in ('new', 'newer', 'stays')").select("v").distinct().count() == 3
    assert rewrite.recover(spark, "loads") == 1
    cleanup_table(spark, LOADS)
    assert sorted(r.v for r in spark.table("loads").collect()) == ["new", "newer", "stays"]
    assert rewrite.recover(spark, "loads") == 0


# --- statements for tables with row-level operations ----------------------------------------------


def parsed(spark, text):
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()


def test_merge_has_a_branch_for_each_action(spark):
    text = apply.merge_type1_statement("cat.db.dim", "feed", ["sid", "a b"], "sid", True)
    plan = parsed(spark, text)
    assert plan.count("MergeIntoTable") == 1
    raising, update, insert = text.index("AND src.`action_flag` = 'I'"), text.index("WHEN MATCHED THEN"), text.index("WHEN NOT MATCHED")
    assert raising < update < insert
    held = text[text.index("raise_error") : text.index(" WHEN MATCHED THEN")]
    feed = spark.createDataFrame([(7, "I")], "sid bigint, action_flag string").alias("src")
    with pytest.raises(Exception, match="already holds surrogate key 7"):
        feed.selectExpr(held).collect()
    plain = apply.merge_type1_statement("dim", "feed", ["sid", "a"], "sid", False)
    assert "raise_error" not in plain and "MergeIntoTable" in parsed(spark, plain)


def test_a_merge_source_refuses_repeated_keys(spark):
    rows = spark.createDataFrame([(1, "I"), (2, "U"), (None, "I"), (None, "I")], "sid bigint, action_flag string")
    assert apply.once_by_sid(rows, "sid").count() == 4
    with pytest.raises(Exception, match="repeats surrogate key 1"):
        apply.once_by_sid(rows.union(rows), "sid").collect()


def test_loads_of_row_level_tables_are_statements(spark, sql, monkeypatch):
    """No second read of the target: the feed, then one MERGE."""
    partitioned(sql, [(1, "A", "x", "'p'")])
    source(sql, "(1,'A','y','p',9), (2,'B','x','p',9)")
    merged = []
    monkeypatch.setattr(load, "takes_merge", lambda *_: True)
    monkeypatch.setattr(load, "publish_dimension", None)
    monkeypatch.setattr(load, "merge_type1", lambda feed, table, spec: merged.extend(feed.collect()))
    assert load_table(spark, TYPE1, LOAD, 7) is None
    assert sorted((r.sid, r.a, r.BATCH_LOAD_EPOCH, r.action_flag) for r in merged) == [(1, "y", 7, "U"), (2, "x", 7, "I")]


def test_cleanup_statements(spark):
    text = cleanup.delete_superseded_statement("cat.db.t", "s", ["k", "BATCH_LOAD_EPOCH"])
    assert "deleteaction" in parsed(spark, text) and "tgt.`BATCH_LOAD_EPOCH` < src.`newest_epoch`" in text
    nulls = cleanup.delete_unmatched_statement("cat.db.t", ["k"])
    assert nulls.endswith("WHERE `k` IS NULL OR `BATCH_LOAD_EPOCH` IS NULL") and "DeleteFromTable" in parsed(spark, nulls)
    batch = apply.delete_batch_statement("t", "BATCH_LOAD_EPOCH", 7, "b = 'x' OR b = 'y'")
    assert batch.endswith("= 7 AND (b = 'x' OR b = 'y')") and "DeleteFromTable" in parsed(spark, batch)
    with pytest.raises(ValueError, match="text"):
        apply.delete_batch_statement("t", "BATCH_LOAD_EPOCH", 7, F.lit(True))


def test_cleanup_of_row_level_tables(spark, sql, monkeypatch):
    sql("CREATE TABLE loads (k int, v string, BATCH_LOAD_EPOCH bigint) USING parquet")
    sql("INSERT INTO loads VALUES (1, 'old', 1), (1, 'new', 2)")
    ran = []
    monkeypatch.setattr(load, "takes_merge", lambda *_: True)
    monkeypatch.setattr(load, "delete_superseded_statement", lambda t, s, *_: ran.append(spark.table(s).collect()) or "SELECT 1")
    monkeypatch.setattr(load, "delete_unmatched_statement", lambda *_: "SELECT 1")
    assert cleanup_table(spark, LOADS) == []
    assert [tuple(r) for r in ran[0]] == [(1, 2)]
    assert spark.table("loads").count() == 2  # nothing was rewritten


# --- buckets --------------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Joins as they are between large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr("dimweave.operators.checks.BROADCAST_BYTES", 0)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def buckets_of(spark, table):
    """Rows by the bucket in their file's name and the one their key belongs to."""
    made = rewrite.bucketing(spark, table)
    named = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.", 1).cast("int")
    return {tuple(r) for r in spark.table(table).select(named, made.of_row()).distinct().collect()}


@pytest.mark.parametrize("parts", [[], ["b"]])
def test_a_bucketed_target_is_never_shuffled(spark, sql, no_broadcast, parts):
    rows = spark.range(400).selectExpr(
        "id AS sid", "concat('d', id) AS dim", "'x' AS a", "'SEED' AS INSERTED_BY_USER_NAME", "timestamp_ntz'2023-01-01' AS INSERTED_UTC_DATETIME",
        "CAST(NULL AS string) AS UPDATED_BY_USER_NAME", "CAST(NULL AS timestamp_ntz) AS UPDATED_UTC_DATETIME", "1 AS ETL_BATCH_SID",
        "CAST(1 AS bigint) AS BATCH_LOAD_EPOCH", "concat('p', id % 3) AS b",
    )
    write_bucketed_table(rows, "tgt", "sid", 4, parts)
    sql("CREATE TABLE src (sid bigint, dim string, a string, b string, ETL_BATCH_SID int) USING parquet")
    want = {i: "x" for i in range(400)}
    try:
        for n, text in enumerate(("y", "z")):
            changed = f"id * 7 + {n}"
            sql(f"INSERT INTO src SELECT {changed}, concat('d', {changed}), '{text}', concat('p', ({changed}) % 3), 9 FROM range(80)")
            want |= {i * 7 + n: text for i in range(80)}
            tgt, src = spark.table("tgt"), spark.table("src")
            plan = plan_of(load.build_feed(TYPE1, src, tgt, LOAD))
            assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
            hits = apply.sid_hits(tgt, load.build_feed(TYPE1, src, tgt, LOAD), TYPE1)
            marked = plan_of(apply.mark_by_sid(tgt.select("sid", *parts), spark.createDataFrame(hits.collect(), hits.schema), "sid"))
            assert marked.count("Exchange") == 1
            load_table(spark, TYPE1, LOAD, 7)
            spark.sql("TRUNCATE TABLE src")
            assert all(named == own for named, own in buckets_of(spark, "tgt"))
            assert {r.sid: r.a for r in spark.table("tgt").collect()} == want
            assert spark.table("tgt").count() == len(want)
        before = spark.table("tgt").count()
        remove(spark, load.switch_table(spark, spark.table("tgt").where("sid < 100"), "tgt"))
        assert all(named == own for named, own in buckets_of(spark, "tgt"))
        assert spark.table("tgt").count() == 100 < before
    finally:
        spark.sql("DROP TABLE IF EXISTS tgt")


def test_cleanup_keeps_buckets(spark, sql):
    rows = spark.range(300).selectExpr("id % 100 AS k", "id AS v", "id DIV 100 AS BATCH_LOAD_EPOCH").where("k < 50 OR v < 100")
    write_bucketed_table(rows, "loads", "k", 3)
    try:
        cleanup_table(spark, LOADS)
        assert all(named == own for named, own in buckets_of(spark, "loads"))
        assert sorted(r.v for r in spark.table("loads").collect()) == [*range(50, 100), *range(200, 250)]
    finally:
        spark.sql("DROP TABLE IF EXISTS loads")
