"""One query per operator: (spark, sf_dir) -> DataFrame over the driver's whole tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave import LoadSpec
from dimweave import columns as C
from dimweave.examples import fixtures as X
from dimweave.functions import audit, hashing, versions
from dimweave.operators import (
    apply,
    checks,
    cleanup,
    conform,
    feeds,
    hash_scd2,
    joins,
    key_filter,
    keys,
    roles,
)
from dimweave.plans import load
from dimweave.sources import catalog, files, rewrite

Query = Callable[[SparkSession, str], DataFrame]
SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "segment_totals.sql")

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_EPOCH = "l_shipdate"
EVENT_KEY = ["user_id", "event_type"]
SLICE = "status = 'F'"


# --- sources, projections -------------------------------------------------------------------------


def scan_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of a filtered scan: both reach the file reader."""
    return files.read_source(
        spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey", "o_orderstatus"]
    ).where("o_orderstatus = 'F'")


def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("customer", "nation"):
        X.table(spark, sf_dir, name).createOrReplaceTempView(f"script_{name}")
    return catalog.sql_script(spark, SCRIPT, {"min_balance": 0})


def project_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = X.type2_target(spark, sf_dir)
    role = roles.roles(target.columns, X.CUSTOMER_TYPE2)
    return roles.project(target, [X.CUSTOMER_TYPE2.sid_key, *role.type1, *role.type2])


def audit_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_insert(X.type1_source(spark, sf_dir), X.LOAD_TS)


def audit_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = joins.matched_keys(
        X.type1_source(spark, sf_dir), X.type1_target(spark, sf_dir), "cust_sid"
    )
    named = pairs.select(
        joins.s("cust_sid").alias("cust_sid"),
        joins.s(C.BATCH_SID).alias(C.BATCH_SID),
        joins.t(C.INSERTED_BY),
        joins.t(C.INSERTED_AT),
    )
    stamped = audit.audit_update(
        named, X.LOAD_TS, joins.TARGET + C.INSERTED_BY, joins.TARGET + C.INSERTED_AT
    )
    return stamped.select("cust_sid", *C.AUDIT)


def conform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = X.table(spark, sf_dir, "orders")
    return conform.conform(
        orders,
        "o_orderkey int, o_totalprice decimal(10,2), o_orderpriority varchar(3),"
        " o_orderstatus char(4), o_orderdate date",
    )


NARROW_ORDER = "o_orderkey decimal(4,0), o_totalprice decimal(7,2), o_orderstatus varchar(1)"


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders for a target with narrow types: those that fit and the others."""
    keep = lambda df: files.stage(df, files.scratch_dir(spark), "orders", "judged")
    orders = X.table(spark, sf_dir, "orders")
    return conform.split_fit(orders.selectExpr("o_orderkey * 3 AS o_orderkey", "o_totalprice", "o_orderstatus"), NARROW_ORDER, keep)


def conform_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir)[0]


def conform_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir)[1]


def open_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = X.type2_source(spark, sf_dir).select("cust_sid", "cust_id")
    return versions.open_version(source, X.LOAD_TS)


def close_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = joins.current_slice(X.type2_target(spark, sf_dir))
    kept = current.select("cust_sid", "cust_id", C.EFFECTIVE, C.EXPIRATION, C.CURRENT)
    return versions.close_version(kept, X.LOAD_TS)


def scalar_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))
    blank = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus"))
    orders = X.table(spark, sf_dir, "orders").select(
        "o_orderkey", padded.alias("priority"), blank.alias("status")
    )
    return orders.select(
        "o_orderkey",
        hashing.norm_text("priority").alias("priority_text"),
        hashing.hash_norm(["priority", "status"]).alias("norm_hash"),
        hashing.hash_raw(["priority", "status"]).alias("raw_hash"),
        hashing.row_hash(["priority", "status", "o_orderkey"]).alias("sha_hash"),
    )


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of every line, and of a flag that is blank or missing for most of them."""
    flag = F.when(F.col("l_returnflag") == "N", "").when(
        F.col("l_returnflag") == "A", F.col("l_returnflag")
    )
    lines = X.table(spark, sf_dir, "lineitem").select(*LINE_KEY, flag.alias("flag"))
    with_line = keys.with_surrogate_key(lines, LINE_KEY, "line_sid")
    return keys.with_surrogate_key(with_line, ["flag"], "flag_sid").drop("flag")


# --- predicates, joins, aggregates ----------------------------------------------------------------


def partition_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key the target holds outside the slice only counts as new."""
    src, tgt = joins.slice_both(
        X.order_source(spark, sf_dir), X.order_restated(spark, sf_dir), SLICE
    )
    return joins.new_keys(src, tgt, "order_id").select("order_id", "status")


def new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = joins.new_keys(
        X.type1_source(spark, sf_dir), X.type1_target(spark, sf_dir), "cust_sid"
    )
    return fresh.select("cust_sid", "cust_id", "name")


def matched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = joins.matched_keys(
        X.type1_source(spark, sf_dir), X.type1_target(spark, sf_dir), "cust_sid"
    )
    return pairs.select(
        joins.s("cust_sid").alias("cust_sid"),
        joins.s("segment").alias("new_segment"),
        joins.t("segment").alias("old_segment"),
    )


def join_left_sid(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.join_left(
        X.type1_source(spark, sf_dir), X.type1_target(spark, sf_dir), "cust_sid"
    )
    return joined.select(
        joins.s("cust_sid").alias("cust_sid"), joins.t("cust_sid").alias("target_sid")
    )


def changed_rows_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = joins.matched_keys(
        X.type1_source(spark, sf_dir), X.type1_target(spark, sf_dir), "cust_sid"
    )
    compared = ["name", "segment", "nation"]
    differs = hashing.changed_md5([joins.s(c) for c in compared], [joins.t(c) for c in compared])
    return pairs.where(differs).select(
        joins.s("cust_sid").alias("cust_sid"), joins.s("segment").alias("segment")
    )


def current_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.current_slice(X.type2_target(spark, sf_dir)).select("cust_sid", "nation")


def history_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.history_slice(X.type2_target(spark, sf_dir)).select("cust_sid", "nation")


def latest_epoch_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.latest_epoch(X.table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_EPOCH)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(X.table(spark, sf_dir, "lineitem"), LINE_KEY)


# --- feeds ----------------------------------------------------------------------------------------


def fact_insert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = X.order_target(spark, sf_dir)
    return feeds.fact_insert_feed(
        X.order_source(spark, sf_dir), target.columns, X.LOAD_TS, X.EPOCH, SLICE
    )


def type1_upsert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.type1_upsert_feed(
        X.type1_source(spark, sf_dir),
        X.type1_target(spark, sf_dir),
        X.CUSTOMER_TYPE1,
        X.LOAD_TS,
    )


def feed_split_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.rows_for_action(type1_upsert_feed(spark, sf_dir), C.INSERT)


def upsert_all_matched_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.upsert_all_matched_feed(
        X.type1_source(spark, sf_dir),
        X.type1_target(spark, sf_dir, epoch=False),
        X.CUSTOMER_TYPE1,
        X.LOAD_TS,
    )


def type1_hybrid_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.type1_hybrid_feed(
        X.type2_source(spark, sf_dir),
        X.type2_target(spark, sf_dir),
        X.CUSTOMER_TYPE2,
        X.LOAD_TS,
    )


def _type2(*branches: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feeds.type2_hybrid_feed(
            X.type2_source(spark, sf_dir),
            X.type2_target(spark, sf_dir),
            X.CUSTOMER_TYPE2,
            X.LOAD_TS,
            branches=branches,
        )

    return run


# --- hash history ---------------------------------------------------------------------------------


def scd2_hash_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.prepare_scd2(X.hash_source(spark, sf_dir), X.HASH_ATTRIBUTES, X.LOAD_TS)


def _hash_changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = X.hash_target(spark, sf_dir)
    changed = hash_scd2.scd2_hash_changed(
        X.hash_source(spark, sf_dir), target, X.HASH_KEYS, X.HASH_ATTRIBUTES, X.LOAD_TS
    )
    return changed, target


def scd2_hash_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_changed(spark, sf_dir)[0]


def scd2_hash_changed_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_scd2.scd2_hash_changed(
        X.part_source(spark, sf_dir),
        X.part_target(spark, sf_dir),
        X.PART_KEYS,
        X.PART_ATTRIBUTES,
        X.LOAD_TS,
    )


def scd2_hash_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed, target = _hash_changed(spark, sf_dir)
    return hash_scd2.scd2_hash_expire(changed, target, X.HASH_KEYS, X.LOAD_TS)


def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed, target = _hash_changed(spark, sf_dir)
    return joins.next_version(changed, target, X.HASH_KEYS).select("cust_id", C.VERSION)


def scd2_hash_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed, target = _hash_changed(spark, sf_dir)
    return hash_scd2.scd2_hash_feed(
        changed, target, X.HASH_KEYS, X.HASH_ATTRIBUTES, X.LOAD_TS
    )


def scd2_hash_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.run_scd2_hash(
        X.hash_source(spark, sf_dir),
        X.hash_target(spark, sf_dir),
        X.HASH_KEYS,
        X.HASH_ATTRIBUTES,
        X.LOAD_TS,
    ).snapshot


def scd2_hash_snapshot_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.run_scd2_hash(
        X.part_source(spark, sf_dir),
        X.part_target(spark, sf_dir),
        X.PART_KEYS,
        X.PART_ATTRIBUTES,
        X.LOAD_TS,
    ).snapshot


# --- written and read back ------------------------------------------------------------------------


def write_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script's result, persisted."""
    out = f"{files.scratch_dir(spark)}/totals"
    for name in ("customer", "nation"):
        X.table(spark, sf_dir, name).createOrReplaceTempView(f"script_{name}")
    catalog.run_sql_script(spark, SCRIPT, out, params={"min_balance": 0})
    return files.read_source(spark, out)


def stage_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = type1_upsert_feed(spark, sf_dir)
    return files.stage(feed, files.scratch_dir(spark), X.CUSTOMER_TYPE1.target_table, X.BATCH)


def history_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current slice of a written history table: one partition is read."""
    path = f"{files.scratch_dir(spark)}/history"
    files.write_scd_table(X.type2_target(spark, sf_dir), path, "cust_id")
    return joins.current_slice(files.read_source(spark, path)).select("cust_sid", "nation")


def add_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of two registered directories; a third one is left out.

    The table only lives while its rows are copied out, so that no catalog keeps it.
    """
    scratch, name = files.scratch_dir(spark), f"orders_{uuid.uuid4().hex}"
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").parquet(f"{scratch}/loads")
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey bigint, o_custkey bigint, o_orderstatus string)"
        f" USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{scratch}/table'"
    )
    try:
        for status in ("F", "O", "F"):
            location = f"{scratch}/loads/o_orderstatus={status}"
            catalog.add_partition(spark, name, {"o_orderstatus": status}, location)
        files.write_result(spark.table(name), f"{scratch}/copy")
    finally:
        spark.sql(f"DROP TABLE {name}")
    return files.read_source(spark, f"{scratch}/copy")


# --- apply, load, cleanup -------------------------------------------------------------------------


def type1_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.apply_type1(
        X.type1_target(spark, sf_dir), type1_upsert_feed(spark, sf_dir), X.CUSTOMER_TYPE1, X.EPOCH
    )


def upsert_all_matched_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed replaces the rows it matches; appending it would repeat them."""
    target = X.type1_target(spark, sf_dir, epoch=False)
    return apply.apply_type1(target, upsert_all_matched_feed(spark, sf_dir), X.CUSTOMER_TYPE1)


def type2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _type2(*feeds.BRANCHES)(spark, sf_dir)
    return apply.apply_type2(X.type2_target(spark, sf_dir), feed, X.CUSTOMER_TYPE2, X.EPOCH)


def fact_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = conform.StructType.fromDDL(X.ORDER_FACT_DDL)
    return apply.apply_fact(
        X.order_target(spark, sf_dir), fact_insert_feed(spark, sf_dir), X.EPOCH, schema
    )


def run_load_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.run_load(
        X.CUSTOMER_TYPE1,
        X.type1_source(spark, sf_dir),
        X.type1_target(spark, sf_dir),
        X.LOAD_TS,
        X.EPOCH,
    ).snapshot


def run_load_type2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: history load of the customer dimension, checked, applied."""
    return load.run_load(
        X.CUSTOMER_TYPE2,
        X.type2_source(spark, sf_dir),
        X.type2_target(spark, sf_dir),
        X.LOAD_TS,
        X.EPOCH,
    ).snapshot


def run_load_type2_generated_sid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with surrogate keys made of the business key and the batch."""
    return load.run_load(
        X.CUSTOMER_TYPE2,
        X.type2_source(spark, sf_dir).drop("cust_sid"),
        X.type2_target(spark, sf_dir),
        X.LOAD_TS,
        X.EPOCH,
        sid_from=["cust_id", C.BATCH_SID],
    ).snapshot


def type1_feed_as_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes against a target with narrower types, as it would store them."""
    target = X.stored_target(spark, sf_dir)
    feed = feeds.type1_upsert_feed(
        X.stored_source(spark, sf_dir), target, X.CUSTOMER_TYPE1, X.LOAD_TS
    )
    return conform.conform(feed, target.schema)


@contextmanager
def own_table(
    spark: SparkSession,
    rows: DataFrame,
    source: DataFrame | None = None,
    parts: Sequence[str] = (),
    buckets: tuple[str, int] | None = None,
) -> Iterator[tuple[str, str, list[DataFrame]]]:
    """A catalog table of these rows, a view of a source, and a list for the table's rows at the end.

    Both only live while their rows are copied out, so that no catalog keeps them. Rows are written in the
    tasks they come in.
    """
    scratch, tag = files.scratch_dir(spark), uuid.uuid4().hex
    view, name, found = f"source_{tag}", f"target_{tag}", []
    path = f"{scratch}/{name}"
    if buckets:
        files.write_bucketed_table(rows, name, *buckets, parts, path=path)
    else:
        writer = rows.write.partitionBy(*parts) if parts else rows.write
        writer.option("path", path).saveAsTable(name)
    if source is not None:
        source.createOrReplaceTempView(view)
    try:
        yield name, view, found
        files.write_result(spark.table(name), f"{scratch}/copy")
    finally:
        spark.sql(f"DROP TABLE {name}")
        if source is not None:
            spark.catalog.dropTempView(view)
    found.append(files.read_source(spark, f"{scratch}/copy"))


def load_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table after two loads of the same source: the second finds nothing to change."""
    with own_table(spark, X.type1_target(spark, sf_dir), X.type1_source(spark, sf_dir)) as (name, view, found):
        spec = replace(X.CUSTOMER_TYPE1, source_table=view, target_table=name)
        for _ in range(2):
            load.load_table(spark, spec, X.LOAD_TS, X.EPOCH)
    return found[0]


def load_partitioned_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension by segment after a load that moves customers to another segment's partition."""
    target, source = X.type1_target(spark, sf_dir), X.type1_source(spark, sf_dir)
    with own_table(spark, target, source, ["segment"]) as (name, view, found):
        spec = replace(X.CUSTOMER_TYPE1, source_table=view, target_table=name)
        load.load_table(spark, spec, X.LOAD_TS, X.EPOCH)
    return found[0]


def load_partitioned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history by current flag, so that past versions are added to and not written again."""
    target, source = X.type2_target(spark, sf_dir), X.type2_source(spark, sf_dir)
    with own_table(spark, target, source, [C.CURRENT]) as (name, view, found):
        spec = replace(X.CUSTOMER_TYPE2, source_table=view, target_table=name)
        load.load_table(spark, spec, X.LOAD_TS, X.EPOCH)
    return found[0]


def load_hash_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash history in a table by current flag."""
    with own_table(spark, X.hash_target(spark, sf_dir), parts=[C.IS_CURRENT]) as (name, _, found):
        source = X.hash_source(spark, sf_dir)
        load.load_history_table(spark, source, name, X.HASH_KEYS, X.HASH_ATTRIBUTES, X.LOAD_TS)
    return found[0]


def load_bucketed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension in buckets of its surrogate key after two loads: its side of the joins is not shuffled."""
    target, source = X.type1_target(spark, sf_dir), X.type1_source(spark, sf_dir)
    with own_table(spark, target, source, buckets=("cust_sid", 8)) as (name, view, found):
        spec = replace(X.CUSTOMER_TYPE1, source_table=view, target_table=name)
        for _ in range(2):
            load.load_table(spark, spec, X.LOAD_TS, X.EPOCH)
    return found[0]


def run_load_type2_short_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated keys of 18 bits, of which some are taken: every version still ends with one of its own."""
    snapshot = load.run_load(
        X.CUSTOMER_TYPE2,
        X.type2_source(spark, sf_dir).drop("cust_sid"),
        X.type2_target(spark, sf_dir),
        X.LOAD_TS,
        X.EPOCH,
        sid_from=["cust_id", C.BATCH_SID],
        key_generator=lambda cols: hashing.surrogate_key(cols).bitwiseAND(F.lit((1 << 18) - 1)),
        stage_dir=files.scratch_dir(spark),
    ).snapshot
    alone = F.count(F.lit(1)).over(Window.partitionBy("cust_sid")) == 1
    return snapshot.withColumn("sid_is_unique", alone).drop("cust_sid")


def filtered_matched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders of one status: a filter of the orders' keys at the scan, then the join."""
    orders = X.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey AS l_orderkey")
    lines = X.table(spark, sf_dir, "lineitem")
    profile = checks.key_profile(orders, "l_orderkey")
    near = key_filter.possibly_held(lines, orders, ["l_orderkey"], profile.keys)
    return near.join(orders, "l_orderkey", "left_semi")


def cleanup_batch_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each minute's second half as a batch upon a cleaned table of the others."""
    events = X.table(spark, sf_dir, "events")
    later = F.second("ts") >= 30
    held = cleanup.keep_latest_batch(events.where(~later), EVENT_KEY, "ts")
    with own_table(spark, held) as (name, _, found):
        spec, index = LoadSpec("FACT", primary_key=tuple(EVENT_KEY), target_table=name), f"{name}_index"
        load.build_epoch_index(spark, spec, index, 8, "ts", path=f"{files.scratch_dir(spark)}/index")
        try:
            rewrite.append(events.where(later), name)
            load.cleanup_batch(spark, spec, events.where(later), index, "ts")
        finally:
            spark.sql(f"DROP TABLE {index}")
    return found[0]


def slice_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the nations in which some are deep in debt, from a table by nation."""
    customers = X.table(spark, sf_dir, "customer")
    with own_table(spark, customers, parts=["c_nationkey"]) as (name, _, _):
        owing = customers.where("c_acctbal < -990")
        some = joins.slice_of_source(owing, spark.table(name), "c_nationkey")
        kept = files.stage(some, files.scratch_dir(spark), "slice", "rows")
    return kept


def load_fact_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table by epoch after two runs of one batch."""
    target, source = X.order_target(spark, sf_dir), X.order_source(spark, sf_dir).where(SLICE)
    with own_table(spark, target, source, [C.BATCH_EPOCH]) as (name, view, found):
        spec = replace(X.ORDER_FACT, source_table=view, target_table=name)
        for _ in range(2):
            load.load_table(spark, spec, X.LOAD_TS, X.EPOCH)
    return found[0]


def load_fact_slices_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table without partitions after two runs of a batch's one slice."""
    target, source = X.order_target(spark, sf_dir), X.order_source(spark, sf_dir)
    with own_table(spark, target, source) as (name, view, found):
        spec = replace(X.ORDER_FACT, source_table=view, target_table=name)
        for _ in range(2):
            load.load_table(spark, spec, X.LOAD_TS, X.EPOCH, predicate=SLICE)
    return found[0]


def cleanup_table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in a table whose files with superseded lines are rewritten."""
    lines = X.table(spark, sf_dir, "lineitem").repartitionByRange("l_orderkey")
    with own_table(spark, lines) as (name, _, found):
        spec = LoadSpec("FACT", primary_key=tuple(LINE_KEY), target_table=name)
        load.cleanup_table(spark, spec, LINE_EPOCH)
    return found[0]


def run_load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.run_load(
        X.ORDER_FACT,
        X.order_source(spark, sf_dir),
        X.order_target(spark, sf_dir),
        X.LOAD_TS,
        X.EPOCH,
        predicate=SLICE,
    ).snapshot


def cleanup_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.keep_latest_batch(X.table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_EPOCH)


def cleanup_stale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.stale_rows(X.table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_EPOCH)


def cleanup_keep_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few hot keys: thousands of rows each, one of them stays."""
    return cleanup.keep_latest_batch(X.table(spark, sf_dir, "events"), EVENT_KEY, "ts")


def superseded_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.superseded_keys(X.table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_EPOCH)


def run_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user and type: staged where the cluster names a folder, lazy otherwise."""
    return load.run_cleanup(X.table(spark, sf_dir, "events"), EVENT_KEY, "ts").stale


def run_cleanup_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of the same cleanup."""
    return load.run_cleanup(X.table(spark, sf_dir, "events"), EVENT_KEY, "ts").kept


def queries() -> dict[str, Query]:
    return {
        "scan_source": scan_source,
        "sql_script": sql_script,
        "project_roles": project_roles,
        "audit_insert": audit_insert,
        "audit_update": audit_update,
        "conform_cast": conform_cast,
        "conform_fit": conform_fit,
        "conform_rejected": conform_rejected,
        "open_version": open_version,
        "close_version": close_version,
        "scalar_normalise": scalar_normalise,
        "surrogate_key": surrogate_key,
        "partition_slice": partition_slice,
        "new_keys": new_keys,
        "matched_keys": matched_keys,
        "join_left_sid": join_left_sid,
        "changed_rows_md5": changed_rows_md5,
        "current_slice": current_slice,
        "history_slice": history_slice,
        "latest_epoch_per_key": latest_epoch_per_key,
        "duplicate_keys": duplicate_keys,
        "fact_insert_feed": fact_insert_feed,
        "type1_upsert_feed": type1_upsert_feed,
        "feed_split_actions": feed_split_actions,
        "upsert_all_matched_feed": upsert_all_matched_feed,
        "type1_hybrid_feed": type1_hybrid_feed,
        "type2_hybrid_feed": _type2(*feeds.BRANCHES),
        "type2_insert_rows": _type2(feeds.OPEN),
        "type2_expire_rows": _type2(feeds.CLOSE),
        "type2_type1_rows": _type2(feeds.OVERWRITE),
        "scd2_hash_prepare": scd2_hash_prepare,
        "scd2_hash_changed": scd2_hash_changed,
        "scd2_hash_changed_composite": scd2_hash_changed_composite,
        "scd2_hash_expire": scd2_hash_expire,
        "next_version": next_version,
        "scd2_hash_feed": scd2_hash_feed,
        "scd2_hash_snapshot": scd2_hash_snapshot,
        "scd2_hash_snapshot_composite": scd2_hash_snapshot_composite,
        "write_result": write_result,
        "stage_feed": stage_feed,
        "history_layout": history_layout,
        "add_partition": add_partition,
        "type1_apply": type1_apply,
        "upsert_all_matched_apply": upsert_all_matched_apply,
        "type2_apply": type2_apply,
        "fact_apply": fact_apply,
        "run_load_type1": run_load_type1,
        "run_load_type2": run_load_type2,
        "run_load_type2_generated_sid": run_load_type2_generated_sid,
        "type1_feed_as_stored": type1_feed_as_stored,
        "load_table_twice": load_table_twice,
        "load_partitioned_dimension": load_partitioned_dimension,
        "load_partitioned_history": load_partitioned_history,
        "load_hash_history": load_hash_history,
        "load_bucketed_dimension": load_bucketed_dimension,
        "run_load_type2_short_keys": run_load_type2_short_keys,
        "filtered_matched_keys": filtered_matched_keys,
        "cleanup_batch_by_index": cleanup_batch_by_index,
        "slice_of_source": slice_of_source,
        "load_fact_twice": load_fact_twice,
        "load_fact_slices_twice": load_fact_slices_twice,
        "cleanup_table_files": cleanup_table_files,
        "run_load_fact": run_load_fact,
        "cleanup_keep_latest": cleanup_keep_latest,
        "cleanup_stale_rows": cleanup_stale_rows,
        "cleanup_keep_latest_events": cleanup_keep_latest_events,
        "superseded_keys": superseded_keys,
        "run_cleanup": run_cleanup,
        "run_cleanup_kept": run_cleanup_kept,
    }
