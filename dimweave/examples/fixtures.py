"""Sources and targets derived from the driver's tables: the whole table, in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimweave import LoadSpec
from dimweave import columns as C
from dimweave.functions.hashing import row_hash
from dimweave.operators.conform import LENGTH_METADATA

LOAD_TS = "2024-03-09 18:30:00"
EPOCH = 1710009000
SEED_TS = "2023-07-01 06:00:00"
SEED_EPOCH = 1688191200
SEED_BATCH = 7
BATCH = 8

CUSTOMER_TYPE1 = LoadSpec(
    "DIM", "Type1", "cust_sid", "cust_id", primary_key=("cust_sid",), target_table="customer_dim"
)
CUSTOMER_TYPE2 = LoadSpec(
    "DIM",
    "Type2",
    "cust_sid",
    "cust_id",
    primary_key=("cust_sid",),
    scd_type1_attributes=("name", "segment"),
    scd_type2_attributes=("nation",),
    target_table="customer_history",
)
ORDER_FACT = LoadSpec("FACT", primary_key=("order_id",), target_table="order_fact")
HASH_KEYS = ["cust_id"]
HASH_ATTRIBUTES = ["name", "segment", "nation"]
PART_KEYS = ["brand", "part_id"]
PART_ATTRIBUTES = ["name", "kind", "size"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str) -> str:
    return f"timestamp_ntz'{text}'"


NO_MOMENT = "CAST(NULL AS timestamp_ntz)"
SEED_AUDIT = [
    f"'SEED' AS {C.INSERTED_BY}",
    f"{moment(SEED_TS)} AS {C.INSERTED_AT}",
    f"CAST(NULL AS string) AS {C.UPDATED_BY}",
    f"{NO_MOMENT} AS {C.UPDATED_AT}",
    f"{SEED_BATCH} AS {C.BATCH_SID}",
]
SEED_EPOCH_COLUMN = f"CAST({SEED_EPOCH} AS bigint) AS {C.BATCH_EPOCH}"

# A fifth really changed, a fifth changed in case and outer blanks only.
REVISED_SEGMENT = (
    "CASE c_custkey % 5 WHEN 1 THEN 'REVISED' WHEN 2 THEN concat(' ', lower(c_mktsegment), ' ')"
    " ELSE c_mktsegment END"
)


def type1_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey * 10 + 1 AS cust_sid",
        "c_custkey AS cust_id",
        "c_name AS name",
        f"{REVISED_SEGMENT} AS segment",
        "c_nationkey AS nation",
        f"{BATCH} AS {C.BATCH_SID}",
    )


def type1_target(spark: SparkSession, sf_dir: str, epoch: bool = True) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 9")
    return customer.selectExpr(
        "c_custkey * 10 + 1 AS cust_sid",
        "c_custkey AS cust_id",
        "c_name AS name",
        "c_mktsegment AS segment",
        "c_nationkey AS nation",
        *SEED_AUDIT,
        *([SEED_EPOCH_COLUMN] if epoch else []),
    )


def type2_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey * 10 + 2 AS cust_sid",
        "c_custkey AS cust_id",
        "c_name AS name",
        f"{REVISED_SEGMENT} AS segment",
        "if(c_custkey % 7 = 3, c_nationkey + 100, c_nationkey) AS nation",
        f"{BATCH} AS {C.BATCH_SID}",
    )


def stored_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as doubles and whole segments; a quarter of the balances changed."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS cust_sid",
        "c_custkey AS cust_id",
        "if(c_custkey % 4 = 1, c_acctbal + 1, c_acctbal) AS balance",
        "c_mktsegment AS segment",
        f"{BATCH} AS {C.BATCH_SID}",
    )


def stored_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that keeps balances as decimals and five characters of a segment."""
    rows = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 9").selectExpr(
        "c_custkey AS cust_sid",
        "c_custkey AS cust_id",
        "CAST(c_acctbal AS decimal(12,2)) AS balance",
        "substr(c_mktsegment, 1, 5) AS segment",
        *SEED_AUDIT,
    )
    return rows.withMetadata("segment", {LENGTH_METADATA: "varchar(5)"})


def _versions(spark: SparkSession, sf_dir: str, current: str, past: str, name: str) -> DataFrame:
    """Customers by version: nine in ten have a current one, one in four a past one."""
    return table(spark, sf_dir, "customer").selectExpr(
        "*",
        f"explode(CASE WHEN c_custkey % 10 <> 9 AND c_custkey % 4 = 0 THEN array({current}, {past})"
        f" WHEN c_custkey % 10 <> 9 THEN array({current})"
        f" WHEN c_custkey % 4 = 0 THEN array({past}) END) AS {name}",
    )


def type2_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_current = f"{C.CURRENT} = 'Y'"
    started, restarted = moment("2023-01-01 00:00:00"), moment("2023-07-01 00:00:00")
    return _versions(spark, sf_dir, "'Y'", "'N'", C.CURRENT).selectExpr(
        f"c_custkey * 10 + if({is_current}, 1, 0) AS cust_sid",
        "c_custkey AS cust_id",
        f"if({is_current}, {restarted}, {started}) AS {C.EFFECTIVE}",
        f"if({is_current}, NULL, {moment('2023-06-30 23:59:59')}) AS {C.EXPIRATION}",
        C.CURRENT,
        "c_name AS name",
        "c_mktsegment AS segment",
        f"if({is_current}, c_nationkey, c_nationkey + 1) AS nation",
        *SEED_AUDIT,
        SEED_EPOCH_COLUMN,
    )


def hash_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS cust_id",
        "c_name AS name",
        "if(c_custkey % 5 = 1, 'REVISED', c_mktsegment) AS segment",
        "c_nationkey AS nation",
    )


def hash_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = f"{C.IS_CURRENT} AND c_custkey % 4 = 0"
    started, restarted = moment("2023-01-01 00:00:00"), moment("2023-07-01 00:00:00")
    rows = _versions(spark, sf_dir, "true", "false", C.IS_CURRENT).selectExpr(
        "c_custkey AS cust_id",
        "c_name AS name",
        "c_mktsegment AS segment",
        f"if({C.IS_CURRENT}, c_nationkey, c_nationkey + 1) AS nation",
        f"if({second}, {restarted}, {started}) AS {C.EFFECTIVE_DATE}",
        f"if({C.IS_CURRENT}, NULL, {restarted}) AS {C.END_DATE}",
        C.IS_CURRENT,
        f"if({second}, 2, 1) AS {C.VERSION}",
    )
    return rows.withColumn(C.ROW_HASH, row_hash(HASH_ATTRIBUTES))


def part_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_brand AS brand",
        "p_partkey AS part_id",
        "p_name AS name",
        "p_type AS kind",
        "if(p_partkey % 6 = 2, p_size + 50, p_size) AS size",
    )


def part_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").where("p_partkey % 8 <> 5").selectExpr(
        "p_brand AS brand",
        "p_partkey AS part_id",
        "p_name AS name",
        "p_type AS kind",
        "p_size AS size",
        f"{moment('2023-01-01 00:00:00')} AS {C.EFFECTIVE_DATE}",
        f"{NO_MOMENT} AS {C.END_DATE}",
        f"true AS {C.IS_CURRENT}",
        f"CAST(p_partkey % 3 + 1 AS int) AS {C.VERSION}",
    )
    return rows.withColumn(C.ROW_HASH, row_hash(PART_ATTRIBUTES))


def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS cust_id",
        "o_orderstatus AS status",
        "o_totalprice AS total",
        "o_orderdate AS ordered_at",
        f"{BATCH} AS {C.BATCH_SID}",
    )


# The fact target's columns and types.
ORDER_FACT_DDL = (
    "order_id bigint, cust_id bigint, status varchar(1), total decimal(12,2),"
    " ordered_at timestamp_ntz, INSERTED_BY_USER_NAME varchar(30),"
    " INSERTED_UTC_DATETIME timestamp_ntz, UPDATED_BY_USER_NAME varchar(30),"
    " UPDATED_UTC_DATETIME timestamp_ntz, ETL_BATCH_SID int, BATCH_LOAD_EPOCH bigint"
)


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS cust_id",
        "o_orderstatus AS status",
        "CAST(o_totalprice AS decimal(12,2)) AS total",
        "o_orderdate AS ordered_at",
        *SEED_AUDIT,
        SEED_EPOCH_COLUMN,
    )


def order_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two orders in three, a fifth of them with another status than the source has."""
    return table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").selectExpr(
        "o_orderkey AS order_id", "if(o_orderkey % 5 = 0, 'P', o_orderstatus) AS status"
    )
