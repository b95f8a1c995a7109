"""Staging feeds (STG_*) derived from the test tables.

Each feed is a lazily read, column-pruned DataFrame in the staging shape:
business keys as strings, payload typed, LOAD_DTS and REC_SRC on every
row.  Money and quantities are typed DECIMAL so hash diffs and sums are
exact.  Orders and customers grow with the input, so joins with them are
merges: a broadcast would be chosen by the size of their compressed files.  Mapping of the fixtures (fixed values):
  STG_ORDERS         orders JOIN lineitem; LOAD_DTS = o_orderdate;
                     REC_SRC = 'S' || (l_suppkey % 3)
  STG_PAYMENTS       orders; PAYMENT_METHOD_CODE = o_orderpriority; REC_SRC 'PAY'
  STG_CHANNELS       orders JOIN customer; CHANNEL_CODE = c_mktsegment; REC_SRC 'CRM'
  STG_CUSTOMERS      customer (+ nation, region); LOAD_DTS 2024-01-01; REC_SRC 'CRM'
  STG_PARTS          part; LOAD_DTS 2024-01-01; REC_SRC 'PIM'
  STG_USER_EVENTS    events; LOAD_DTS = ts; REC_SRC 'WEB'
  STG_CONVERSATIONS  conversations; SSQN = turn; LOAD_DTS 2024-01-01; REC_SRC 'CHAT'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strongroom.functions.hashing import place_of
from strongroom.operators.specs import PLACE
from strongroom.sources.io import placing_session

# Fixed values of the fixture mapping.
FIXED_LOAD_DTS = "2024-01-01 00:00:00"
MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"


def ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stg_orders(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """``placed``: by ORDER_NUMBER, by which the join deals its rows out then, in a session of its own."""
    spark = placing_session(spark) if placed else spark
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    same = li["l_orderkey"] == o["o_orderkey"]
    if placed:
        li = li.withColumn("_at", place_of("l_orderkey")).repartition(F.col("_at"))
        o = o.withColumn(PLACE, place_of("o_orderkey")).repartition(F.col(PLACE))
        same = (li["_at"] == o[PLACE]) & same
    j = li.join(o.hint("merge"), same, "inner")
    return j.select(
        *([PLACE] if placed else []),
        F.col("o_custkey").cast("string").alias("CUSTOMER_NUMBER"),
        F.col("o_orderkey").cast("string").alias("ORDER_NUMBER"),
        F.col("l_partkey").cast("string").alias("PRODUCT_CODE"),
        F.col("l_suppkey").cast("string").alias("SUPPLIER_NUMBER"),
        F.col("l_linenumber").cast("string").alias("LINE_NUMBER"),
        F.concat_ws("|", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")).alias("LINE_SSQN"),
        F.col("l_quantity").cast(MONEY).alias("QUANTITY"),
        F.col("l_extendedprice").cast(MONEY).alias("EXTENDED_PRICE"),
        F.col("l_discount").cast(RATE).alias("DISCOUNT_PCT"),
        F.col("o_orderdate").alias("LOAD_DTS"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 3).cast("string")).alias("REC_SRC"),
    )


def stg_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of order lines, with the ship date as an unhashed column."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    return li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"], "inner").select(
        F.col("o_custkey").cast("string").alias("CUSTOMER_NUMBER"),
        F.col("o_orderkey").cast("string").alias("ORDER_NUMBER"),
        F.col("l_partkey").cast("string").alias("PRODUCT_CODE"),
        F.concat_ws("|", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")).alias("LINE_SSQN"),
        F.col("l_returnflag").alias("RETURN_FLAG"),
        F.col("l_linestatus").alias("LINE_STATUS"),
        F.col("l_shipdate").alias("SHIP_DATE"),
        F.col("o_orderdate").alias("LOAD_DTS"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 3).cast("string")).alias("REC_SRC"),
    )


def stg_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("ORDER_NUMBER"),
        F.col("o_orderpriority").alias("PAYMENT_METHOD_CODE"),
        F.col("o_orderdate").alias("LOAD_DTS"),
        F.lit("PAY").alias("REC_SRC"),
    )


def stg_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("ORDER_NUMBER"),
        F.col("o_orderstatus").alias("ORDER_STATUS"),
        F.col("o_totalprice").cast(MONEY).alias("TOTAL_PRICE"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.col("o_orderdate").alias("LOAD_DTS"),
        F.lit("OMS").alias("REC_SRC"),
    )


def stg_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c.hint("merge"), o["o_custkey"] == c["c_custkey"], "inner")
    return j.select(
        F.col("o_orderkey").cast("string").alias("ORDER_NUMBER"),
        F.col("c_mktsegment").alias("CHANNEL_CODE"),
        F.col("o_orderdate").alias("LOAD_DTS"),
        F.lit("CRM").alias("REC_SRC"),
    )


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("CUSTOMER_NUMBER"),
        F.col("c_name").alias("FULL_NAME"),
        F.col("c_mktsegment").alias("LOYALTY_TIER"),
        F.col("c_acctbal").cast(MONEY).alias("ACCOUNT_BALANCE"),
        F.col("c_nationkey").alias("NATION_KEY"),
        ts(FIXED_LOAD_DTS).alias("LOAD_DTS"),
        F.lit("CRM").alias("REC_SRC"),
    )


def stg_customer_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(r, F.col("n_regionkey") == r["r_regionkey"], "left")
    return j.select(
        F.col("c_custkey").cast("string").alias("CUSTOMER_NUMBER"),
        F.col("n_name").alias("NATION_NAME"),
        F.col("r_name").alias("REGION_NAME"),
        ts(FIXED_LOAD_DTS).alias("LOAD_DTS"),
        F.lit("CRM").alias("REC_SRC"),
    )


def stg_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("PRODUCT_CODE"),
        F.col("p_name").alias("PRODUCT_NAME"),
        F.col("p_type").alias("CATEGORY"),
        F.col("p_brand").alias("BRAND"),
        F.col("p_retailprice").cast(MONEY).alias("UNIT_PRICE"),
        (F.col("p_partkey") / 10).cast("bigint").cast("string").alias("PARENT_PRODUCT_CODE"),
        ts(FIXED_LOAD_DTS).alias("LOAD_DTS"),
        F.lit("PIM").alias("REC_SRC"),
    )


def stg_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("USER_ID"),
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.col("value").cast(MONEY).alias("VALUE"),
        F.col("props").alias("PROPS"),
        F.col("ts").alias("LOAD_DTS"),
        F.lit("WEB").alias("REC_SRC"),
    )


def stg_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("CONV_ID"),
        F.col("turn").alias("SSQN"),
        F.col("role").alias("ROLE"),
        F.col("text").alias("TEXT"),
        ts(FIXED_LOAD_DTS).alias("LOAD_DTS"),
        F.lit("CHAT").alias("REC_SRC"),
    )
