"""The e-commerce and web-event vault built from the test tables: entity
specs and vault tables (first load into an empty vault).

Each table is written once per application and input folder, under the
session's shared scratch folder, and read from there by every query that
needs it, as in a warehouse.  ``table.load(spark, d)`` is the load itself,
a DataFrame of the rows to append; the load queries return that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strongroom.operators.common import placed
from strongroom.operators.hub import load_hub
from strongroom.operators.link import load_link
from strongroom.operators.satellite import load_sat
from strongroom.operators.specs import PLACE, HubSpec, LinkSpec, SatSpec
from strongroom.operators.staging import stage_hashed
from strongroom.sources import feeds
from strongroom.sources.io import append, append_placed, read_or_none, read_placed, scratch_path, shuffles_go

#: Path, schema and catalog name (of placed ones) of the tables of this process, by application, input folder and name.
_TABLES: dict[tuple[str, str, str], tuple[str, StructType, str | None]] = {}


def stored_table(load: Callable[[SparkSession, str], DataFrame], partition_by: list[str] | None = None):
    """The table that ``load`` fills, written at its first use.  Placed rows are
    stored in buckets by PLACE, which ``table.placed`` reads with them and ``table`` leaves out."""

    def placed(spark: SparkSession, d: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, d, load.__name__)
        if key not in _TABLES or read_or_none(spark, _TABLES[key][0]) is None:
            path, rows, name = scratch_path(spark, load.__name__), load(spark, d), None
            with shuffles_go(rows.sparkSession):
                if PLACE in rows.columns:
                    name = append_placed(rows, path, load.__name__, PLACE)
                else:
                    # Few files per folder, and a big folder in several.
                    append(rows.hint("rebalance", *partition_by) if partition_by else rows, path, partition_by)
            _TABLES[key] = path, rows.schema, name
        path, schema, name = _TABLES[key]
        return read_placed(spark, name, PLACE) if name else spark.read.schema(schema).parquet(path)

    def table(spark: SparkSession, d: str) -> DataFrame:
        return placed(spark, d).drop(PLACE)

    table.load, table.placed = load, placed
    return table


HUB_CUSTOMER = HubSpec("HUB_CUSTOMER", "CUSTOMER_HK", ("CUSTOMER_NUMBER",))
HUB_ORDER = HubSpec("HUB_ORDER", "ORDER_HK", ("ORDER_NUMBER",))
HUB_PRODUCT = HubSpec("HUB_PRODUCT", "PRODUCT_HK", ("PRODUCT_CODE",))
HUB_SUPPLIER = HubSpec("HUB_SUPPLIER", "SUPPLIER_HK", ("SUPPLIER_NUMBER",))
HUB_USER = HubSpec("HUB_USER", "USER_HK", ("USER_ID",))
HUB_CONVERSATION = HubSpec("HUB_CONVERSATION", "CONV_HK", ("CONV_ID",))

LNK_ORDER_ITEM = LinkSpec(
    "LNK_ORDER_ITEM",
    "ORDER_ITEM_HK",
    (("ORDER_HK", ("ORDER_NUMBER",)), ("PRODUCT_HK", ("PRODUCT_CODE",)), ("CUSTOMER_HK", ("CUSTOMER_NUMBER",))),
)
LNK_ORDER_PAYMENT = LinkSpec(
    "LNK_ORDER_PAYMENT",
    "ORDER_PAYMENT_HK",
    (("ORDER_HK", ("ORDER_NUMBER",)), ("PAYMENT_METHOD_HK", ("PAYMENT_METHOD_CODE",))),
)
LNK_ORDER_CHANNEL = LinkSpec(
    "LNK_ORDER_CHANNEL",
    "ORDER_CHANNEL_HK",
    (("ORDER_HK", ("ORDER_NUMBER",)), ("CHANNEL_HK", ("CHANNEL_CODE",))),
)

SAT_ORDER_ITEM_DETAILS = SatSpec(
    "SAT_ORDER_ITEM_DETAILS",
    "ORDER_ITEM_HK",
    ("QUANTITY", "EXTENDED_PRICE", "DISCOUNT_PCT", "LINE_TOTAL"),
    parent_bk=("ORDER_NUMBER", "PRODUCT_CODE", "CUSTOMER_NUMBER"),
    ssqn="LINE_SSQN",
)
SAT_ORDER_STATUS = SatSpec(
    "SAT_ORDER_STATUS",
    "ORDER_ITEM_HK",
    ("RETURN_FLAG", "LINE_STATUS"),
    parent_bk=("ORDER_NUMBER", "PRODUCT_CODE", "CUSTOMER_NUMBER"),
    ssqn="LINE_SSQN",
    extra=("SHIP_DATE",),
)
SAT_PRODUCT_DETAILS = SatSpec(
    "SAT_PRODUCT_DETAILS",
    "PRODUCT_HK",
    ("PRODUCT_NAME", "CATEGORY", "BRAND", "UNIT_PRICE"),
    parent_bk=("PRODUCT_CODE",),
)
SAT_CUSTOMER_PROFILE = SatSpec(
    "SAT_CUSTOMER_PROFILE",
    "CUSTOMER_HK",
    ("FULL_NAME", "LOYALTY_TIER", "ACCOUNT_BALANCE"),
    parent_bk=("CUSTOMER_NUMBER",),
)
SAT_CUSTOMER_ADDRESS = SatSpec(
    "SAT_CUSTOMER_ADDRESS",
    "CUSTOMER_HK",
    ("NATION_NAME", "REGION_NAME"),
    parent_bk=("CUSTOMER_NUMBER",),
)
SAT_USER_STATE = SatSpec("SAT_USER_STATE", "USER_HK", ("EVENT_TYPE",), parent_bk=("USER_ID",))
SAT_USER_VALUE = SatSpec("SAT_USER_VALUE", "USER_HK", ("VALUE",), parent_bk=("USER_ID",))
SAT_USER_ACTIVITY = SatSpec("SAT_USER_ACTIVITY", "USER_HK", ("EVENT_TYPE", "VALUE", "PROPS"), parent_bk=("USER_ID",))
SAT_ORDER_HEADER = SatSpec(
    "SAT_ORDER_HEADER", "ORDER_HK", ("ORDER_STATUS", "TOTAL_PRICE", "PRIORITY"), parent_bk=("ORDER_NUMBER",)
)
SAT_CONVERSATION = SatSpec(
    "SAT_CONVERSATION", "CONV_HK", ("ROLE", "TEXT"), parent_bk=("CONV_ID",), ssqn="SSQN"
)


#: The history of one line of an order is short: one window per key, which takes
#: one shuffle where time buckets take two.
LINE_BUCKET = None


def with_line_total(stg: DataFrame) -> DataFrame:
    total = (F.col("EXTENDED_PRICE") * (F.lit(1) - F.col("DISCOUNT_PCT"))).cast("decimal(18,4)")
    return stg.withColumn("LINE_TOTAL", total)


# Stage, typed, joined and placed by order once; the loads read it.
@stored_table
def stage_orders(spark: SparkSession, d: str) -> DataFrame:
    return feeds.stg_orders(spark, d, placed=True)


# The order's payment and channel feeds, placed by order as well.
@stored_table
def stage_payments(spark: SparkSession, d: str) -> DataFrame:
    return placed(feeds.stg_payments(spark, d), "ORDER_NUMBER")


@stored_table
def stage_channels(spark: SparkSession, d: str) -> DataFrame:
    return placed(feeds.stg_channels(spark, d), "ORDER_NUMBER")


# Stage L2: the order feed with its hash keys and hash diffs, placed by order.
@stored_table
def stage_orders_hashed(spark: SparkSession, d: str) -> DataFrame:
    return stage_hashed(
        with_line_total(feeds.stg_orders(spark, d, placed=True)), hubs=[HUB_CUSTOMER, HUB_ORDER, HUB_PRODUCT], links=[LNK_ORDER_ITEM], sats=[SAT_ORDER_ITEM_DETAILS]
    )


# Vault tables, first load into an empty vault.
@stored_table
def hub_customer(spark: SparkSession, d: str) -> DataFrame:
    return load_hub(stage_orders(spark, d), None, HUB_CUSTOMER)


def placed_hub_order(spark: SparkSession, d: str) -> DataFrame:
    return load_hub(stage_orders.placed(spark, d), None, HUB_ORDER, placed=True)


@stored_table
def hub_order(spark: SparkSession, d: str) -> DataFrame:
    return placed_hub_order(spark, d).drop(PLACE)


@stored_table
def hub_product(spark: SparkSession, d: str) -> DataFrame:
    return load_hub(stage_orders(spark, d), None, HUB_PRODUCT)


@stored_table
def hub_user(spark: SparkSession, d: str) -> DataFrame:
    return load_hub(feeds.stg_user_events(spark, d), None, HUB_USER)


# The loads of what hangs on an order, placed by it: plans that join them read the loads' rows as they
# come, where all rows of an order lie together, so neither hashes nor payloads are shuffled or stored.
def placed_lnk_order_item(spark: SparkSession, d: str, hashed: bool = True) -> DataFrame:
    return load_link(stage_orders.placed(spark, d), None, LNK_ORDER_ITEM, placed=True, hashed=hashed)


def placed_lnk_order_payment(spark: SparkSession, d: str) -> DataFrame:
    return load_link(stage_payments.placed(spark, d), None, LNK_ORDER_PAYMENT, placed=True)


def placed_lnk_order_channel(spark: SparkSession, d: str) -> DataFrame:
    return load_link(stage_channels.placed(spark, d), None, LNK_ORDER_CHANNEL, placed=True)


def placed_sat_order_item_details(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(with_line_total(stage_orders.placed(spark, d)), None, SAT_ORDER_ITEM_DETAILS, hot_key_bucket=LINE_BUCKET, placed=True)


@stored_table
def lnk_order_item(spark: SparkSession, d: str) -> DataFrame:
    return placed_lnk_order_item(spark, d).drop(PLACE)


@stored_table
def lnk_order_payment(spark: SparkSession, d: str) -> DataFrame:
    return load_link(feeds.stg_payments(spark, d), None, LNK_ORDER_PAYMENT)


@stored_table
def lnk_order_channel(spark: SparkSession, d: str) -> DataFrame:
    return load_link(feeds.stg_channels(spark, d), None, LNK_ORDER_CHANNEL)


@stored_table
def sat_order_item_details(spark: SparkSession, d: str) -> DataFrame:
    return placed_sat_order_item_details(spark, d).drop(PLACE)


@stored_table
def sat_product_details(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(feeds.stg_parts(spark, d), None, SAT_PRODUCT_DETAILS)


@stored_table
def sat_customer_profile(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(feeds.stg_customers(spark, d), None, SAT_CUSTOMER_PROFILE)


@stored_table
def sat_customer_address(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(feeds.stg_customer_address(spark, d), None, SAT_CUSTOMER_ADDRESS)


@stored_table
def sat_user_state(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(feeds.stg_user_events(spark, d), None, SAT_USER_STATE)


@stored_table
def sat_user_value(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(feeds.stg_user_events(spark, d), None, SAT_USER_VALUE)


@stored_table
def sat_user_activity(spark: SparkSession, d: str) -> DataFrame:
    return load_sat(feeds.stg_user_events(spark, d), None, SAT_USER_ACTIVITY)


TABLES = (
    stage_orders, hub_customer, hub_order, hub_product, hub_user, lnk_order_item, lnk_order_payment, lnk_order_channel,
    sat_order_item_details, sat_product_details, sat_customer_profile, sat_customer_address, sat_user_state, sat_user_value, sat_user_activity,
)


def fill(spark: SparkSession, d: str) -> None:
    """Load every table that isn't stored yet."""
    for table in TABLES:
        table(spark, d)
