"""Business vault (S16, S17): derived attributes from soft rules.

The raw vault keeps values as delivered; these builds are rewritten on
demand and never feed back into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strongroom.functions.hashing import hash_key
from strongroom.functions.rules import EMAIL_RE, PHONE_RE, email_is_valid, phone_e164

# Fixed values of the value tiers (lifetime value thresholds).
GOLD_LTV = 5_000_000
SILVER_LTV = 2_000_000
BV_LOAD_DTS = "2024-01-01 00:00:00"


def business_sat(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """BSAT_CUSTOMER_SCORED: lifetime value, order count, first/last order,
    value tier, debt flag, name validity.  The order aggregate is partial
    (map-side) before its shuffle and is joined on the customer key."""
    o = orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("_ltv"),
        F.count(F.lit(1)).alias("_n"),
        F.min("o_orderdate").alias("_f"),
        F.max("o_orderdate").alias("_l"),
    )
    j = customer.join(o, customer["c_custkey"] == o["o_custkey"], "left")
    ltv = F.coalesce(F.col("_ltv"), F.lit(0).cast("decimal(38,2)"))
    return j.select(
        hash_key("c_custkey").alias("CUSTOMER_HK"),
        F.lit(BV_LOAD_DTS).cast("timestamp_ntz").alias("LOAD_DTS"),
        F.lit("BV").alias("REC_SRC"),
        ltv.alias("LIFETIME_VALUE"),
        F.coalesce(F.col("_n"), F.lit(0).cast("bigint")).alias("ORDER_COUNT"),
        F.col("_f").alias("FIRST_ORDER_DTS"),
        F.col("_l").alias("LAST_ORDER_DTS"),
        F.when(ltv >= GOLD_LTV, "GOLD").when(ltv >= SILVER_LTV, "SILVER").otherwise("BRONZE").alias("VALUE_TIER"),
        (F.col("c_acctbal") < 0).alias("IN_DEBT"),
        F.col("c_name").rlike(r"^Customer#[0-9]{9}$").alias("NAME_VALID"),
    )


def contact_sat(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """BSAT_CONTACT: every e-mail address and phone number of a text, as rows
    (id, KIND, SSQN from 1, RAW, VALUE, IS_VALID).  VALUE is the address in
    small letters or the number in E.164; a number without that shape has a
    NULL value and is not valid.  NULL texts have no rows."""
    def mentions(kind: str, pattern: str) -> DataFrame:
        found = F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))).alias("_k", "RAW")
        rows = df.select(id_col, found)
        value = F.lower("RAW") if kind == "EMAIL" else phone_e164("RAW")
        valid = email_is_valid("RAW") if kind == "EMAIL" else value.isNotNull()
        return rows.select(id_col, F.lit(kind).alias("KIND"), (F.col("_k") + 1).alias("SSQN"), "RAW",
                           value.alias("VALUE"), valid.alias("IS_VALID"))

    return mentions("EMAIL", EMAIL_RE).unionByName(mentions("PHONE", PHONE_RE))
