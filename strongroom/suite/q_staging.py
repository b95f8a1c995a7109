"""Staging queries (G1, G2, G6, G7, G10) and the business satellite."""

from __future__ import annotations

from pyspark.sql import functions as F

from strongroom.functions import rules
from strongroom.functions.hashing import hash_key
from strongroom.operators.staging import dedup, sample, scrub, stage, stage_hashed
from strongroom.sources import feeds
from strongroom.suite import model
from strongroom.suite import sqlbits as S
from strongroom.suite.registry import register


# G1: events landed as text, typed with try_cast (bad values go to rejects).
def landed_events(spark, d):
    e = feeds.table(spark, d, "events")
    return e.select(*[F.col(c).cast("string").alias(c.upper()) for c in e.columns])


@register(
    "stage_typed",
    """SELECT CAST(event_id AS BIGINT) AS EVENT_ID, ts AS TS, CAST(user_id AS BIGINT) AS USER_ID, event_type AS EVENT_TYPE,
        CAST(value AS DECIMAL(18,2)) AS VALUE, props AS PROPS, 'WEB' AS REC_SRC FROM events""",
)
def q_stage_typed(spark, d):
    typed, _rejects = stage(
        landed_events(spark, d),
        {"EVENT_ID": "bigint", "TS": "timestamp_ntz", "USER_ID": "bigint", "VALUE": "decimal(18,2)"},
        rec_src="WEB",
    )
    return typed


# G1 rejects: amounts landed as text and declared DECIMAL(4,2); values that
# do not fit are rejected with the failed column named, never nulled.
@register(
    "stage_rejects",
    """SELECT CAST(event_id AS VARCHAR) AS EVENT_ID, CAST(value AS VARCHAR) AS VALUE, 'VALUE' AS _FAILED
    FROM events WHERE TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) IS NULL AND value IS NOT NULL""",
)
def q_stage_rejects(spark, d):
    e = landed_events(spark, d).select("EVENT_ID", "VALUE")
    _typed, rejects = stage(e, {"VALUE": "decimal(4,2)"})
    return rejects


# Exact duplicate documents (same text, language and source) dropped.
@register("stage_dedup", "SELECT DISTINCT text AS TEXT, lang AS LANG, source AS SOURCE FROM documents")
def q_stage_dedup(spark, d):
    docs = feeds.table(spark, d, "documents").select(
        F.col("text").alias("TEXT"), F.col("lang").alias("LANG"), F.col("source").alias("SOURCE")
    )
    return dedup(docs)


# Personal data scrubbed before the vault: e-mails and phone numbers
# masked in the text, the source hashed.
@register(
    "stage_scrub",
    f"""SELECT doc_id AS DOC_ID,
        regexp_replace(regexp_replace(text, '{rules.EMAIL_RE}', '{rules.EMAIL_MASK}', 'g'), '{rules.PHONE_RE}', '{rules.PHONE_MASK}', 'g') AS TEXT,
        sha256(source) AS SOURCE FROM documents""",
)
def q_stage_scrub(spark, d):
    docs = feeds.table(spark, d, "documents").select(
        F.col("doc_id").alias("DOC_ID"), F.col("text").alias("TEXT"), F.col("source").alias("SOURCE")
    )
    return scrub(docs, {"TEXT": "mask", "SOURCE": "hash"})


# Stage L2, every hash computed once.
@register(
    "stage_hashed",
    f"""SELECT ORDER_NUMBER, LINE_SSQN, LOAD_DTS, REC_SRC, {S.hk('CUSTOMER_NUMBER')} AS CUSTOMER_HK,
        {S.hk('ORDER_NUMBER')} AS ORDER_HK, {S.hk('PRODUCT_CODE')} AS PRODUCT_HK,
        {S.hk('ORDER_NUMBER', 'PRODUCT_CODE', 'CUSTOMER_NUMBER')} AS ORDER_ITEM_HK,
        {S.hd('QUANTITY', 'EXTENDED_PRICE', 'DISCOUNT_PCT', 'CAST(EXTENDED_PRICE * (1 - DISCOUNT_PCT) AS DECIMAL(18,4))')} AS SAT_ORDER_ITEM_DETAILS_HD
    FROM ({S.STG_ORDERS})""",
)
def q_stage_hashed(spark, d):
    stg = model.with_line_total(feeds.stg_orders(spark, d))
    h = stage_hashed(
        stg,
        hubs=[model.HUB_CUSTOMER, model.HUB_ORDER, model.HUB_PRODUCT],
        links=[model.LNK_ORDER_ITEM],
        sats=[model.SAT_ORDER_ITEM_DETAILS],
    )
    return h.select(
        "ORDER_NUMBER", "LINE_SSQN", "LOAD_DTS", "REC_SRC", "CUSTOMER_HK", "ORDER_HK", "PRODUCT_HK",
        "ORDER_ITEM_HK", "SAT_ORDER_ITEM_DETAILS_HD",
    )


# 1 percent row sample of the biggest table (no oracle: random rows).
@register("sample")
def q_sample(spark, d):
    return sample(feeds.table(spark, d, "lineitem"), 1.0, seed=7)


# The sample against what can be said of any: its size lies within six
# standard deviations of 1 percent, and every row of it is one of the table.
@register("sample_bounds", "SELECT count(*) AS TOTAL_ROWS, true AS SIZE_IN_BOUNDS, CAST(0 AS BIGINT) AS FOREIGN_ROWS FROM lineitem")
def q_sample_bounds(spark, d):
    table = feeds.table(spark, d, "lineitem")
    drawn = sample(table, 1.0, seed=7)
    total, size = table.select(F.count(F.lit(1))).scalar(), drawn.select(F.count(F.lit(1))).scalar()
    foreign = drawn.exceptAll(table).agg(F.count(F.lit(1)).alias("FOREIGN_ROWS"))
    return foreign.select(
        total.alias("TOTAL_ROWS"),
        (F.abs(size - total * 0.01) <= 6 * F.sqrt(total * 0.01 * 0.99)).alias("SIZE_IN_BOUNDS"),
        "FOREIGN_ROWS",
    )


# E-mail addresses and phone numbers of the documents, validated.
@register(
    "bsat_contact",
    f"""WITH e AS (SELECT doc_id, unnest(range(1, len(m) + 1)) AS k, unnest(m) AS RAW FROM (
            SELECT doc_id, regexp_extract_all(text, '{rules.EMAIL_RE}') AS m FROM documents)),
    p AS (SELECT doc_id, unnest(range(1, len(m) + 1)) AS k, unnest(m) AS RAW FROM (
            SELECT doc_id, regexp_extract_all(text, '{rules.PHONE_RE}') AS m FROM documents)),
    n AS (SELECT *, regexp_replace(RAW, '[^0-9+]', '', 'g') AS digits FROM p),
    s AS (SELECT *, CASE WHEN starts_with(digits, '+') THEN digits ELSE '+61' || regexp_replace(digits, '^0', '') END AS shaped FROM n),
    v AS (SELECT *, CASE WHEN regexp_full_match(shaped, '[+][1-9][0-9]{{6,14}}') THEN shaped END AS VALUE FROM s)
    SELECT doc_id, 'EMAIL' AS KIND, CAST(k AS INTEGER) AS SSQN, RAW, lower(RAW) AS VALUE, true AS IS_VALID FROM e
    UNION ALL SELECT doc_id, 'PHONE', CAST(k AS INTEGER), RAW, VALUE, VALUE IS NOT NULL FROM v""",
)
def q_bsat_contact(spark, d):
    from strongroom.operators.business import contact_sat

    return contact_sat(feeds.table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


# Business satellite: lifetime value, order count, value tier, debt
# flag and name validity per customer (soft rules after the vault).
@register(
    "bsat_customer",
    f"""WITH o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS LTV, count(*) AS N,
            min(o_orderdate) AS F, max(o_orderdate) AS L FROM orders GROUP BY 1)
    SELECT {S.hk('c.c_custkey')} AS CUSTOMER_HK, TIMESTAMP '2024-01-01 00:00:00' AS LOAD_DTS, 'BV' AS REC_SRC,
        coalesce(o.LTV, 0) AS LIFETIME_VALUE, coalesce(o.N, 0) AS ORDER_COUNT, o.F AS FIRST_ORDER_DTS, o.L AS LAST_ORDER_DTS,
        CASE WHEN coalesce(o.LTV, 0) >= 5000000 THEN 'GOLD' WHEN coalesce(o.LTV, 0) >= 2000000 THEN 'SILVER' ELSE 'BRONZE' END AS VALUE_TIER,
        CAST(c.c_acctbal < 0 AS BOOLEAN) AS IN_DEBT,
        regexp_full_match(c.c_name, 'Customer#[0-9]{{9}}') AS NAME_VALID
    FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey""",
)
def q_bsat_customer(spark, d):
    from strongroom.operators.business import business_sat

    c = feeds.table(spark, d, "customer")
    o = feeds.table(spark, d, "orders")
    return business_sat(c, o)
