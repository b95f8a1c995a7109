"""Hub and link queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strongroom.functions.hashing import hash_key
from strongroom.operators.common import packed
from strongroom.operators.hub import load_hub
from strongroom.operators.link import ancestors, coarsen, exploration_link, load_link, load_nh_link, resolve_same_as, same_as_masters
from strongroom.operators.specs import PLACE, HubSpec, LinkSpec
from strongroom.sources import feeds
from strongroom.sources.io import placing_session
from strongroom.suite import model
from strongroom.suite import sqlbits as S
from strongroom.suite.registry import register

# ------------------------------------------------------------------ hubs (H1)
HUB_CUSTOMER_SQL = S.hub_sql(S.STG_ORDERS, "CUSTOMER_HK", "CUSTOMER_NUMBER")


@register("hub_customer", HUB_CUSTOMER_SQL)
def q_hub_customer(spark, d):
    return model.hub_customer.load(spark, d)


@register("hub_order", S.hub_sql(S.STG_ORDERS, "ORDER_HK", "ORDER_NUMBER"))
def q_hub_order(spark, d):
    return model.hub_order.load(spark, d)


@register("hub_product", S.hub_sql(S.STG_ORDERS, "PRODUCT_HK", "PRODUCT_CODE"))
def q_hub_product(spark, d):
    return model.hub_product.load(spark, d)


# H1 rerun: batch 1 = orders before 1998, batch 2 = every order (a re-delivery
# of batch 1 plus new keys).  The stored hub after both loads equals the
# one-shot hub: re-delivered keys add nothing and keep their first date.
@register("hub_replay", HUB_CUSTOMER_SQL)
def q_hub_replay(spark, d):
    stg = feeds.stg_orders(spark, d)
    b1 = stg.filter(F.col("LOAD_DTS") < F.lit("1998-01-01").cast("timestamp_ntz"))
    hub = load_hub(b1, None, model.HUB_CUSTOMER)
    second = load_hub(stg, hub, model.HUB_CUSTOMER)
    third = load_hub(stg, hub.unionByName(second), model.HUB_CUSTOMER)  # rerun: adds 0 rows
    return hub.unionByName(second).unionByName(third)


# H2: one hub fed by two sources; the first source to deliver a key wins.
HUB_PRODUCT_MULTI_SQL = S.first_row(
    f"""SELECT {S.hk('PRODUCT_CODE')} AS PRODUCT_HK, PRODUCT_CODE, LOAD_DTS, REC_SRC FROM (
        SELECT PRODUCT_CODE, LOAD_DTS, REC_SRC FROM ({S.STG_ORDERS})
        UNION ALL SELECT PRODUCT_CODE, LOAD_DTS, REC_SRC FROM ({S.STG_PARTS}))""",
    "PRODUCT_HK",
    "LOAD_DTS, REC_SRC, PRODUCT_CODE",
)


@register("hub_product_multi", HUB_PRODUCT_MULTI_SQL)
def q_hub_product_multi(spark, d):
    orders = feeds.stg_orders(spark, d).select("PRODUCT_CODE", "LOAD_DTS", "REC_SRC")
    parts = feeds.stg_parts(spark, d).select("PRODUCT_CODE", "LOAD_DTS", "REC_SRC")
    return load_hub([orders, parts], None, model.HUB_PRODUCT)


# H3: collision hub; the source becomes part of the key.
HUB_COLLISION = HubSpec("HUB_CUSTOMER_BY_SOURCE", "CUSTOMER_SRC_HK", ("CUSTOMER_NUMBER",), collision_source=True)


@register(
    "hub_collision",
    S.first_row(
        f"SELECT {S.hk('CUSTOMER_NUMBER', 'REC_SRC')} AS CUSTOMER_SRC_HK, CUSTOMER_NUMBER, LOAD_DTS, REC_SRC FROM ({S.STG_ORDERS})",
        "CUSTOMER_SRC_HK",
        "LOAD_DTS, REC_SRC, CUSTOMER_NUMBER",
    ),
)
def q_hub_collision(spark, d):
    return load_hub(feeds.stg_orders(spark, d), None, HUB_COLLISION)


# H4: stub hub.  Suppliers only appear as a key of the order-line feed; no
# satellite describes them, the hub reserves the key for the links.
@register("hub_stub", S.hub_sql(S.STG_ORDERS, "SUPPLIER_HK", "SUPPLIER_NUMBER"))
def q_hub_stub(spark, d):
    return load_hub(feeds.stg_orders(spark, d), None, model.HUB_SUPPLIER)


# ------------------------------------------------------------------ links (L1)
LNK_ORDER_ITEM_SQL = S.link_sql(
    S.STG_ORDERS, "ORDER_ITEM_HK", [("ORDER_HK", "ORDER_NUMBER"), ("PRODUCT_HK", "PRODUCT_CODE"), ("CUSTOMER_HK", "CUSTOMER_NUMBER")]
)


@register("link_order_item", LNK_ORDER_ITEM_SQL)
def q_link_order_item(spark, d):
    return model.lnk_order_item.load(spark, d)


@register(
    "link_order_payment",
    S.link_sql(S.STG_PAYMENTS, "ORDER_PAYMENT_HK", [("ORDER_HK", "ORDER_NUMBER"), ("PAYMENT_METHOD_HK", "PAYMENT_METHOD_CODE")]),
)
def q_link_order_payment(spark, d):
    return model.lnk_order_payment.load(spark, d)


# Link rerun from a second source: the same combinations from another feed
# are absorbed, the first REC_SRC stays.
@register("link_replay", LNK_ORDER_ITEM_SQL)
def q_link_replay(spark, d):
    stg = model.stage_orders.placed(placing_session(spark), d)
    first = load_link(stg, None, model.LNK_ORDER_ITEM, placed=True)
    other = stg.withColumn("REC_SRC", F.lit("ZZ_LATE_SOURCE"))
    again = load_link(other, first, model.LNK_ORDER_ITEM, placed=True)
    return first.unionByName(again).drop(PLACE)


# L2: hierarchical link, the product hub imported twice (parent, child).
HLNK_PRODUCT_BUNDLE = LinkSpec(
    "HLNK_PRODUCT_BUNDLE",
    "PRODUCT_BUNDLE_HK",
    (("PARENT_PRODUCT_HK", ("PARENT_PRODUCT_CODE",)), ("CHILD_PRODUCT_HK", ("PRODUCT_CODE",))),
)


@register(
    "hlink_part",
    S.link_sql(S.STG_PARTS, "PRODUCT_BUNDLE_HK", [("PARENT_PRODUCT_HK", "PARENT_PRODUCT_CODE"), ("CHILD_PRODUCT_HK", "PRODUCT_CODE")]),
)
def q_hlink_part(spark, d):
    return load_link(feeds.stg_parts(spark, d), None, HLNK_PRODUCT_BUNDLE)


# L3: same-as link, customer name (the key another system uses) -> customer number.
SAL_CUSTOMER_MASTER = LinkSpec(
    "SAL_CUSTOMER_MASTER",
    "CUSTOMER_SAL_HK",
    (("SYNONYM_CUSTOMER_HK", ("FULL_NAME",)), ("MASTER_CUSTOMER_HK", ("CUSTOMER_NUMBER",))),
)
SAL_SQL = S.link_sql(
    S.STG_CUSTOMERS, "CUSTOMER_SAL_HK", [("SYNONYM_CUSTOMER_HK", "FULL_NAME"), ("MASTER_CUSTOMER_HK", "CUSTOMER_NUMBER")]
)


def sal_customer(spark, d):
    return load_link(feeds.stg_customers(spark, d), None, SAL_CUSTOMER_MASTER)


@register("sal_customer", SAL_SQL)
def q_sal_customer(spark, d):
    return sal_customer(spark, d)


# L4: a feed that names customers by their name is resolved to master keys.
def crm_orders_by_name(spark, d):
    o = feeds.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = feeds.table(spark, d, "customer").select("c_custkey", "c_name")
    # Customers grow with the input: merged, never broadcast by the size of their compressed file.
    return o.join(c.hint("merge"), o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").cast("string").alias("ORDER_NUMBER"),
        F.col("c_name").alias("CUSTOMER_NAME"),
        F.col("o_orderdate").alias("LOAD_DTS"),
        F.lit("CRM2").alias("REC_SRC"),
    )


CRM_BY_NAME_SQL = """SELECT CAST(o.o_orderkey AS VARCHAR) AS ORDER_NUMBER, c.c_name AS CUSTOMER_NAME,
    o.o_orderdate AS LOAD_DTS, 'CRM2' AS REC_SRC FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


@register(
    "sal_resolve",
    f"""WITH sal AS ({SAL_SQL}),
    m AS (SELECT * FROM sal QUALIFY row_number() OVER (PARTITION BY SYNONYM_CUSTOMER_HK ORDER BY LOAD_DTS, MASTER_CUSTOMER_HK) = 1),
    f AS (SELECT ORDER_NUMBER, {S.hk('CUSTOMER_NAME')} AS CUSTOMER_HK FROM ({CRM_BY_NAME_SQL}))
    SELECT f.ORDER_NUMBER, coalesce(m.MASTER_CUSTOMER_HK, f.CUSTOMER_HK) AS CUSTOMER_HK
    FROM f LEFT JOIN m ON f.CUSTOMER_HK = m.SYNONYM_CUSTOMER_HK""",
)
def q_sal_resolve(spark, d):
    f = crm_orders_by_name(spark, d).select("ORDER_NUMBER", hash_key("CUSTOMER_NAME").alias("CUSTOMER_HK"))
    return resolve_same_as(f, sal_customer(spark, d), "CUSTOMER_HK", "SYNONYM_CUSTOMER_HK", "MASTER_CUSTOMER_HK")


# Non-historised link: each event is an immutable fact (user x event).
NHL_USER_EVENT = LinkSpec(
    "NHL_USER_EVENT",
    "USER_EVENT_HK",
    (("USER_HK", ("USER_ID",)), ("EVENT_HK", ("EVENT_ID",))),
    payload=("EVENT_TYPE", "VALUE"),
)


@register(
    "nhlink_event",
    S.first_row(
        f"""SELECT {S.hk('USER_ID', 'EVENT_ID')} AS USER_EVENT_HK, {S.hk('USER_ID')} AS USER_HK, {S.hk('EVENT_ID')} AS EVENT_HK,
        LOAD_DTS, REC_SRC, EVENT_TYPE, VALUE FROM ({S.STG_USER_EVENTS})""",
        "USER_EVENT_HK",
        "LOAD_DTS, REC_SRC",
    ),
)
def q_nhlink_event(spark, d):
    stg = feeds.stg_user_events(spark, d)
    first = load_nh_link(stg, None, NHL_USER_EVENT)
    again = load_nh_link(stg, first, NHL_USER_EVENT)  # re-delivery adds nothing
    return first.unionByName(again)


# Exploration link: which customers bought from which suppliers.
@register(
    "elink",
    f"""SELECT {S.hk('CUSTOMER_HK', 'SUPPLIER_HK')} AS CUSTOMER_SUPPLIER_HK, CUSTOMER_HK, SUPPLIER_HK, LOAD_DTS, REC_SRC FROM (
        SELECT {S.hk('CUSTOMER_NUMBER')} AS CUSTOMER_HK, {S.hk('SUPPLIER_NUMBER')} AS SUPPLIER_HK, LOAD_DTS, REC_SRC FROM ({S.STG_ORDERS}))
    QUALIFY row_number() OVER (PARTITION BY CUSTOMER_HK, SUPPLIER_HK ORDER BY LOAD_DTS, REC_SRC) = 1""",
)
def q_elink(spark, d):
    stg = feeds.stg_orders(spark, d).select(
        hash_key("CUSTOMER_NUMBER").alias("CUSTOMER_HK"), hash_key("SUPPLIER_NUMBER").alias("SUPPLIER_HK"), "LOAD_DTS", "REC_SRC"
    )
    return exploration_link(stg, "CUSTOMER_SUPPLIER_HK", ["CUSTOMER_HK", "SUPPLIER_HK"])


# Transaction link: order x product x customer x transaction date.
TLNK_PURCHASE = LinkSpec(
    "TLNK_PURCHASE",
    "PURCHASE_HK",
    (
        ("ORDER_HK", ("ORDER_NUMBER",)),
        ("PRODUCT_HK", ("PRODUCT_CODE",)),
        ("CUSTOMER_HK", ("CUSTOMER_NUMBER",)),
        ("DATE_HK", ("ORDER_DATE",)),
    ),
)


@register(
    "tlink",
    S.link_sql(
        f"SELECT *, strftime(LOAD_DTS, '%Y-%m-%d') AS ORDER_DATE FROM ({S.STG_ORDERS})",
        "PURCHASE_HK",
        [("ORDER_HK", "ORDER_NUMBER"), ("PRODUCT_HK", "PRODUCT_CODE"), ("CUSTOMER_HK", "CUSTOMER_NUMBER"), ("DATE_HK", "ORDER_DATE")],
    ),
)
def q_tlink(spark, d):
    stg = feeds.stg_orders(spark, d, placed=True).withColumn("ORDER_DATE", F.date_format("LOAD_DTS", "yyyy-MM-dd"))
    return load_link(stg, None, TLNK_PURCHASE, placed=True).drop(PLACE)


# Grain coarsening: order x customer from the order-item link.
@register(
    "link_coarse",
    f"""WITH l AS ({LNK_ORDER_ITEM_SQL}),
    c AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY ORDER_HK, CUSTOMER_HK ORDER BY LOAD_DTS, REC_SRC) = 1)
    SELECT {S.hk('ORDER_HK', 'CUSTOMER_HK')} AS ORDER_CUSTOMER_HK, ORDER_HK, CUSTOMER_HK, LOAD_DTS, REC_SRC FROM c""",
)
def q_link_coarse(spark, d):
    return coarsen(model.lnk_order_item(spark, d), "ORDER_CUSTOMER_HK", ["ORDER_HK", "CUSTOMER_HK"])


# Business hub and business link (soft rules over the raw vault).
# Business hub: customers named in the CRM feed, resolved through the
# same-as link to master keys, then loaded like any hub.
@register(
    "bhub_customer",
    f"""WITH sal AS ({SAL_SQL}),
    m AS (SELECT * FROM sal QUALIFY row_number() OVER (PARTITION BY SYNONYM_CUSTOMER_HK ORDER BY LOAD_DTS, MASTER_CUSTOMER_HK) = 1),
    f AS (SELECT {S.hk('CUSTOMER_NAME')} AS SYN_HK, CUSTOMER_NAME, LOAD_DTS, REC_SRC FROM ({CRM_BY_NAME_SQL})),
    n AS (SELECT {S.hk('c_custkey')} AS K, CAST(c_custkey AS VARCHAR) AS CUSTOMER_NUMBER FROM customer),
    r AS (SELECT coalesce(m.MASTER_CUSTOMER_HK, f.SYN_HK) AS CUSTOMER_HK, coalesce(n.CUSTOMER_NUMBER, f.CUSTOMER_NAME) AS CUSTOMER_NUMBER,
                 f.LOAD_DTS, f.REC_SRC FROM f LEFT JOIN m ON f.SYN_HK = m.SYNONYM_CUSTOMER_HK LEFT JOIN n ON n.K = m.MASTER_CUSTOMER_HK)
    SELECT CUSTOMER_HK, CUSTOMER_NUMBER, LOAD_DTS, REC_SRC FROM r
    QUALIFY row_number() OVER (PARTITION BY CUSTOMER_HK ORDER BY LOAD_DTS, REC_SRC, CUSTOMER_NUMBER) = 1""",
)
def q_bhub_customer(spark, d):
    f = crm_orders_by_name(spark, d).select(hash_key("CUSTOMER_NAME").alias("CUSTOMER_HK"), "CUSTOMER_NAME", "LOAD_DTS", "REC_SRC")
    r = resolve_same_as(f, sal_customer(spark, d), "CUSTOMER_HK", "SYNONYM_CUSTOMER_HK", "MASTER_CUSTOMER_HK")
    # The business key of a resolved customer is its number; a name without a master stays its own key.
    numbers = feeds.stg_customers(spark, d).select(hash_key("CUSTOMER_NUMBER").alias("CUSTOMER_HK"), "CUSTOMER_NUMBER")
    r = packed(r, ["CUSTOMER_HK"]).join(packed(numbers, ["CUSTOMER_HK"]).hint("merge"), "CUSTOMER_HK", "left").select(F.coalesce("CUSTOMER_NUMBER", "CUSTOMER_NAME").alias("CUSTOMER_NUMBER"), "LOAD_DTS", "REC_SRC")
    return load_hub(r, None, model.HUB_CUSTOMER)


# Business link: order enriched with the customer's nation (a derived relation).
BLNK_ORDER_NATION = LinkSpec(
    "BLNK_ORDER_NATION", "ORDER_NATION_HK", (("ORDER_HK", ("ORDER_NUMBER",)), ("NATION_HK", ("NATION_NAME",)))
)


@register(
    "blink_order_nation",
    S.link_sql(
        f"""SELECT o.ORDER_NUMBER, a.NATION_NAME, o.LOAD_DTS, o.REC_SRC FROM ({S.STG_ORDERS}) o
            JOIN ({S.STG_CUSTOMER_ADDRESS}) a ON a.CUSTOMER_NUMBER = o.CUSTOMER_NUMBER""",
        "ORDER_NATION_HK",
        [("ORDER_HK", "ORDER_NUMBER"), ("NATION_HK", "NATION_NAME")],
    ),
)
def q_blink_order_nation(spark, d):
    o = feeds.stg_orders(spark, d).select("ORDER_NUMBER", "CUSTOMER_NUMBER", "LOAD_DTS", "REC_SRC")
    a = feeds.stg_customer_address(spark, d).select("CUSTOMER_NUMBER", "NATION_NAME")
    return load_link(o.join(a, "CUSTOMER_NUMBER"), None, BLNK_ORDER_NATION)


# L4 over chains: customers merged again and again (a number into its third part, except those
# divisible by 4), and three customers merged in a circle.
MERGES_SQL = """SELECT c_custkey AS s, CASE WHEN c_custkey <= 3 THEN c_custkey % 3 + 1 ELSE c_custkey // 3 END AS m
    FROM customer WHERE c_custkey <= 3 OR c_custkey % 4 <> 0"""


@register(
    "sal_chain",
    f"""WITH RECURSIVE merges AS ({MERGES_SQL}),
    walk AS (SELECT s, m AS place, 1 AS n FROM merges UNION ALL SELECT walk.s, merges.m, n + 1 FROM walk JOIN merges ON walk.place = merges.s WHERE n < 60),
    ends AS (SELECT s, max(n) = 60 AS looped, arg_max(place, n) AS ending FROM walk GROUP BY s)
    SELECT {S.hk('e.s')} AS SYNONYM_CUSTOMER_HK, e.looped AS CYCLE,
           CASE WHEN e.looped THEN (SELECT min({S.hk('w.place')}) FROM walk w WHERE w.s = e.s AND w.n > 50) ELSE {S.hk('e.ending')} END AS MASTER_CUSTOMER_HK
    FROM ends e""",
)
def q_sal_chain(spark, d):
    c = F.col("c_custkey")
    into = F.when(c <= 3, c % 3 + 1).otherwise(F.floor(c / 3))
    feed = feeds.table(spark, d, "customer").filter((c <= 3) | (c % 4 != 0)).select(
        c.cast("string").alias("FULL_NAME"), into.cast("long").cast("string").alias("CUSTOMER_NUMBER"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("LOAD_DTS"), F.lit("MDM").alias("REC_SRC"))
    sal = load_link(feed, None, SAL_CUSTOMER_MASTER)
    return same_as_masters(sal, "SYNONYM_CUSTOMER_HK", "MASTER_CUSTOMER_HK")


# L2 closure: parts as a tree of four children each (five to seven levels), all pairs of a part and one above it.
@register(
    "hlink_ancestors",
    f"""WITH RECURSIVE up AS (
        SELECT p_partkey AS c, (p_partkey - 2) // 4 + 1 AS a, 1::BIGINT AS n FROM part WHERE p_partkey > 1
        UNION ALL SELECT c, (a - 2) // 4 + 1, n + 1 FROM up WHERE a > 1)
    SELECT {S.hk('c')} AS CHILD_PRODUCT_HK, {S.hk('a')} AS PARENT_PRODUCT_HK, n AS DEPTH FROM up""",
)
def q_hlink_ancestors(spark, d):
    p = F.col("p_partkey")
    feed = feeds.table(spark, d, "part").filter(p > 1).select(
        p.cast("string").alias("PRODUCT_CODE"), (F.floor((p - 2) / 4) + 1).cast("string").alias("PARENT_PRODUCT_CODE"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("LOAD_DTS"), F.lit("PIM").alias("REC_SRC"))
    return ancestors(load_link(feed, None, HLNK_PRODUCT_BUNDLE), "CHILD_PRODUCT_HK", "PARENT_PRODUCT_HK")


# Loads from the stored stage L2 take its hashes.
@register("hub_prehashed", S.hub_sql(S.STG_ORDERS, "CUSTOMER_HK", "CUSTOMER_NUMBER"))
def q_hub_prehashed(spark, d):
    return load_hub(model.stage_orders_hashed(spark, d), None, model.HUB_CUSTOMER)


@register("link_prehashed", LNK_ORDER_ITEM_SQL)
def q_link_prehashed(spark, d):
    return load_link(model.stage_orders_hashed.placed(spark, d), None, model.LNK_ORDER_ITEM, placed=True).drop(PLACE)
