"""SQL fragments (DuckDB dialect) that mirror the staging feeds and the hash
recipe, so each oracle is written from the rule, not from the Spark plan."""

from __future__ import annotations


def hk(*exprs: str) -> str:
    parts = [f"upper(trim(CAST({e} AS VARCHAR)))" for e in exprs]
    return "sha256(" + " || '|' || ".join(parts) + ")"


def hd(*exprs: str) -> str:
    parts = [f"coalesce(CAST({e} AS VARCHAR), '')" for e in exprs]
    return "sha256(" + " || '|' || ".join(parts) + ")"


FIXED = "TIMESTAMP '2024-01-01 00:00:00'"

STG_ORDERS = """
SELECT CAST(o.o_custkey AS VARCHAR) AS CUSTOMER_NUMBER,
       CAST(o.o_orderkey AS VARCHAR) AS ORDER_NUMBER,
       CAST(l.l_partkey AS VARCHAR) AS PRODUCT_CODE,
       CAST(l.l_suppkey AS VARCHAR) AS SUPPLIER_NUMBER,
       CAST(l.l_linenumber AS VARCHAR) AS LINE_NUMBER,
       CAST(l.l_suppkey AS VARCHAR) || '|' || CAST(l.l_linenumber AS VARCHAR) AS LINE_SSQN,
       CAST(l.l_quantity AS DECIMAL(18,2)) AS QUANTITY,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS EXTENDED_PRICE,
       CAST(l.l_discount AS DECIMAL(4,2)) AS DISCOUNT_PCT,
       o.o_orderdate AS LOAD_DTS,
       'S' || CAST(l.l_suppkey % 3 AS VARCHAR) AS REC_SRC
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

STG_PAYMENTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_NUMBER, o_orderpriority AS PAYMENT_METHOD_CODE,
       o_orderdate AS LOAD_DTS, 'PAY' AS REC_SRC
FROM orders
"""

STG_ORDER_HEADERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_NUMBER, o_orderstatus AS ORDER_STATUS,
       CAST(o_totalprice AS DECIMAL(18,2)) AS TOTAL_PRICE, o_orderpriority AS PRIORITY,
       o_orderdate AS LOAD_DTS, 'OMS' AS REC_SRC
FROM orders
"""

STG_CHANNELS = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS ORDER_NUMBER, c.c_mktsegment AS CHANNEL_CODE,
       o.o_orderdate AS LOAD_DTS, 'CRM' AS REC_SRC
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

STG_CUSTOMERS = f"""
SELECT CAST(c_custkey AS VARCHAR) AS CUSTOMER_NUMBER, c_name AS FULL_NAME, c_mktsegment AS LOYALTY_TIER,
       CAST(c_acctbal AS DECIMAL(18,2)) AS ACCOUNT_BALANCE, c_nationkey AS NATION_KEY,
       {FIXED} AS LOAD_DTS, 'CRM' AS REC_SRC
FROM customer
"""

STG_CUSTOMER_ADDRESS = f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS CUSTOMER_NUMBER, n.n_name AS NATION_NAME, r.r_name AS REGION_NAME,
       {FIXED} AS LOAD_DTS, 'CRM' AS REC_SRC
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
     LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

STG_PARTS = f"""
SELECT CAST(p_partkey AS VARCHAR) AS PRODUCT_CODE, p_name AS PRODUCT_NAME, p_type AS CATEGORY,
       p_brand AS BRAND, CAST(p_retailprice AS DECIMAL(18,2)) AS UNIT_PRICE,
       CAST(p_partkey // 10 AS VARCHAR) AS PARENT_PRODUCT_CODE,
       {FIXED} AS LOAD_DTS, 'PIM' AS REC_SRC
FROM part
"""

STG_USER_EVENTS = """
SELECT CAST(user_id AS VARCHAR) AS USER_ID, CAST(event_id AS VARCHAR) AS EVENT_ID, event_type AS EVENT_TYPE,
       CAST(value AS DECIMAL(18,2)) AS VALUE, props AS PROPS, ts AS LOAD_DTS, 'WEB' AS REC_SRC
FROM events
"""

STG_CONVERSATIONS = f"""
SELECT CAST(conv_id AS VARCHAR) AS CONV_ID, turn AS SSQN, role AS ROLE, text AS TEXT,
       {FIXED} AS LOAD_DTS, 'CHAT' AS REC_SRC
FROM conversations
"""


def first_row(select: str, key: str, order: str) -> str:
    """Rows of ``select`` reduced to the first per ``key`` by ``order``."""
    return f"SELECT * FROM ({select}) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


def hub_sql(stg: str, hk_name: str, bk: str) -> str:
    sel = f"SELECT {hk(bk)} AS {hk_name}, CAST({bk} AS VARCHAR) AS {bk}, LOAD_DTS, REC_SRC FROM ({stg}) WHERE {bk} IS NOT NULL AND trim({bk}) <> ''"
    return first_row(sel, hk_name, f"LOAD_DTS, REC_SRC, {bk}")


def link_sql(stg: str, hk_name: str, refs: list[tuple[str, str]]) -> str:
    bks = [b for _, b in refs]
    cols = ", ".join(f"{hk(b)} AS {h}" for h, b in refs)
    sel = f"SELECT {hk(*bks)} AS {hk_name}, {cols}, LOAD_DTS, REC_SRC FROM ({stg})"
    return first_row(sel, hk_name, "LOAD_DTS, REC_SRC")


def timeline_sql(staged: str, part: str) -> str:
    """One-shot timeline load of ``staged`` (must have HASH_DIFF, LOAD_DTS):
    keep rows whose HASH_DIFF differs from the previous row of ``part``."""
    return f"""
SELECT * EXCLUDE (_prev) FROM (
  SELECT *, lag(HASH_DIFF) OVER (PARTITION BY {part} ORDER BY LOAD_DTS) AS _prev FROM ({staged})
) WHERE _prev IS NULL OR _prev <> HASH_DIFF
"""
