"""Satellite and effectivity queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strongroom.functions.hashing import hash_key
from strongroom.operators.effectivity import (
    detect_deletes,
    driving_key_changes,
    driving_key_effectivity,
    last_observed,
    load_effectivity,
    observed_effectivity,
    runs_as_known,
)
from strongroom.operators.hub import hub_rejects
from strongroom.operators.link import link_rejects
from strongroom.operators.sat_store import SatStore
from strongroom.operators.satellite import (
    as_of,
    as_of_bitemporal,
    change_rate,
    current,
    end_dated,
    load_multi_active_sets,
    load_sat,
    merge_sats,
    sat_rejects,
    split_sat,
)
from strongroom.operators.specs import PLACE, LinkSpec
from strongroom.operators.staging import window_extract
from strongroom.sources import feeds
from strongroom.sources.io import cut_lineage, scratch_path
from strongroom.suite import model
from strongroom.suite import sqlbits as S
from strongroom.suite.registry import register

ST_STATE = f"SELECT {S.hk('USER_ID')} AS USER_HK, LOAD_DTS, {S.hd('EVENT_TYPE')} AS HASH_DIFF, REC_SRC, EVENT_TYPE FROM ({S.STG_USER_EVENTS})"
SAT_STATE_SQL = S.timeline_sql(ST_STATE, "USER_HK")
ST_VALUE = f"""SELECT {S.hk('USER_ID')} AS USER_HK, LOAD_DTS, {S.hd('VALUE')} AS HASH_DIFF, REC_SRC, VALUE
    FROM ({S.STG_USER_EVENTS})"""
SAT_VALUE_SQL = S.timeline_sql(ST_VALUE, "USER_HK")
ST_ACTIVITY = f"""SELECT {S.hk('USER_ID')} AS USER_HK, LOAD_DTS, {S.hd('EVENT_TYPE', 'VALUE', 'PROPS')} AS HASH_DIFF, REC_SRC,
    EVENT_TYPE, VALUE, PROPS FROM ({S.STG_USER_EVENTS})"""
SAT_ACTIVITY_SQL = S.timeline_sql(ST_ACTIVITY, "USER_HK")


def T(s: str):
    return F.lit(s).cast("timestamp_ntz")


# Literal 'latest' mode.  Batch 1 (before Jan 15) goes into an empty
# satellite whole; batch 2 (from Jan 13, overlapping) is compared only with
# the latest stored row per key.
@register(
    "sat_latest_mode",
    f"""WITH st AS ({ST_STATE}),
    b1 AS (SELECT * FROM st WHERE LOAD_DTS < TIMESTAMP '2024-01-15'),
    ls AS (SELECT USER_HK, HASH_DIFF AS SHD FROM b1 QUALIFY row_number() OVER (PARTITION BY USER_HK ORDER BY LOAD_DTS DESC) = 1),
    b2 AS (SELECT * FROM st WHERE LOAD_DTS >= TIMESTAMP '2024-01-13')
    SELECT * FROM b1
    UNION ALL
    SELECT b2.* FROM b2 LEFT JOIN ls ON ls.USER_HK = b2.USER_HK WHERE ls.USER_HK IS NULL OR ls.SHD <> b2.HASH_DIFF""",
)
def q_sat_latest_mode(spark, d):
    stg = feeds.stg_user_events(spark, d)
    b1 = load_sat(stg.filter(F.col("LOAD_DTS") < T("2024-01-15")), None, model.SAT_USER_STATE, mode="latest")
    b2 = load_sat(stg.filter(F.col("LOAD_DTS") >= T("2024-01-13")), b1, model.SAT_USER_STATE, mode="latest")
    return b1.unionByName(b2)


# S2 (+G5): timeline load, one shot: 8,016 versions of 10,000 events at sf0.01.
@register("sat_user_state", SAT_STATE_SQL)
def q_sat_user_state(spark, d):
    return model.sat_user_state.load(spark, d)


def user_state_store(spark) -> SatStore:
    return SatStore(spark, scratch_path(spark, "sat_user_state_store"), model.SAT_USER_STATE)


# S2 replay: batch 1, overlapping batch 2, then batch 1 again -> one-shot result.
@register("sat_replay", SAT_STATE_SQL)
def q_sat_replay(spark, d):
    stg = feeds.stg_user_events(spark, d)
    b1 = stg.filter(F.col("LOAD_DTS") < T("2024-01-15"))
    b2 = stg.filter(F.col("LOAD_DTS") >= T("2024-01-10"))
    sat = cut_lineage(load_sat(b1, None, model.SAT_USER_STATE))
    sat = cut_lineage(sat.unionByName(load_sat(b2, sat, model.SAT_USER_STATE)))
    return sat.unionByName(load_sat(b1, sat, model.SAT_USER_STATE))


# The satellite stored by load date, so a load reads from its first day on.
# G8 + S2: daily re-extract of a rolling 96-hour window; unchanged rows add
# nothing, so overlapping windows equal the one-shot load.
@register("sat_window", SAT_STATE_SQL)
def q_sat_window(spark, d):
    stg = feeds.stg_user_events(spark, d)
    # The history up to 9 days before the feed's end in one load, then an extract every 3 days until past the end.
    end = stg.agg(F.max("LOAD_DTS").cast("date")).first()[0] or dt.date(1970, 1, 1)
    days = [end + dt.timedelta(days=k) for k in (-8, -5, -2, 1)]
    store = user_state_store(spark)
    store.load(stg.filter(F.col("LOAD_DTS") < F.lit(days[0] - dt.timedelta(days=2)).cast("timestamp_ntz")))
    for as_of_day in days:
        store.load(window_extract(stg, "LOAD_DTS", as_of_day.isoformat(), hours=96))
    return store.read()


def batch_sql(stored: str, batch: str) -> str:
    """The satellite after a timeline load of ``batch``: stored rows stay, a new row is kept where its predecessor differs."""
    return f"""
        SELECT * EXCLUDE (is_new, p) FROM (
            SELECT *, lag(HASH_DIFF) OVER (PARTITION BY USER_HK ORDER BY LOAD_DTS) AS p FROM (
                SELECT *, false AS is_new FROM ({stored})
                UNION ALL SELECT *, true FROM ({batch}) b WHERE NOT EXISTS (
                    SELECT 1 FROM ({stored}) s WHERE s.USER_HK = b.USER_HK AND s.LOAD_DTS = b.LOAD_DTS)))
        WHERE NOT is_new OR p IS NULL OR p <> HASH_DIFF"""


# S2 with a late batch: three days of the middle come after the end; each late row is
# compared with the versions around it, the stored ones stay.  Then the last days come again:
# a row that equalled its predecessor may now follow a late version and differ from it.
LATE = "LOAD_DTS >= TIMESTAMP '2024-01-08' AND LOAD_DTS < TIMESTAMP '2024-01-11'"


@register(
    "sat_late",
    f"""WITH st AS MATERIALIZED ({ST_STATE}),
    on_time AS MATERIALIZED ({S.timeline_sql(f"SELECT * FROM st WHERE NOT ({LATE})", "USER_HK")}),
    late AS MATERIALIZED ({batch_sql("SELECT * FROM on_time", f"SELECT * FROM st WHERE {LATE}")})
    {batch_sql("SELECT * FROM late", "SELECT * FROM st WHERE LOAD_DTS >= TIMESTAMP '2024-01-18'")}""",
)
def q_sat_late(spark, d):
    stg = feeds.stg_user_events(spark, d)
    t = F.col("LOAD_DTS")
    late = (t >= T("2024-01-08")) & (t < T("2024-01-11"))
    store = user_state_store(spark)
    store.load(stg.filter((t < T("2024-01-13")) & ~late))
    for part in ((t >= T("2024-01-12")) & (t < T("2024-01-20")), t >= T("2024-01-18"), late, t >= T("2024-01-18")):
        store.load(stg.filter(part))
    return store.read()


# S3: current row per key.
@register("sat_current", S.first_row(SAT_STATE_SQL, "USER_HK", "LOAD_DTS DESC"))
def q_sat_current(spark, d):
    return current(model.sat_user_state(spark, d), ["USER_HK"])


# S4 per row: conversations delivered open (turns 0-1, Jan 1) and again in
# full (Jan 2); each (conversation, turn) is its own timeline.
ST_CONV = f"""SELECT {S.hk('CONV_ID')} AS CONV_HK, SSQN, LOAD_DTS, {S.hd('ROLE', 'TEXT')} AS HASH_DIFF, REC_SRC, ROLE, TEXT FROM (
    SELECT * FROM ({S.STG_CONVERSATIONS}) WHERE SSQN <= 1
    UNION ALL SELECT * REPLACE (TIMESTAMP '2024-01-02 00:00:00' AS LOAD_DTS) FROM ({S.STG_CONVERSATIONS}))"""


def _conv_batches(spark, d):
    stg = feeds.stg_conversations(spark, d)
    return stg.filter(F.col("SSQN") <= 1), stg.withColumn("LOAD_DTS", T("2024-01-02 00:00:00"))


@register("sat_conversation", S.timeline_sql(ST_CONV, "CONV_HK, SSQN"))
def q_sat_conversation(spark, d):
    b1, b2 = _conv_batches(spark, d)
    sat = load_sat(b1, None, model.SAT_CONVERSATION)
    return sat.unionByName(load_sat(b2, sat, model.SAT_CONVERSATION))


# S4 whole set: a set that gains a member is stored again in full.
@register(
    "sat_conversation_set",
    f"""WITH st AS ({ST_CONV}),
    sets AS (SELECT CONV_HK, LOAD_DTS, string_agg(CAST(SSQN AS VARCHAR) || ':' || HASH_DIFF, ',' ORDER BY SSQN) AS SIG FROM st GROUP BY ALL),
    ch AS (SELECT CONV_HK, LOAD_DTS FROM (SELECT *, lag(SIG) OVER (PARTITION BY CONV_HK ORDER BY LOAD_DTS) AS P FROM sets)
           WHERE P IS NULL OR P <> SIG)
    SELECT st.* FROM st SEMI JOIN ch ON st.CONV_HK = ch.CONV_HK AND st.LOAD_DTS = ch.LOAD_DTS""",
)
def q_sat_conversation_set(spark, d):
    b1, b2 = _conv_batches(spark, d)
    sat = load_multi_active_sets(b1, None, model.SAT_CONVERSATION)
    return sat.unionByName(load_multi_active_sets(b2, sat, model.SAT_CONVERSATION))


# Link satellite, multi-active by supplier and line number.
ST_DETAILS = f"""SELECT {S.hk('ORDER_NUMBER', 'PRODUCT_CODE', 'CUSTOMER_NUMBER')} AS ORDER_ITEM_HK, LINE_SSQN, LOAD_DTS,
    {S.hd('QUANTITY', 'EXTENDED_PRICE', 'DISCOUNT_PCT', 'CAST(EXTENDED_PRICE * (1 - DISCOUNT_PCT) AS DECIMAL(18,4))')} AS HASH_DIFF,
    REC_SRC, QUANTITY, EXTENDED_PRICE, DISCOUNT_PCT, CAST(EXTENDED_PRICE * (1 - DISCOUNT_PCT) AS DECIMAL(18,4)) AS LINE_TOTAL
    FROM ({S.STG_ORDERS})"""


@register("sat_order_item", S.timeline_sql(ST_DETAILS, "ORDER_ITEM_HK, LINE_SSQN"))
def q_sat_order_item(spark, d):
    return model.sat_order_item_details.load(spark, d)


# Status of order lines; the ship date is stored but not hashed, so it
# makes no version of its own.
@register(
    "sat_order_status",
    S.timeline_sql(
        f"""SELECT {S.hk('o.o_orderkey', 'l.l_partkey', 'o.o_custkey')} AS ORDER_ITEM_HK,
            CAST(l.l_suppkey AS VARCHAR) || '|' || CAST(l.l_linenumber AS VARCHAR) AS LINE_SSQN, o.o_orderdate AS LOAD_DTS,
            {S.hd('l.l_returnflag', 'l.l_linestatus')} AS HASH_DIFF, 'S' || CAST(l.l_suppkey % 3 AS VARCHAR) AS REC_SRC,
            l.l_returnflag AS RETURN_FLAG, l.l_linestatus AS LINE_STATUS, l.l_shipdate AS SHIP_DATE
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
        "ORDER_ITEM_HK, LINE_SSQN",
    ),
)
def q_sat_order_status(spark, d):
    return load_sat(feeds.stg_order_status(spark, d), None, model.SAT_ORDER_STATUS, hot_key_bucket=model.LINE_BUCKET)


# S1/S2 on a hub of orders: order header satellite.
@register(
    "sat_order_header",
    S.timeline_sql(
        f"""SELECT {S.hk('ORDER_NUMBER')} AS ORDER_HK, LOAD_DTS, {S.hd('ORDER_STATUS', 'TOTAL_PRICE', 'PRIORITY')} AS HASH_DIFF,
        REC_SRC, ORDER_STATUS, TOTAL_PRICE, PRIORITY FROM ({S.STG_ORDER_HEADERS})""",
        "ORDER_HK",
    ),
)
def q_sat_order_header(spark, d):
    return load_sat(feeds.stg_order_headers(spark, d), None, model.SAT_ORDER_HEADER)


# End dates at read time.
@register(
    "sat_end_dated",
    f"SELECT *, lead(LOAD_DTS) OVER (PARTITION BY USER_HK ORDER BY LOAD_DTS) AS LOAD_END_DTS FROM ({SAT_STATE_SQL})",
)
def q_sat_end_dated(spark, d):
    return end_dated(model.sat_user_state(spark, d), ["USER_HK"])


# Version in force at one moment.
@register(
    "sat_as_of",
    S.first_row(f"SELECT * FROM ({SAT_STATE_SQL}) WHERE LOAD_DTS <= TIMESTAMP '2024-01-15 12:00:00'", "USER_HK", "LOAD_DTS DESC"),
)
def q_sat_as_of(spark, d):
    return as_of(model.sat_user_state(spark, d), ["USER_HK"], "2024-01-15 12:00:00")


# Two time axes.  Events are applied at ts and loaded by the nightly
# batch (midnight after ts).  As known on Jan 15 for business time Jan 12 noon.
def _bitemporal(spark, d):
    e = feeds.stg_user_events(spark, d)
    return e.select(
        hash_key("USER_ID").alias("USER_HK"),
        F.col("LOAD_DTS").alias("APPLIED_DTS"),
        F.date_add(F.to_date("LOAD_DTS"), 1).cast("timestamp_ntz").alias("LOAD_DTS"),
        "EVENT_TYPE",
    )


@register(
    "sat_bitemporal",
    f"""SELECT * FROM (SELECT {S.hk('USER_ID')} AS USER_HK, LOAD_DTS AS APPLIED_DTS,
        date_trunc('day', LOAD_DTS) + INTERVAL 1 DAY AS LOAD_DTS, EVENT_TYPE FROM ({S.STG_USER_EVENTS}))
    WHERE LOAD_DTS <= TIMESTAMP '2024-01-15 00:00:00' AND APPLIED_DTS <= TIMESTAMP '2024-01-12 12:00:00'
    QUALIFY row_number() OVER (PARTITION BY USER_HK ORDER BY APPLIED_DTS DESC, LOAD_DTS DESC) = 1""",
)
def q_sat_bitemporal(spark, d):
    return as_of_bitemporal(_bitemporal(spark, d), ["USER_HK"], "2024-01-15 00:00:00", "2024-01-12 12:00:00")


# Split the wide activity satellite by rate of change.
def _split_sql(name: str, cols: list[str]) -> str:
    return f"""SELECT '{name}' AS SPLIT_NAME, USER_HK, LOAD_DTS, HASH_DIFF FROM (
        SELECT *, lag(HASH_DIFF) OVER (PARTITION BY USER_HK ORDER BY LOAD_DTS) AS _p FROM (
            SELECT USER_HK, LOAD_DTS, {S.hd(*cols)} AS HASH_DIFF FROM ({SAT_ACTIVITY_SQL})))
        WHERE _p IS NULL OR _p <> HASH_DIFF"""


@register(
    "sat_split",
    _split_sql("STATE", ["EVENT_TYPE"]) + " UNION ALL " + _split_sql("DETAIL", ["VALUE", "PROPS"]),
)
def q_sat_split(spark, d):
    parts = split_sat(model.sat_user_activity(spark, d), ["USER_HK"], {"STATE": ["EVENT_TYPE"], "DETAIL": ["VALUE", "PROPS"]})
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("SPLIT_NAME"), "USER_HK", "LOAD_DTS", "HASH_DIFF")
        out = df if out is None else out.unionByName(df)
    return out


# Merge the state and value satellites without losing a version.
@register(
    "sat_merge",
    f"""WITH a AS ({SAT_STATE_SQL}), b AS ({SAT_VALUE_SQL}),
    t AS (SELECT USER_HK, LOAD_DTS FROM a UNION SELECT USER_HK, LOAD_DTS FROM b),
    m AS (SELECT t.USER_HK, t.LOAD_DTS,
            (SELECT a.EVENT_TYPE FROM a WHERE a.USER_HK = t.USER_HK AND a.LOAD_DTS = (SELECT max(LOAD_DTS) FROM a a2 WHERE a2.USER_HK = t.USER_HK AND a2.LOAD_DTS <= t.LOAD_DTS)) AS EVENT_TYPE,
            coalesce((SELECT a.REC_SRC FROM a WHERE a.USER_HK = t.USER_HK AND a.LOAD_DTS = t.LOAD_DTS),
                     (SELECT b.REC_SRC FROM b WHERE b.USER_HK = t.USER_HK AND b.LOAD_DTS = t.LOAD_DTS)) AS REC_SRC,
            (SELECT b.VALUE FROM b WHERE b.USER_HK = t.USER_HK AND b.LOAD_DTS = (SELECT max(LOAD_DTS) FROM b b2 WHERE b2.USER_HK = t.USER_HK AND b2.LOAD_DTS <= t.LOAD_DTS)) AS VALUE
          FROM t),
    h AS (SELECT *, {S.hd('EVENT_TYPE', 'VALUE')} AS HASH_DIFF FROM m)
    SELECT * EXCLUDE (_p) FROM (SELECT *, lag(HASH_DIFF) OVER (PARTITION BY USER_HK ORDER BY LOAD_DTS) AS _p FROM h)
    WHERE _p IS NULL OR _p <> HASH_DIFF""",
)
def q_sat_merge(spark, d):
    a = model.sat_user_state(spark, d)
    b = model.sat_user_value(spark, d)
    return merge_sats(a, b, "USER_HK", ["EVENT_TYPE"], ["VALUE"])


# Change rate per column of the wide activity history (raw events).
@register(
    "sat_change_rate",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS COLUMN_NAME, CAST(sum(CASE WHEN _p_{c} IS NOT DISTINCT FROM {c} AND _rn > 1 THEN 0 ELSE 1 END) AS BIGINT) AS CHANGES,
            count(*) AS ROWS, count(DISTINCT USER_HK) AS KEYS,
            round(sum(CASE WHEN _p_{c} IS NOT DISTINCT FROM {c} AND _rn > 1 THEN 0 ELSE 1 END) / count(DISTINCT USER_HK), 4) AS CHANGES_PER_KEY
            FROM (SELECT *, lag({c}) OVER w AS _p_{c}, row_number() OVER w AS _rn FROM ({ST_ACTIVITY})
                  WINDOW w AS (PARTITION BY USER_HK ORDER BY LOAD_DTS))"""
        for c in ("EVENT_TYPE", "VALUE", "PROPS")
    ),
)
def q_sat_change_rate(spark, d):
    from strongroom.operators.satellite import stage_sat

    staged = stage_sat(feeds.stg_user_events(spark, d), model.SAT_USER_ACTIVITY)
    return change_rate(staged, ["USER_HK"], ["EVENT_TYPE", "VALUE", "PROPS"])


# Driving key user, other key event type.
DK_SQL = f"""WITH b AS (SELECT USER_ID, EVENT_TYPE, LOAD_DTS AS _t, REC_SRC,
        lag(EVENT_TYPE) OVER (PARTITION BY USER_ID ORDER BY LOAD_DTS) AS _p FROM ({S.STG_USER_EVENTS})),
    s AS (SELECT *, lead(_t) OVER (PARTITION BY USER_ID ORDER BY _t) AS _n FROM b WHERE _p IS NULL OR _p <> EVENT_TYPE),
    k AS (SELECT {S.hk('USER_ID', 'EVENT_TYPE')} AS USER_STATE_HK, {S.hk('USER_ID')} AS DRIVING_HK, USER_ID, EVENT_TYPE,
          _t AS BEGIN_DTS, _n, REC_SRC FROM s)
    SELECT USER_STATE_HK, DRIVING_HK, USER_ID, EVENT_TYPE, BEGIN_DTS AS LOAD_DTS, BEGIN_DTS, CAST(NULL AS TIMESTAMP) AS END_DTS, 0 AS IS_DELETED, REC_SRC FROM k
    UNION ALL
    SELECT USER_STATE_HK, DRIVING_HK, USER_ID, EVENT_TYPE, _n AS LOAD_DTS, BEGIN_DTS, _n AS END_DTS, 0 AS IS_DELETED, REC_SRC FROM k WHERE _n IS NOT NULL"""


def _driving(spark, d):
    return driving_key_effectivity(feeds.stg_user_events(spark, d), "USER_STATE_HK", ["USER_ID"], ["EVENT_TYPE"])


@register("driving_key", DK_SQL)
def q_driving_key(spark, d):
    return _driving(spark, d)


# S7 in batches: each batch of the feed meets the rows stored by those before it.
@register("driving_key_batches", DK_SQL)
def q_driving_key_batches(spark, d):
    stg = feeds.stg_user_events(spark, d)
    stored = None
    for lo, hi in ((None, "2024-01-11"), ("2024-01-09", "2024-01-21"), ("2024-01-21", None)):
        batch = stg if lo is None else stg.filter(F.col("LOAD_DTS") >= T(lo))
        batch = batch if hi is None else batch.filter(F.col("LOAD_DTS") < T(hi))
        new = driving_key_effectivity(batch, "USER_STATE_HK", ["USER_ID"], ["EVENT_TYPE"], stored=stored)
        stored = cut_lineage(new if stored is None else stored.unionByName(new))
    return stored


# S7 with late relations, on two time axes: the third batch brings days that lie before the
# second's.  The runs as known at each load time equal those of all rows received by then at once.
ARRIVALS = (
    ("2024-02-01 00:00:00", f"LOAD_DTS < TIMESTAMP '2024-01-15' AND NOT ({LATE})"),
    ("2024-02-02 00:00:00", "LOAD_DTS >= TIMESTAMP '2024-01-13'"),
    ("2024-02-03 00:00:00", LATE),
)


def _known_runs_sql(k: int) -> str:
    received = " OR ".join(f"({cond})" for _, cond in ARRIVALS[: k + 1])
    return f"""SELECT TIMESTAMP '{ARRIVALS[k][0]}' AS KNOWN_DTS, {S.hk('USER_ID', 'EVENT_TYPE')} AS USER_STATE_HK, _t AS BEGIN_DTS,
            lead(_t) OVER (PARTITION BY USER_ID ORDER BY _t) AS END_DTS, USER_ID, EVENT_TYPE, REC_SRC
        FROM (SELECT USER_ID, EVENT_TYPE, LOAD_DTS AS _t, REC_SRC, lag(EVENT_TYPE) OVER (PARTITION BY USER_ID ORDER BY LOAD_DTS) AS _p
              FROM ({S.STG_USER_EVENTS}) WHERE {received}) WHERE _p IS NULL OR _p <> EVENT_TYPE"""


@register("driving_key_late", " UNION ALL ".join(f"SELECT * FROM ({_known_runs_sql(k)})" for k in range(len(ARRIVALS))))
def q_driving_key_late(spark, d):
    stg = feeds.stg_user_events(spark, d)
    history = stored = None
    for load_dts, cond in ARRIVALS:
        batch = stg.filter(F.expr(cond.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")))
        new = driving_key_changes(batch, "USER_STATE_HK", ["USER_ID"], ["EVENT_TYPE"], load_dts, history, stored)
        stored = cut_lineage(new if stored is None else stored.unionByName(new))
        history = batch if history is None else history.unionByName(batch)
    out = None
    for load_dts, _ in ARRIVALS:
        runs = runs_as_known(stored, "USER_STATE_HK", load_dts).select(
            T(load_dts).alias("KNOWN_DTS"), "USER_STATE_HK", "BEGIN_DTS", "END_DTS", "USER_ID", "EVENT_TYPE", "REC_SRC")
        out = runs if out is None else out.unionByName(runs)
    return out


# The link satellite from the stored stage L2, which holds its parent key and hash diff.
@register("sat_prehashed", S.timeline_sql(ST_DETAILS, "ORDER_ITEM_HK, LINE_SSQN"))
def q_sat_prehashed(spark, d):
    stg = model.stage_orders_hashed.placed(spark, d)
    return load_sat(stg, None, model.SAT_ORDER_ITEM_DETAILS, hot_key_bucket=model.LINE_BUCKET, placed=True).drop(PLACE)


# Rows that loads refuse.  The feed is broken on purpose: errors
# have a blank user, large values none, and times are cut to the hour, so that
# events of a user tie.
ST_BROKEN = f"""SELECT CASE WHEN EVENT_TYPE = 'error' THEN ' ' WHEN VALUE > 190 THEN NULL ELSE USER_ID END AS USER_ID, EVENT_ID,
    EVENT_TYPE, date_trunc('hour', LOAD_DTS)::TIMESTAMP AS LOAD_DTS, REC_SRC FROM ({S.STG_USER_EVENTS})"""


def broken_events(spark, d):
    user = F.when(F.col("EVENT_TYPE") == "error", " ").when(F.col("VALUE") > 190, None).otherwise(F.col("USER_ID"))
    hour = F.date_trunc("hour", F.col("LOAD_DTS")).cast("timestamp_ntz")
    return feeds.stg_user_events(spark, d).select(user.alias("USER_ID"), "EVENT_ID", "EVENT_TYPE", hour.alias("LOAD_DTS"), "REC_SRC")


@register(
    "sat_rejects",
    f"""WITH f AS (SELECT * REPLACE (nullif(trim(USER_ID), '') AS USER_ID), USER_ID AS raw FROM ({ST_BROKEN}))
    SELECT raw AS USER_ID, EVENT_ID, EVENT_TYPE, LOAD_DTS, REC_SRC, 'KEY' AS REASON FROM f WHERE USER_ID IS NULL
    UNION ALL
    SELECT raw, EVENT_ID, EVENT_TYPE, LOAD_DTS, REC_SRC, 'TIE' FROM f WHERE USER_ID IS NOT NULL AND EXISTS (
        SELECT 1 FROM f g WHERE g.USER_ID = f.USER_ID AND g.LOAD_DTS = f.LOAD_DTS AND g.EVENT_TYPE <> f.EVENT_TYPE)""",
)
def q_sat_rejects(spark, d):
    return sat_rejects(broken_events(spark, d), model.SAT_USER_STATE)


@register("hub_rejects", f"SELECT * FROM ({ST_BROKEN}) WHERE USER_ID IS NULL OR trim(USER_ID) = ''")
def q_hub_rejects(spark, d):
    return hub_rejects(broken_events(spark, d), model.HUB_USER)


@register("link_rejects", f"SELECT * FROM ({ST_BROKEN}) WHERE nullif(trim(USER_ID), '') IS NULL OR EVENT_ID IS NULL")
def q_link_rejects(spark, d):
    spec = LinkSpec("LNK_USER_EVENT", "USER_EVENT_HK", (("USER_HK", ("USER_ID",)), ("EVENT_HK", ("EVENT_ID",))))
    return link_rejects(broken_events(spark, d), spec)


# Load the driving-key rows into a link effectivity satellite, in two
# overlapping batches; the overlap adds nothing.
@register(
    "eff_user_state",
    f"""SELECT USER_STATE_HK, LOAD_DTS,
        sha256(coalesce(strftime(BEGIN_DTS, '%Y-%m-%d %H:%M:%S.%f'), '') || '|' || coalesce(strftime(END_DTS, '%Y-%m-%d %H:%M:%S.%f'), '') || '|' || CAST(IS_DELETED AS VARCHAR)) AS HASH_DIFF,
        REC_SRC, BEGIN_DTS, END_DTS, IS_DELETED FROM ({DK_SQL})""",
)
def q_eff_user_state(spark, d):
    rows = _driving(spark, d)
    b1 = rows.filter(F.col("LOAD_DTS") < T("2024-01-16"))
    b2 = rows.filter(F.col("LOAD_DTS") >= T("2024-01-12"))
    eff = cut_lineage(load_effectivity(b1, None, "USER_STATE_HK"))
    return eff.unionByName(load_effectivity(b2, eff, "USER_STATE_HK"))


# Orders in the hub (loaded from the order feed, every order) that the
# full line extract no longer holds are flagged deleted.
@register(
    "deletes",
    f"""WITH h AS ({S.hub_sql(S.STG_ORDER_HEADERS, 'ORDER_HK', 'ORDER_NUMBER')})
    SELECT h.ORDER_HK, TIMESTAMP '2024-02-01 00:00:00' AS LOAD_DTS, TIMESTAMP '2024-02-01 00:00:00' AS BEGIN_DTS,
        CAST(NULL AS TIMESTAMP) AS END_DTS, 1 AS IS_DELETED, 'SYSGEN' AS REC_SRC
    FROM h WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE {S.hk('l.l_orderkey')} = h.ORDER_HK)""",
)
def q_deletes(spark, d):
    from strongroom.operators.hub import load_hub

    hub = load_hub(feeds.stg_order_headers(spark, d), None, model.HUB_ORDER)
    extract = feeds.table(spark, d, "lineitem").select(hash_key("l_orderkey").alias("ORDER_HK"))
    first = detect_deletes(hub, "ORDER_HK", extract, "ORDER_HK", None, "2024-02-01 00:00:00")
    # A second run on the same extract adds nothing (already flagged).
    eff = cut_lineage(first)
    again = detect_deletes(hub, "ORDER_HK", extract, "ORDER_HK", eff, "2024-02-02 00:00:00")
    return eff.unionByName(again)


# First and last observation per user, without touching the hub.
@register(
    "last_observed",
    f"""SELECT {S.hk('USER_ID')} AS USER_HK, min(LOAD_DTS) AS FIRST_SEEN_DTS, max(LOAD_DTS) AS LAST_SEEN_DTS,
        count(*) AS OBSERVATIONS FROM ({S.STG_USER_EVENTS}) GROUP BY 1""",
)
def q_last_observed(spark, d):
    e = feeds.stg_user_events(spark, d).select(hash_key("USER_ID").alias("USER_HK"), "LOAD_DTS")
    return last_observed(e, "USER_HK")


# S9 through S6: observations of two overlapping batches as effectivity rows; a user's current row says when it was first and last seen.
SEEN_SQL = f"SELECT {S.hk('USER_ID')} AS USER_HK, LOAD_DTS AS T FROM ({S.STG_USER_EVENTS})"


@register(
    "observed_effectivity",
    f"""WITH seen AS ({SEEN_SQL}),
    v AS (SELECT USER_HK, min(T) AS BEGIN_DTS, max(T) AS END_DTS FROM seen WHERE T < TIMESTAMP '2024-01-16' GROUP BY USER_HK
          UNION SELECT USER_HK, min(T), max(T) FROM seen GROUP BY USER_HK HAVING max(T) >= TIMESTAMP '2024-01-12')
    SELECT USER_HK, END_DTS AS LOAD_DTS,
        sha256(strftime(BEGIN_DTS, '%Y-%m-%d %H:%M:%S.%f') || '|' || strftime(END_DTS, '%Y-%m-%d %H:%M:%S.%f') || '|0') AS HASH_DIFF,
        'SYSGEN' AS REC_SRC, BEGIN_DTS, END_DTS, 0 AS IS_DELETED FROM v""",
)
def q_observed_effectivity(spark, d):
    e = feeds.stg_user_events(spark, d).select(hash_key("USER_ID").alias("USER_HK"), "LOAD_DTS")
    b1, b2 = e.filter(F.col("LOAD_DTS") < T("2024-01-16")), e.filter(F.col("LOAD_DTS") >= T("2024-01-12"))
    eff = cut_lineage(load_effectivity(observed_effectivity(b1, "USER_HK"), None, "USER_HK"))
    return eff.unionByName(load_effectivity(observed_effectivity(b2, "USER_HK", eff), eff, "USER_HK"))
