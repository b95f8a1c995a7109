"""Streaming queries (R1, R2): events delivered in four overlapping,
time-ordered deliveries (each re-delivers the last part of the one before)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strongroom.sources import feeds
from strongroom.sources.io import scratch_path
from strongroom.streaming.microbatch import VaultTarget, redelivery_filter, stream_load, unseen_sink
from strongroom.suite import model
from strongroom.suite import sqlbits as S
from strongroom.suite.q_satellite import SAT_STATE_SQL, ST_BROKEN, broken_events
from strongroom.suite.registry import register

DELIVERIES = 4


def delivered(spark, stg, start):
    """Land each delivery as a folder of files and run the stream over what is
    new; ``start`` makes the stream of the landing folder, on one checkpoint.

    The deliveries cut the time between the feed's first and last event evenly,
    and each begins a quarter of that before the end of the one before; rows
    without a time come with the last one."""
    folder = scratch_path(spark, "landing_events")
    t = F.col("LOAD_DTS")
    lo, hi = stg.agg(F.min(t), F.max(t)).first()
    step = None if lo is None else (hi - lo) / DELIVERIES
    for k in range(DELIVERIES):
        part = stg
        if step is not None:
            part = stg.filter(t >= F.lit(lo + (k - (k > 0) / 4) * step))
            part = part.filter(t < F.lit(lo + (k + 1) * step)) if k + 1 < DELIVERIES else part.unionByName(stg.filter(t.isNull()))
        part.write.parquet(f"{folder}/delivery={k}")
        src = spark.readStream.schema(stg.schema).parquet(f"{folder}/*")
        start(src).awaitTermination()


@register("stream_load", SAT_STATE_SQL)
def q_stream_load(spark, d):
    hub_path, sat_path = scratch_path(spark, "hub_user"), scratch_path(spark, "sat_user_state")
    refused, checkpoint = scratch_path(spark, "rejects"), scratch_path(spark, "ckpt_stream_load")
    targets = [
        VaultTarget(model.HUB_USER, hub_path, f"{refused}/hub"),
        VaultTarget(model.SAT_USER_STATE, sat_path, f"{refused}/sat"),
    ]
    delivered(spark, feeds.stg_user_events(spark, d), lambda src: stream_load(src, targets, checkpoint))
    return targets[1].read(spark)


# D3, D4, D7 accounted per micro-batch: what was delivered is refused, loaded or absorbed.
# The deliveries overlap, so rows come twice; the feed is broken on purpose.
@register(
    "stream_accounts",
    f"""WITH st AS (SELECT DISTINCT USER_ID, EVENT_TYPE, LOAD_DTS FROM ({ST_BROKEN})),
    good AS (SELECT * FROM st WHERE trim(USER_ID) <> ''),
    clean AS (SELECT USER_ID, LOAD_DTS, min(EVENT_TYPE) AS EVENT_TYPE FROM good GROUP BY ALL HAVING count(DISTINCT EVENT_TYPE) = 1),
    sat AS ({S.timeline_sql("SELECT USER_ID, LOAD_DTS, EVENT_TYPE AS HASH_DIFF FROM clean", "USER_ID")})
    SELECT 'HUB_USER' AS TARGET, count(DISTINCT USER_ID) AS LOADED, true AS BALANCED FROM good
    UNION ALL SELECT 'SAT_USER_STATE', (SELECT count(*) FROM sat), true""",
)
def q_stream_accounts(spark, d):
    refused, checkpoint, accounts = (scratch_path(spark, n) for n in ("rejects", "ckpt_stream_accounts", "accounts"))
    targets = [
        VaultTarget(model.HUB_USER, scratch_path(spark, "hub_user"), f"{refused}/hub"),
        VaultTarget(model.SAT_USER_STATE, scratch_path(spark, "sat_user_state"), f"{refused}/sat"),
    ]
    delivered(spark, broken_events(spark, d), lambda src: stream_load(src, targets, checkpoint, accounts=accounts))
    # Refused rows in the accounts are those in the rejects tables, and nothing is left over.
    out = None
    for t, name in zip(targets, ("hub", "sat")):
        rejects = spark.read.parquet(f"{refused}/{name}").select(F.count(F.lit(1))).scalar()
        a = spark.read.parquet(accounts).filter(F.col("TARGET") == t.spec.name).groupBy("TARGET").agg(
            F.sum("LOADED").alias("LOADED"), F.sum("REFUSED").alias("_r"), F.min("ABSORBED").alias("_a"),
            F.sum(F.col("DELIVERED") - F.col("REFUSED") - F.col("LOADED") - F.col("ABSORBED")).alias("_rest"))
        a = a.select("TARGET", "LOADED", ((F.col("_r") == rejects) & (F.col("_rest") == 0) & (F.col("_a") >= 0)).alias("BALANCED"))
        out = a if out is None else out.unionByName(a)
    return out


# R2 with bounded state: the overlaps lie within the 96 hours that the watermark waits.
@register(
    "stream_redelivery",
    f"SELECT USER_ID, EVENT_ID, EVENT_TYPE, VALUE, PROPS, LOAD_DTS, REC_SRC FROM ({S.STG_USER_EVENTS})",
)
def q_stream_redelivery(spark, d):
    out, checkpoint = scratch_path(spark, "events_once"), scratch_path(spark, "ckpt_stream_redelivery")

    def start(src):
        once = redelivery_filter(src, ["USER_ID", "EVENT_ID"], "LOAD_DTS", hours=96)
        return once.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    delivered(spark, feeds.stg_user_events(spark, d), start)
    return spark.read.parquet(out).select("USER_ID", "EVENT_ID", "EVENT_TYPE", "VALUE", "PROPS", "LOAD_DTS", "REC_SRC")


@register(
    "stream_dedup",
    f"SELECT USER_ID, EVENT_ID, EVENT_TYPE, VALUE, PROPS, LOAD_DTS, REC_SRC FROM ({S.STG_USER_EVENTS})",
)
def q_stream_dedup(spark, d):
    out, checkpoint = scratch_path(spark, "events_dedup"), scratch_path(spark, "ckpt_stream_dedup")
    sink = unseen_sink(out, ["USER_ID", "EVENT_ID"], "LOAD_DTS")
    delivered(
        spark,
        feeds.stg_user_events(spark, d),
        lambda src: src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(),
    )
    return spark.read.parquet(out).select("USER_ID", "EVENT_ID", "EVENT_TYPE", "VALUE", "PROPS", "LOAD_DTS", "REC_SRC")
