"""Histories cut into time buckets against one plain window per key, on a feed
in which one key holds a third of all rows; stored vault tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strongroom.operators.audit import audit_consecutive_equal
from strongroom.operators.common import carried, next_value, previous_value
from strongroom.operators.effectivity import driving_key_effectivity
from strongroom.operators.satellite import change_rate, end_dated, merge_timelines, split_sat
from strongroom.plans.mart import dim_history

COLS = "K string, S int, LOAD_DTS timestamp_ntz, V string, W string, REC_SRC string"


def texts(df):
    """The rows as sorted texts (some fields are NULL)."""
    return sorted(str(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def feed(spark):
    r = random.Random(3)
    start, out, seen = dt.datetime(2024, 1, 1), [], set()
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{r.randrange(40)}"
        t = start + dt.timedelta(hours=r.randrange(24 * 20))
        if (key, t) not in seen:
            seen.add((key, t))
            out.append((key, None if key == "hot" else 1, t, r.choice("ab"), r.choice(["x", "y", None]), "A"))
    return spark.createDataFrame(out, COLS).cache()


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_neighbours_and_fill_equal_plain_windows(feed, bucket):
    keys = ["K", "S"]  # S is NULL for the hot key
    for f in (previous_value, next_value):
        plain, cut = (texts(f(feed, keys, "LOAD_DTS", "W", "OUT", b)) for b in (None, bucket))
        assert plain == cut
    plain, cut = (texts(carried(feed, keys, "LOAD_DTS", ["W"], b)) for b in (None, bucket))
    assert plain == cut


def test_operators_equal_plain_windows(feed):
    sat = feed.withColumn("HASH_DIFF", F.col("V"))
    for f in (
        lambda b: end_dated(sat, ["K"], hot_key_bucket=b),
        lambda b: split_sat(sat, ["K"], {"V": ["V"]}, hot_key_bucket=b)["V"],
        lambda b: merge_timelines([(sat, ["V"]), (sat.filter("W is not null"), ["W"])], "K", hot_key_bucket=b),
        lambda b: change_rate(sat, ["K"], ["V", "W"], hot_key_bucket=b),
        lambda b: audit_consecutive_equal(sat, ["K"], b),
        lambda b: driving_key_effectivity(feed, "HK", ["K"], ["V"], hot_key_bucket=b),
    ):
        plain, cut = (texts(f(b)) for b in (None, "day"))
        assert plain == cut


def test_type_two_dimension_keeps_keys_without_a_version(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    hub = spark.createDataFrame([("a", "A", t[0]), ("b", "B", t[1])], "HK string, BK string, LOAD_DTS timestamp_ntz")
    side = lambda c, *r: (spark.createDataFrame([("a", x, v, s) for x, v, s in r],
                                                f"HK string, LOAD_DTS timestamp_ntz, {c} string, REC_SRC string"), [c])
    sats = [side("X", (t[0], "1", "S"), (t[3], "2", "S")), side("Y", (t[1], "p", "T")), side("Z", (t[3], "q", "U"))]
    out = dim_history(hub, "HK", ["BK"], sats, "KEY").collect()
    assert sorted((r.KEY, r.VALID_FROM, r.VALID_TO, r.X, r.Y, r.Z) for r in out if r.KEY == "a") == [
        ("a", t[0], t[1], "1", None, None), ("a", t[1], t[3], "1", "p", None), ("a", t[3], None, "2", "p", "q")]
    assert [(r.VALID_FROM, r.VALID_TO, r.X) for r in out if r.KEY == "b"] == [(t[1], None, None)]
    merged = merge_timelines(sats, "HK").collect()
    assert {r.LOAD_DTS: r.REC_SRC for r in merged}[t[3]] == "S+U"


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_fact_and_pit_read_stored_tables(spark):
    import __spark_entry__ as E

    d = "/root/testdata/sf0.001"
    fact = plan_of(E.queries()["fact_sales"](spark, d))
    assert "lineitem.parquet" not in fact and "orders.parquet" not in fact
    read = plan_of(E.queries()["pit_read"](spark, d))
    assert "events.parquet" not in read and "PartitionFilters: [isnotnull(SNAPSHOT_DTS" in read


def test_audits_are_silent_on_a_healthy_vault(spark):
    from strongroom.operators import audit as A
    from strongroom.suite import model

    d = "/root/testdata/sf0.001"
    hub, link = model.hub_order(spark, d), model.lnk_order_item(spark, d)
    sat, details = model.sat_user_state(spark, d), model.sat_order_item_details(spark, d)
    for found in (
        A.audit_key_one_to_one(hub, "ORDER_HK", ["ORDER_NUMBER"]),
        A.audit_unique(hub, ["ORDER_HK"]),
        A.audit_unique(link, ["ORDER_ITEM_HK"]),
        A.audit_unique(sat, ["USER_HK", "LOAD_DTS"]),
        A.audit_unique(details, ["ORDER_ITEM_HK", "LINE_SSQN", "LOAD_DTS"]),
        A.audit_missing_parent(link, "ORDER_HK", hub, "ORDER_HK"),
        A.audit_missing_parent(sat, "USER_HK", model.hub_user(spark, d), "USER_HK"),
        A.audit_hash_drift(hub, "ORDER_HK", ["ORDER_NUMBER"]),
        A.audit_consecutive_equal(sat, ["USER_HK"]),
        A.audit_insert_only(hub, hub),
        A.audit_audit_columns(details),
    ):
        assert found.isEmpty()
