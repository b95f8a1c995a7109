import datetime as dt

from pyspark.sql import functions as F

from strongroom.functions.rules import email_is_valid, mask_emails, phone_e164
from strongroom.operators.effectivity import detect_deletes, driving_key_effectivity
from strongroom.operators.staging import stage
from strongroom.plans.snapshot import build_pit, fixed_spine
from strongroom.operators import profiling as P

T0 = dt.datetime(2024, 1, 1)


def t(d, h=0):
    return T0 + dt.timedelta(days=d, hours=h)


def test_pit_inclusive_and_null_before_first(spark):
    hub = spark.createDataFrame([("k1", t(0)), ("k2", t(0))], "HK string, LOAD_DTS timestamp_ntz")
    sat = spark.createDataFrame([("k1", t(1)), ("k1", t(2, 5)), ("k2", t(5))], "HK string, LOAD_DTS timestamp_ntz")
    pit = build_pit(hub, "HK", {"S": sat}, fixed_spine("2024-01-01", "2024-01-04"))
    got = {(r.HK, r.SNAPSHOT_DTS): r.S for r in pit.collect()}
    assert got[("k1", t(0))] is None
    assert got[("k1", t(1))] == t(1)  # '<=' is inclusive
    assert got[("k1", t(2))] == t(1)
    assert got[("k1", t(3))] == t(2, 5)
    assert all(got[("k2", t(d))] is None for d in range(4))
    assert pit.count() == 8


def test_pit_known_keys_only(spark):
    hub = spark.createDataFrame([("k1", t(2))], "HK string, LOAD_DTS timestamp_ntz")
    sat = spark.createDataFrame([("k1", t(2))], "HK string, LOAD_DTS timestamp_ntz")
    pit = build_pit(hub, "HK", {"S": sat}, fixed_spine("2024-01-01", "2024-01-04"), known_keys_only=True)
    assert pit.count() == 2


def test_driving_key_relation_returns(spark):
    df = spark.createDataFrame(
        [("u", "A", t(0)), ("u", "B", t(1)), ("u", "A", t(2))], "U string, O string, LOAD_DTS timestamp_ntz"
    ).withColumn("REC_SRC", F.lit("S"))
    eff = driving_key_effectivity(df, "L_HK", ["U"], ["O"])
    opens = eff.filter(F.col("END_DTS").isNull()).count()
    closes = eff.filter(F.col("END_DTS").isNotNull()).count()
    assert (opens, closes) == (3, 2)


def test_delete_then_undelete(spark):
    hub = spark.createDataFrame([("k1",), ("k2",)], "HK string")
    ext1 = spark.createDataFrame([("k1",)], "HK string")
    d1 = detect_deletes(hub, "HK", ext1, "HK", None, "2024-01-02")
    assert [r.HK for r in d1.collect()] == ["k2"]
    ext2 = spark.createDataFrame([("k1",), ("k2",)], "HK string")
    d2 = detect_deletes(hub, "HK", ext2, "HK", d1, "2024-01-03")
    assert [(r.HK, r.IS_DELETED) for r in d2.collect()] == [("k2", 0)]


def test_stage_rejects_failed_casts(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-02"), (None, "bad")], "A string, B string")
    good, bad = stage(df, {"A": "int", "B": "date"})
    assert good.count() == 1
    assert sorted(r._FAILED for r in bad.collect()) == ["A", "B"]


def test_rules(spark):
    df = spark.createDataFrame(
        [("a.b@x.com", "0412 345 678", "mail me at a@b.org now")], "e string, p string, t string"
    )
    r = df.select(email_is_valid("e"), phone_e164("p"), mask_emails("t")).first()
    assert r[0] is True and r[1] == "+61412345678" and r[2] == "mail me at <EMAIL> now"


def test_profile_columns_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "x int, y string")
    out = {r.column_name: (r.populated, r.nulls, r.distinct_vals) for r in P.profile_columns(df).collect()}
    assert out == {"x": (3, 0, 2), "y": (2, 1, 1)}


def test_pit_ignores_session_time_zone_and_dst(spark):
    hub = spark.createDataFrame([("k1", dt.datetime(2024, 3, 1))], "HK string, LOAD_DTS timestamp_ntz")
    versions = [dt.datetime(2024, 3, 10, 0, 30), dt.datetime(2024, 3, 10, 23, 30), dt.datetime(2024, 3, 11, 0, 0)]
    sat = spark.createDataFrame([("k1", v) for v in versions], "HK string, LOAD_DTS timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    results = []
    try:
        for tz in ("UTC", "America/New_York", "Australia/Sydney"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            pit = build_pit(hub, "HK", {"S": sat}, fixed_spine("2024-03-09", "2024-03-12"))
            results.append(sorted((r.SNAPSHOT_DTS, r.S) for r in pit.collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results[0] == results[1] == results[2]
    got = dict(results[0])
    assert got[dt.datetime(2024, 3, 10)] is None
    assert got[dt.datetime(2024, 3, 11)] == dt.datetime(2024, 3, 11, 0, 0)
    assert got[dt.datetime(2024, 3, 12)] == dt.datetime(2024, 3, 11, 0, 0)
