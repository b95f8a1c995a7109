import datetime as dt
import random

from pyspark.sql import functions as F

from strongroom.operators.hub import hub_rejects, load_hub
from strongroom.operators.link import load_link, resolve_same_as
from strongroom.operators.satellite import load_multi_active_sets, load_sat, sat_rejects
from strongroom.operators.specs import HubSpec, LinkSpec, SatSpec
from tests.conftest import rows

HUB = HubSpec("HUB_C", "C_HK", ("C_NUM",))
SAT = SatSpec("SAT_C", "C_HK", ("EMAIL",), parent_bk=("C_NUM",))
T0 = dt.datetime(2024, 1, 1)


def t(h):
    return T0 + dt.timedelta(hours=h)


def stg(spark, data, cols="C_NUM string, EMAIL string, LOAD_DTS timestamp_ntz, REC_SRC string"):
    return spark.createDataFrame(data, cols)


def test_hub_first_seen_first_source_and_rerun(spark):
    s = stg(spark, [("c1", "a", t(2), "B"), (" C1 ", "a", t(1), "Z"), ("c1", "a", t(1), "A"), ("c2", "x", t(3), "A")])
    hub = load_hub(s, None, HUB)
    got = {r.C_NUM: (r.LOAD_DTS, r.REC_SRC) for r in hub.collect()}
    # ' C1 ' and 'c1' are one key; first by (LOAD_DTS, REC_SRC, business key)
    assert got == {"c1": (t(1), "A"), "c2": (t(3), "A")}
    assert load_hub(s, hub, HUB).count() == 0  # rerun adds nothing


def test_hub_rejects_null_and_blank(spark):
    s = stg(spark, [(None, "a", t(1), "A"), ("  ", "a", t(1), "A"), ("c1", "a", t(1), "A")])
    assert load_hub(s, None, HUB).count() == 1
    assert hub_rejects(s, HUB).count() == 2


def test_link_absorbs_second_source(spark):
    spec = LinkSpec("L", "L_HK", (("A_HK", ("A",)), ("B_HK", ("B",))))
    s1 = spark.createDataFrame([("a", "b", t(1), "S1")], "A string, B string, LOAD_DTS timestamp_ntz, REC_SRC string")
    s2 = spark.createDataFrame([("A", "B ", t(2), "S2")], "A string, B string, LOAD_DTS timestamp_ntz, REC_SRC string")
    first = load_link(s1, None, spec)
    assert load_link(s2, first, spec).count() == 0
    assert first.first().REC_SRC == "S1"


def test_same_as_resolve(spark):
    spec = LinkSpec("SAL", "S_HK", (("SYN", ("N",)), ("MASTER", ("M",))))
    sal = load_link(
        spark.createDataFrame([("n1", "m1", t(1), "X")], "N string, M string, LOAD_DTS timestamp_ntz, REC_SRC string"), None, spec
    )
    from strongroom.functions.hashing import hash_key

    df = spark.createDataFrame([("n1",), ("zz",)], "N string").select("N", hash_key("N").alias("K"))
    out = {r.N: r.K for r in resolve_same_as(df, sal, "K", "SYN", "MASTER").collect()}
    m1 = spark.range(1).select(hash_key(F.lit("m1"))).first()[0]
    zz = spark.range(1).select(hash_key(F.lit("zz"))).first()[0]
    assert out == {"n1": m1, "zz": zz}


def test_sat_history_a_b_a(spark):
    s = stg(spark, [("c1", "a", t(1), "S"), ("c1", "b", t(2), "S"), ("c1", "a", t(3), "S"), ("c1", "a", t(4), "S")])
    sat = load_sat(s, None, SAT)
    assert [r.EMAIL for r in sat.orderBy("LOAD_DTS").collect()] == ["a", "b", "a"]


def test_sat_replay_adds_nothing_latest_and_timeline(spark):
    s = stg(spark, [("c1", "a", t(1), "S"), ("c1", "b", t(2), "S")])
    for mode in ("timeline", "latest"):
        sat = load_sat(s, None, SAT, mode="timeline")
        again = load_sat(s.filter(F.col("LOAD_DTS") == t(2)), sat, SAT, mode=mode)
        assert again.count() == 0


def test_sat_late_row(spark):
    base = stg(spark, [("c1", "a", t(1), "S"), ("c1", "a", t(3), "S")])
    sat = load_sat(base, None, SAT)
    assert sat.count() == 1
    late_same = load_sat(stg(spark, [("c1", "a", t(2), "S")]), sat, SAT)
    assert late_same.count() == 0  # equal to its predecessor
    late_diff = load_sat(stg(spark, [("c1", "b", t(2), "S")]), sat, SAT)
    assert rows(late_diff, "EMAIL") == [("b",)]  # a differing late row is added


def test_sat_ties_rejected(spark):
    s = stg(spark, [("c1", "a", t(1), "S"), ("c1", "b", t(1), "S"), ("c2", "x", t(1), "S"), ("c2", "x", t(1), "T")])
    sat = load_sat(s, None, SAT)
    assert rows(sat, "EMAIL") == [("x",)]  # exact duplicate collapses, tie is not picked
    assert sat_rejects(s, SAT).count() == 2


def test_null_vs_blank_payload(spark):
    s = stg(spark, [("c1", None, t(1), "S"), ("c1", "", t(2), "S")])
    assert load_sat(s, None, SAT).count() == 1  # literal recipe
    strict = SatSpec("SAT_C", "C_HK", ("EMAIL",), parent_bk=("C_NUM",), strict_hashdiff=True)
    assert load_sat(s, None, strict).count() == 2


def test_timeline_any_batch_split_equals_one_shot(spark):
    rnd = random.Random(5)
    data = []
    for k in range(4):
        v = "a"
        for h in range(30):
            if rnd.random() < 0.4:
                v = rnd.choice("abc")
            data.append((f"c{k}", v, t(h), "S"))
    feed = stg(spark, data)
    one_shot = rows(load_sat(feed, None, SAT), "C_HK", "LOAD_DTS", "EMAIL")
    for trial in range(3):
        cuts = sorted(rnd.sample(range(1, 30), 3))
        bounds = [0] + cuts + [30]
        sat = None
        for lo, hi in zip(bounds, bounds[1:]):
            lo = max(0, lo - rnd.randint(0, 3))  # overlapping re-delivery
            batch = feed.filter((F.col("LOAD_DTS") >= t(lo)) & (F.col("LOAD_DTS") < t(hi)))
            new = load_sat(batch, sat, SAT)
            sat = new if sat is None else sat.unionByName(new)
            sat = spark.createDataFrame(sat.collect(), sat.schema)
        assert rows(sat, "C_HK", "LOAD_DTS", "EMAIL") == one_shot


def test_hot_key_bucketed_lag_equals_plain(spark):
    data = [("hot", "ab"[(h // 3) % 2], t(h), "S") for h in range(200)] + [("c2", "x", t(1), "S")]
    s = stg(spark, data)
    plain = rows(load_sat(s, None, SAT, hot_key_bucket=None), "LOAD_DTS", "EMAIL")
    bucketed = rows(load_sat(s, None, SAT, hot_key_bucket="day"), "LOAD_DTS", "EMAIL")
    assert plain == bucketed


def test_multi_active_whole_set_sees_vanished_member(spark):
    spec = SatSpec("SAT_M", "C_HK", ("V",), parent_bk=("C_NUM",), ssqn="SSQN")
    cols = "C_NUM string, SSQN int, V string, LOAD_DTS timestamp_ntz, REC_SRC string"
    b1 = spark.createDataFrame([("c1", 1, "a", t(1), "S"), ("c1", 2, "b", t(1), "S")], cols)
    b2 = spark.createDataFrame([("c1", 1, "a", t(2), "S")], cols)  # member 2 vanished
    b3 = spark.createDataFrame([("c1", 1, "a", t(3), "S")], cols)  # unchanged set
    sat = load_multi_active_sets(b1, None, spec)
    s2 = load_multi_active_sets(b2, sat, spec)
    assert s2.count() == 1
    sat = sat.unionByName(s2)
    assert load_multi_active_sets(b3, sat, spec).count() == 0
    # per-row mode cannot see the vanished member
    assert load_sat(b2, load_sat(b1, None, spec), spec).count() == 0
