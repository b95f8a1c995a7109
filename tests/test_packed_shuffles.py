"""Hash keys packed in shuffles, keys hashed after them, and joins that are never broadcast."""

import datetime as dt
import re

from pyspark.sql import functions as F

from strongroom.functions.hashing import digest, hash_diff, hash_key, pack, unpack
from strongroom.operators.link import ancestors, load_link, load_link_literal
from strongroom.operators.satellite import load_sat
from strongroom.operators.specs import LinkSpec, SatSpec
from strongroom.plans.snapshot import build_bridge, fixed_spine

T = dt.datetime(2024, 1, 1)
LINK = LinkSpec("L", "L_HK", (("A_HK", ("A",)), ("B_HK", ("B",))))
FEED = "A string, B string, LOAD_DTS timestamp_ntz, REC_SRC string"


def test_pack_is_undone_and_keeps_order_and_halves_digests(spark):
    texts = [None, "", "a", "ab", "é", "0" * 64, "f" * 64, "F" * 64, "0" * 32, "x" * 64, "0" * 31, "\x01abc"]
    df = spark.createDataFrame([(t,) for t in texts], "c string").withColumn("p", pack("c"))
    assert all(r["c"] == r["u"] for r in df.withColumn("u", unpack("p")).collect())
    assert df.select("p").distinct().count() == len(texts)
    plain = [r["c"] for r in df.filter("c is not null and (c = lower(c)) and length(c) < 4").orderBy("c").collect()]
    assert plain == [r["c"] for r in df.filter("c is not null and (c = lower(c)) and length(c) < 4").orderBy("p").collect()]
    assert df.filter(F.col("c") == "f" * 64).select(F.octet_length("p")).first()[0] == 33


def widths(df):
    """Names of digest-making functions below the shuffles of a plan: none where hashing comes after."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, plan[plan.index("Exchange hash"):] if "Exchange hash" in plan else ""


def test_links_with_delimiters_in_keys_and_several_parts(spark):
    rows = [("a|b", "c", T, "S"), ("a", "b|c", T, "S"), ("a", "é", T, "S"), ("a", "é", T, "R"), (None, "x", T, "S"), (" ", "x", T, "S")]
    stg = spark.createDataFrame(rows, FEED)
    got = sorted(map(tuple, load_link(stg, None, LINK).collect()))
    one = spark.createDataFrame([("a", "b|c", T, "S"), ("a", "é", T, "R")], FEED).select(hash_key("A", "B"), hash_key("A"), hash_key("B"), "LOAD_DTS", "REC_SRC")
    assert got == sorted(map(tuple, one.collect()))
    assert load_link(stg, load_link(stg, None, LINK), LINK).isEmpty()
    literal = load_link_literal(stg, None, LINK)
    want = stg.select(hash_key("A", "B"), hash_key("A"), hash_key("B"), "LOAD_DTS", "REC_SRC").distinct()
    assert sorted(map(str, literal.collect())) == sorted(str(r) for r in want.toDF(*literal.columns).collect())
    assert "sha2" not in widths(literal)[1]  # distinct on texts, hashed after


def test_first_satellite_load_shuffles_no_digest(spark):
    spec = SatSpec("S", "K_HK", ("V",), parent_bk=("K",))
    rows = [("k", "a", T, "S"), ("K ", "a", T + dt.timedelta(days=1), "S"), ("k", "b", T + dt.timedelta(days=2), "S"), ("j", None, T, "S")]
    stg = spark.createDataFrame(rows, "K string, V string, LOAD_DTS timestamp_ntz, REC_SRC string")
    for bucket in ("day", None):
        out = load_sat(stg, None, spec, hot_key_bucket=bucket)
        assert out.columns == ["K_HK", "LOAD_DTS", "HASH_DIFF", "REC_SRC", "V"]
        want = stg.filter("K <> 'K '").select(hash_key("K").alias("K_HK"), "LOAD_DTS", hash_diff("V").alias("HASH_DIFF"), "REC_SRC", "V")
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    assert "sha2" not in widths(load_sat(stg, None, spec, hot_key_bucket=None))[1]


def test_bridge_of_digests_and_plain_keys(spark):
    link = spark.createDataFrame([("x", 1, T)], "A_HK string, N int, LOAD_DTS timestamp_ntz")
    for link in (link, link.withColumn("A_HK", digest(F.col("A_HK")))):
        other = link.select("A_HK", F.lit("p").alias("P_HK"), "LOAD_DTS")
        out = build_bridge(link, ["A_HK", "N"], [(other, "A_HK", ["P_HK"])], fixed_spine("2024-01-01", "2024-01-02"), deleted=[(link.limit(0), "A_HK")])
        assert [(r["A_HK"], r["N"], r["P_HK"]) for r in out.collect()] == [(link.first()["A_HK"], 1, "p")] * 2


def test_closures_and_feeds_are_never_broadcast(spark, tmp_path):
    from strongroom.sources import feeds

    link = spark.createDataFrame([("a", "b"), ("b", "c")], "C string, P string")
    out = ancestors(link, "C", "P")
    assert sorted(map(tuple, out.collect())) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]
    spark.createDataFrame([(1, 2, T)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 1, 1, 1.0, 1.0, 0.1)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = feeds.stg_orders(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search("Broadcast(Hash|Exchange)", plan)
