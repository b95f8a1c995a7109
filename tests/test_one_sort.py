"""A satellite's load sorts once and compares payloads in brief."""

import datetime as dt
import re

from pyspark.sql import functions as F

from strongroom.functions.hashing import brief, digest, digest_of_brief, hash_diff
from strongroom.operators.satellite import load_sat
from strongroom.operators.specs import SatSpec

SPEC = SatSpec("SAT", "K_HK", ("V",), parent_bk=("K",))


def test_first_load_sorts_once_and_hashes_what_stays(spark):
    long, t = "x" * 33, lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("k", "a", t(0)), ("k", "a", t(1)), ("k", long, t(2)), ("k", long, t(3)), ("k", None, t(4)), ("k", "", t(5)), ("k", "b", t(6)), ("k", "c", t(6)), ("k", "a", t(7)), ("k", "a", t(7))]
    stg = spark.createDataFrame([(*r, "S") for r in rows], "K string, V string, LOAD_DTS timestamp_ntz, REC_SRC string")
    out = load_sat(stg, None, SPEC, hot_key_bucket=None)
    got = [(r.LOAD_DTS.hour, r.V, r.HASH_DIFF == r.want) for r in out.withColumn("want", hash_diff("V")).orderBy("LOAD_DTS").collect()]
    assert got == [(0, "a", True), (2, long, True), (4, None, True), (7, "a", True)]
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    plan = load_sat(own.createDataFrame(stg.collect(), stg.schema), None, SPEC, hot_key_bucket=None)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Sort \[", plan)) == 1, plan


def test_brief_texts_give_their_digests(spark):
    df = spark.createDataFrame([("",), ("a",), ("é" * 16,), ("é" * 17,), ("y" * 32,), ("y" * 33,)], "t string")
    for algo in ("sha256", "md5"):
        assert all(r[0] for r in df.select(digest_of_brief(brief(F.col("t"), algo), algo) == digest(F.col("t"), algo)).collect())
