"""Checksums per bucket, sketches and block samples against exact answers."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strongroom.operators.audit import audit_insert_only
from strongroom.operators.checksums import differing_buckets, reconcile_rows
from strongroom.operators.profiling import reconcile_keys
from strongroom.operators.sketches import block_estimates, block_sample, profile_sketches, sketch_columns
from strongroom.sources.io import append, scratch_path

COLS = "K string, V int, LOAD_DTS timestamp_ntz"
D = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def bag(seed, n=300):
    r = random.Random(seed)
    return [(r.choice([None, *"abcdefgh"]), r.choice([None, 1, 2, 3]), D(r.randrange(20))) for _ in range(n)]


def test_insert_only_is_a_difference_of_bags(spark):
    rows, r = bag(1), random.Random(2)
    for lost in (0, 1, 40):
        after = rows[lost:] + [("new", 1, D(30))] * 5 + [("late", r.randrange(5), D(3))] * 2
        r.shuffle(after)
        got = audit_insert_only(frame(spark, rows), frame(spark, after)).collect()
        assert Counter(tuple(x) for x in got) == Counter(rows) - Counter(after)
    assert audit_insert_only(frame(spark, []), frame(spark, rows)).isEmpty()
    assert audit_insert_only(frame(spark, rows), frame(spark, [])).count() == len(rows)


def test_equal_tables_have_no_differing_bucket(spark):
    rows = bag(3)
    a, b = frame(spark, rows), frame(spark, rows[::-1]).repartition(5)
    assert differing_buckets(a, b, ["K"], a.columns) == []
    assert len(differing_buckets(a, frame(spark, rows + rows[:1]), ["K"], a.columns)) == 1
    assert reconcile_rows(a, b, ["K"]).isEmpty()


@pytest.mark.parametrize("seed", [4, 5])
def test_reconciled_rows(spark, seed):
    r = random.Random(seed)
    a = bag(seed, 60)
    b = [x for x in a if r.random() < 0.9] + [("only b", 1, D(1)), (None, 9, D(2))]
    got = {x.K: x.side for x in reconcile_rows(frame(spark, a), frame(spark, b), ["K"], buckets=16).collect()}
    of = lambda rows, k: Counter(x for x in rows if x[0] == k)
    want = {k: "DIFFERENT" if of(a, k) and of(b, k) else "A_NOT_B" if of(a, k) else "B_NOT_A" for k in {x[0] for x in a + b} if of(a, k) != of(b, k)}
    assert got == want


def test_reconciled_keys(spark):
    a, b = frame(spark, [("x", 1, D(0)), ("x", 2, D(0)), (None, 1, D(0)), ("y", 1, D(0))]), frame(spark, [("y", 5, D(1)), ("z", 1, D(0))])
    assert {(r.key, r.side) for r in reconcile_keys(a, b, "K").collect()} == {("x", "A_NOT_B"), (None, "A_NOT_B"), ("z", "B_NOT_A")}
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    plan = reconcile_keys(own.range(5).toDF("K"), own.range(9).toDF("K"), "K")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_sketches_merge_over_days(spark):
    rows = [(f"k{i % 700}", i % 3 or None, D(i % 10)) for i in range(5000)]
    df = frame(spark, rows).withColumn("DAY", F.col("LOAD_DTS").cast("date")).withColumn("W", F.col("V") * 1.5)
    sketches = sketch_columns(df, "DAY", ["K", "V", "W", "LOAD_DTS"])
    assert sketches.count() == 40
    some = [x for x in rows if D(2) <= x[2] <= D(6)]
    got = {r.column_name: r for r in profile_sketches(sketches.filter("DAY BETWEEN '2024-01-03' AND '2024-01-07'")).collect()}
    for i, c in enumerate(("K", "V")):
        values = [x[i] for x in some if x[i] is not None]
        assert (got[c].total_rows, got[c].populated, got[c].nulls) == (len(some), len(values), len(some) - len(values))
        assert abs(got[c].distinct_vals - len(set(values))) <= 0.1 * len(set(values))
    assert got["W"].distinct_vals == 2 and got["LOAD_DTS"].distinct_vals == 5
    assert profile_sketches(sketches.limit(0)).isEmpty()


def test_block_sample_opens_only_its_files(spark):
    path = scratch_path(spark, "blocks")
    append(spark.range(20000).withColumn("v", F.col("id") % 7).repartition(50, "id"), path)
    hits = 0
    for seed in range(8):
        drawn, chosen, blocks = block_sample(spark, path, 30.0, seed)
        assert len(drawn.inputFiles()) == chosen < blocks == 50
        est = {r.MEASURE: r for r in block_estimates(drawn, chosen, blocks, {"n": F.lit(1), "v": F.col("v")}).collect()}
        hits += all(abs(est[m].ESTIMATE - t) <= 3 * est[m].STD_ERROR for m, t in (("n", 20000), ("v", sum(i % 7 for i in range(20000)))))
    assert hits >= 7
    whole, chosen, blocks = block_sample(spark, path, 100.0)
    est = {r.MEASURE: (r.ESTIMATE, r.STD_ERROR) for r in block_estimates(whole, chosen, blocks, {"n": F.lit(1)}).collect()}
    assert est == {"n": (20000.0, 0.0)}
