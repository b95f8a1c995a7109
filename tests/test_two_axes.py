"""Late relations and snapshots on two time axes against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strongroom.operators.effectivity import driving_key_changes, driving_key_effectivity, runs_as_known
from strongroom.plans.snapshot import build_bitemporal_pit, fixed_spine

D = lambda n, h=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=h)
FEED = "K string, O string, LOAD_DTS timestamp_ntz, REC_SRC string"


def one_shot(rows):
    """Runs (key, other, begin, end) of all rows at once."""
    out = []
    for k in {r[0] for r in rows if r[0]}:
        seq = sorted({(t, o) for kk, o, t, _ in rows if kk == k and o and o.strip() and t})
        starts = [x for i, x in enumerate(seq) if i == 0 or seq[i - 1][1] != x[1]]
        out += [(k, o, t, starts[i + 1][0] if i + 1 < len(starts) else None) for i, (t, o) in enumerate(starts)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_relations_equal_one_batch_at_every_load_time(spark, seed):
    r = random.Random(seed)
    rows = [(f"k{r.randrange(5)}", r.choice("abc"), D(r.randrange(12), r.choice([0, 12])), "S") for _ in range(90)]
    r.shuffle(rows)  # batches in no order of time, with ties and repeats
    rows += [(None, "a", D(1), "S"), ("k1", " ", D(1), "S"), ("k1", "a", None, "S")]
    cuts, stored, history = [0, 30, 60, 63, 93], None, None
    for n in range(4):
        batch = spark.createDataFrame(rows[cuts[n]:cuts[n + 1]], FEED)
        new = driving_key_changes(batch, "HK", ["K"], ["O"], f"2024-03-0{n + 1}", history, stored)
        rows_out = new.collect()
        stored_rows = rows_out if stored is None else stored.collect() + rows_out
        stored = spark.createDataFrame(stored_rows, new.schema)
        history = batch if history is None else history.unionByName(batch)
    again = driving_key_changes(spark.createDataFrame(rows[:20], FEED), "HK", ["K"], ["O"], "2024-03-09", history, stored)
    assert again.isEmpty()
    for n in range(4):
        known = runs_as_known(stored, "HK", f"2024-03-0{n + 1}").collect()
        assert sorted(((x.K, x.O, x.BEGIN_DTS, x.END_DTS) for x in known), key=str) == one_shot(rows[: cuts[n + 1]])


def test_first_batch_has_the_runs_of_the_one_axis_form(spark):
    rows = [("k", o, D(i), "S") for i, o in enumerate("aabbac")]
    feed = spark.createDataFrame(rows, FEED)
    plain = driving_key_effectivity(feed, "HK", ["K"], ["O"])
    ends = {(r.HK, r.BEGIN_DTS): r.END_DTS for r in plain.filter(F.col("END_DTS").isNotNull()).collect()}
    for r in driving_key_changes(feed, "HK", ["K"], ["O"], "2024-02-01").collect():
        assert r.END_DTS == ends.get((r.HK, r.BEGIN_DTS)) and r.LOAD_DTS == dt.datetime(2024, 2, 1)
    with pytest.raises(ValueError):
        driving_key_changes(feed, "HK", ["K"], ["O"], "2024-02-01", history=feed)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bitemporal_pit(spark, seed):
    r = random.Random(seed)
    hub = [(f"k{i}",) for i in range(8)]
    sat = [(f"k{r.randrange(9)}", D(a), D(a + r.choice([0, 1, 7]), r.choice([0, 6]))) for a in [r.randrange(-2, 22) for _ in range(60)]]
    sat += sat[:5]  # delivered twice
    known, applied = [D(k) for k in range(0, 20, 3)], [D(k, 3) for k in range(0, 18, 2)]
    out = build_bitemporal_pit(
        spark.createDataFrame(hub, "HK string"), "HK", spark.createDataFrame(sat, "HK string, APPLIED_DTS timestamp_ntz, LOAD_DTS timestamp_ntz"),
        fixed_spine("2024-01-01", str(known[-1]), "3 days"), fixed_spine("2024-01-01 03:00:00", str(applied[-1]), "2 days"))
    want = []
    for (k,) in hub:
        for l in known:
            for a in applied:
                best = max(((x, y) for kk, x, y in sat if kk == k and x <= a and y <= l), default=(None, None))
                want.append((k, l, a, *best))
    got = [(x.HK, x.KNOWN_DTS, x.SNAPSHOT_DTS, x.APPLIED_DTS, x.LOAD_DTS) for x in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bitemporal_pit_shuffles_once_per_side(spark):
    import __spark_entry__ as E

    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    plan = E.queries()["pit_bitemporal"](own, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, plan
