"""Extended PITs against builds from all history; bridges with effectivity tables."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from strongroom.operators.sat_store import SatStore
from strongroom.operators.specs import SatSpec
from strongroom.plans.snapshot import build_bridge, build_pit, extend_pit, fixed_spine
from strongroom.sources.io import append, scratch_path

D = lambda n, h=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=h)


def texts(df):
    return sorted(str(r) for r in df.select(sorted(df.columns)).collect())


def hub_and_sats(spark, seed):
    r = random.Random(seed)
    versions = [sorted({(f"k{r.randrange(22)}", D(r.randrange(25), r.choice([0, 5]))) for _ in range(150)}) for _ in "AB"]
    first = {f"k{i}": min([D(r.randrange(16))] + [t for v in versions for k, t in v if k == f"k{i}"]) for i in range(20)}
    late = {k: t if k != "k3" else D(14) for k, t in first.items()}  # k3 comes after the first snapshots
    versions = [[(k, t) for k, t in v if t >= late.get(k, D(0))] for v in versions]
    frame = lambda rows: spark.createDataFrame(rows, "HK string, LOAD_DTS timestamp_ntz")
    return frame(list(late.items())), {n: frame(v) for n, v in zip("AB", versions)}


def test_extended_pit_equals_build_from_all_history(spark):
    hub, sats = hub_and_sats(spark, 1)
    for known in (False, True):
        first, whole = fixed_spine("2024-01-01", "2024-01-10"), fixed_spine("2024-01-01", "2024-01-22")
        path = scratch_path(spark, "pit")
        append(build_pit(hub, "HK", sats, first, known), path, ["SNAPSHOT_DTS"])
        pit = spark.read.parquet(path)
        new = extend_pit(pit, hub, "HK", sats, whole, known)
        since = F.lit(dt.datetime(2024, 1, 10))
        assert texts(new) == texts(build_pit(hub, "HK", sats, whole, known, since=since)) and not new.isEmpty()
        assert texts(pit.unionByName(new)) == texts(build_pit(hub, "HK", sats, whole, known))
        assert extend_pit(pit, hub, "HK", sats, first, known).isEmpty()
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "(LOAD_DTS" in plan and re.search(r"PartitionFilters: \[isnotnull\(SNAPSHOT_DTS#\d+\), \(SNAPSHOT_DTS#\d+ = 2024-01-10", plan), plan
        assert texts(extend_pit(pit.limit(0), hub, "HK", sats, whole, known)) == texts(build_pit(hub, "HK", sats, whole, known))


def test_late_versions_are_in_force_in_new_snapshots(spark):
    hub = spark.createDataFrame([("a", D(0)), ("b", D(0))], "HK string, LOAD_DTS timestamp_ntz")
    spine = lambda end: fixed_spine("2024-01-01", end)
    row = lambda *r: spark.createDataFrame(r, "HK string, LOAD_DTS timestamp_ntz")
    pit = build_pit(hub, "HK", {"A": row(("a", D(1)))}, spine("2024-01-05"))
    late = {"A": row(("a", D(1)), ("a", D(3)), ("b", D(2)))}
    new = extend_pit(pit, hub, "HK", late, spine("2024-01-06"), late_days=3)
    assert sorted((r.HK, r.A) for r in new.collect()) == [("a", D(3)), ("b", D(2))]
    assert sorted((r.HK, r.A) for r in extend_pit(pit, hub, "HK", late, spine("2024-01-06")).collect()) == [("a", D(1)), ("b", None)]


def test_a_store_is_read_from_the_last_snapshot_on(spark):
    spec = SatSpec("S", "HK", ("V",), parent_bk=("K",))
    store = SatStore(spark, scratch_path(spark, "s"), spec)
    feed = spark.createDataFrame([(f"k{i % 5}", str(i), D(i), "X") for i in range(20)], "K string, V string, LOAD_DTS timestamp_ntz, REC_SRC string")
    store.load(feed)
    hub = store.read().select("HK", "LOAD_DTS").groupBy("HK").agg(F.min("LOAD_DTS").alias("LOAD_DTS"))
    pit = build_pit(hub, "HK", {"A": store.read()}, fixed_spine("2024-01-01", "2024-01-12"))
    new = extend_pit(pit, hub, "HK", {"A": store}, fixed_spine("2024-01-01", "2024-01-20"))
    assert re.search(r"PartitionFilters: \[isnotnull\(LOAD_DATE#\d+\), \(LOAD_DATE#\d+ >= 2024-01-12\)\]", new._jdf.queryExecution().executedPlan().toString())
    assert texts(new) == texts(build_pit(hub, "HK", {"A": store.read()}, fixed_spine("2024-01-01", "2024-01-20"), since=F.lit(D(11))))


def brute_bridge(rows, effs, days):
    out = []
    for day in days:
        for hk, ok, pk, t in rows:
            gone = False
            for k, states in ((ok, effs[0]), (pk, effs[1])):
                known = [(s, g) for key, s, g in states if key == k and s <= day]
                gone |= bool(known) and max(known)[1] == 1
            if t <= day and not gone:
                out.append((hk, day))
    return sorted(out)


def test_bridge_subtracts_several_effectivity_tables(spark):
    r = random.Random(5)
    rows = [(f"h{i}", f"o{i % 7}", f"p{i % 5}", D(r.randrange(15), r.choice([0, 7]))) for i in range(40)]
    effs = [[(f"{c}{r.randrange(6)}", D(r.randrange(-3, 18), r.choice([0, 3])), r.randrange(2)) for _ in range(25)] for c in "op"]
    effs = [list({(k, t): (k, t, g) for k, t, g in e}.values()) for e in effs]
    effs[0].append(("o6", D(-9), 1))  # gone before the first snapshot, for good
    link = spark.createDataFrame(rows, "HK string, O string, P string, LOAD_DTS timestamp_ntz")
    tables = [(spark.createDataFrame(e, "K string, LOAD_DTS timestamp_ntz, IS_DELETED int").withColumnRenamed("K", c), c) for e, c in zip(effs, "OP")]
    out = build_bridge(link, ["HK", "O", "P"], [], fixed_spine("2024-01-01", "2024-01-20"), deleted=tables)
    got = sorted((x.HK, x.SNAPSHOT_DTS) for x in out.collect())
    assert got == brute_bridge(rows, effs, [D(k) for k in range(20)])


def test_bridge_stretches_after_the_last_shuffle(spark):
    import __spark_entry__ as E

    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("bridge_effective", "bridge_two_effectivities"):
        plan = E.queries()[name](own, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and plan.index("Generate explode(sequence") < plan.index("Exchange"), plan
