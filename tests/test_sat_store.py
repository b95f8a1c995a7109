"""A satellite stored by load date against loads that read all of it."""

import datetime as dt
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from strongroom.operators.sat_store import SatStore
from strongroom.operators.satellite import load_sat
from strongroom.operators.specs import SatSpec
from strongroom.sources.io import append, read_or_none, scratch_path

SPEC = SatSpec("SAT", "K_HK", ("V",), parent_bk=("K",))
MULTI = SatSpec("SAT", "K_HK", ("V",), parent_bk=("K",), ssqn="N")
COLS = "K string, N int, V string, LOAD_DTS timestamp_ntz, REC_SRC string"


def feed(spark, rows):
    return spark.createDataFrame(rows, COLS)


def random_rows(seed, n=400, days=30):
    r, seen, out = random.Random(seed), set(), []
    for _ in range(n):
        k, t = f"k{r.randrange(12)}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(24 * days))
        if (k, t) not in seen:
            seen.add((k, t))
            out.append((k, r.randrange(2), r.choice("ab"), t, "S"))
    return out


def texts(df):
    return sorted(str(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("spec,roll_days", [(SPEC, 1), (MULTI, 5)])
def test_batches_in_any_order_equal_full_reads(spark, spec, roll_days):
    rows, r = random_rows(roll_days), random.Random(9)
    store = SatStore(spark, scratch_path(spark, "store"), spec, roll_days)
    plain = scratch_path(spark, "plain")
    for _ in range(6):  # windows at random: in order, overlapping, late, again, with a gap, empty
        lo = r.randrange(30)
        batch = [x for x in rows if lo <= (x[3] - dt.datetime(2024, 1, 1)).days < lo + r.choice([0, 3, 9])]
        stg = feed(spark, batch + [(None, 0, "a", dt.datetime(2023, 1, 1), "S"), ("k1", 0, "a", None, "S")])
        append(load_sat(stg, read_or_none(spark, plain), spec), plain)
        store.load(stg)
        stored = store.read()
        want = read_or_none(spark, plain)
        assert (texts(stored) if stored is not None else []) == texts(want)


def test_a_load_reads_heads_and_later_partitions_only(spark):
    rows = random_rows(3)
    store = SatStore(spark, scratch_path(spark, "store"), SPEC)
    day = dt.datetime(2024, 1, 20)
    store.load(feed(spark, [x for x in rows if x[3] < day]))
    store.load(feed(spark, [x for x in rows if x[3] >= day]))
    assert store.heads_days() == [day.date()]
    new = store.new_rows(feed(spark, [("k1", 0, "z", dt.datetime(2024, 1, 25), "S")]), dt.date(2024, 1, 25))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(LOAD_DATE#\d+\), \(LOAD_DATE#\d+ >= 2024-01-20\)\]", plan), plan
    read = store.boundary(dt.date(2024, 1, 25)).select(F.input_file_name().alias("f")).distinct().collect()
    dates = [r.f.split("LOAD_DATE=")[1][:10] for r in read if "LOAD_DATE=" in r.f]
    assert dates and min(dates) >= "2024-01-20" and any("AS_OF=2024-01-20" in r.f for r in read)


def test_late_rows_remove_later_heads_and_an_unfinished_one_is_not_read(spark):
    rows = random_rows(4)
    store = SatStore(spark, scratch_path(spark, "store"), SPEC)
    for lo, hi in ((1, 11), (11, 21), (21, 31)):
        store.load(feed(spark, [x for x in rows if lo <= x[3].day < hi]))
    assert [d.day for d in store.heads_days()] == [11, 21]
    store.load(feed(spark, [("k1", 0, "late", dt.datetime(2024, 1, 15, 1, 7), "S")]))
    assert [d.day for d in store.heads_days()] == [11, 15]
    # A heads folder without _SUCCESS is what a lost job leaves.
    path = store._heads_path(dt.date(2024, 1, 27))
    spark.createDataFrame([(uuid.uuid4().hex,)], "x string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert [d.day for d in store.heads_days()] == [11, 15]
    store.load(feed(spark, [x for x in rows if x[3].day >= 28]))
    assert store.read().filter(F.col("V") == "late").count() == 1


def test_empty_loads(spark):
    store = SatStore(spark, scratch_path(spark, "store"), SPEC)
    assert store.read() is None
    store.load(feed(spark, []))
    store.load(feed(spark, [(None, 0, "a", dt.datetime(2024, 1, 1), "S")]))
    assert store.read() is None and store.heads_days() == []


def test_every_delivered_row_is_accounted(spark, tmp_path):
    from strongroom.operators.specs import HubSpec
    from strongroom.streaming.microbatch import VaultTarget, stream_load

    root, day = f"file://{tmp_path}", dt.datetime(2024, 1, 1)
    targets = [VaultTarget(SPEC, f"{root}/sat", f"{root}/r/sat"), VaultTarget(HubSpec("HUB", "K_HK", ("K",)), f"{root}/hub", f"{root}/r/hub")]
    batches = [
        [("a", 0, "1", day, "S"), ("a", 0, "1", day, "S"), (None, 0, "1", day, "S"), ("b", 0, "1", day, "S"), ("b", 0, "2", day, "S")],
        [("a", 0, "1", day, "S"), ("a", 0, "1", day + dt.timedelta(1), "S"), ("a", 0, "2", day + dt.timedelta(2), "S"), ("c", 0, "1", day, "S")],
        [(" ", 0, "1", day, "S")],
    ]
    for k, batch in enumerate(batches):
        feed(spark, batch).coalesce(1).write.parquet(f"{root}/in/d{k}")
        src = spark.readStream.schema(COLS).parquet(f"{root}/in/*")
        stream_load(src, targets, f"{root}/c", accounts=f"{root}/accounts").awaitTermination()
    got = {(r.BATCH_ID, r.TARGET): (r.DELIVERED, r.REFUSED, r.LOADED, r.ABSORBED) for r in spark.read.parquet(f"{root}/accounts").collect()}
    assert got == {
        (0, "HUB"): (5, 1, 2, 2), (0, "SAT"): (5, 3, 1, 1), (1, "HUB"): (4, 0, 1, 3), (1, "SAT"): (4, 0, 2, 2),
        (2, "HUB"): (1, 1, 0, 0), (2, "SAT"): (1, 1, 0, 0),
    }
