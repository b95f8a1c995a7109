"""Inputs that no registered oracle holds: refused keys, delimiters in keys,
empty snapshot ranges, undeleted relations, batches of effectivity."""

import datetime as dt

from pyspark.sql import functions as F

from strongroom.functions.rules import mask_phones
from strongroom.operators import profiling as P
from strongroom.operators.audit import audit_hash_drift
from strongroom.operators.effectivity import driving_key_effectivity, driving_key_rejects
from strongroom.operators.hub import hub_rejects, load_hub
from strongroom.operators.link import link_rejects, load_link
from strongroom.operators.satellite import load_multi_active_sets, load_sat, sat_rejects
from strongroom.operators.specs import HubSpec, LinkSpec, SatSpec
from strongroom.plans.snapshot import Spine, build_bridge, build_pit, fixed_spine
from strongroom.sources.io import materialise, row_count_meta
from strongroom.streaming.microbatch import VaultTarget, stream_load, unseen_sink
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
FEED = "C_NUM string, EMAIL string, LOAD_DTS timestamp_ntz, REC_SRC string"
HUB = HubSpec("HUB_C", "C_HK", ("C_NUM",))
SAT = SatSpec("SAT_C", "C_HK", ("EMAIL",), parent_bk=("C_NUM",))
LINK = LinkSpec("L", "L_HK", (("A_HK", ("A",)), ("B_HK", ("B",))))
PAIRS = "A string, B string, LOAD_DTS timestamp_ntz, REC_SRC string"


def t(d, h=0):
    return T0 + dt.timedelta(days=d, hours=h)


def test_satellite_refuses_what_the_hub_refuses_and_returns_it(spark):
    s = spark.createDataFrame([("", "a", t(0), "S"), (None, "b", t(0), "S"), ("q", "c", t(0), "S"), ("r", "x", t(1), "S"), ("r", "y", t(1), "S")], FEED)
    assert load_hub(s, None, HUB).count() == 2
    sat = load_sat(s, None, SAT)
    assert rows(sat, "EMAIL") == [("c",)]
    assert rows(sat_rejects(s, SAT), "EMAIL", "REASON") == [("a", "KEY"), ("b", "KEY"), ("x", "TIE"), ("y", "TIE")]
    assert sat.count() + sat_rejects(s, SAT).count() == s.count()


def test_delimiter_in_a_key_part_gives_one_row_per_link_key(spark):
    s = spark.createDataFrame([("x|y", "z", t(0), "S"), ("x", "y|z", t(1), "S"), (None, "z", t(0), "S")], PAIRS)
    link = load_link(s, None, LINK)
    assert link.count() == 1 and link.first().LOAD_DTS == t(0)
    assert load_link(s, link, LINK).count() == 0
    assert link_rejects([s, s], LINK).count() == 2


def test_sets_take_a_repeated_row_once(spark):
    spec = SatSpec("SAT_M", "C_HK", ("V",), parent_bk=("C_NUM",), ssqn="SSQN")
    cols = "C_NUM string, SSQN int, V string, LOAD_DTS timestamp_ntz, REC_SRC string"
    one = [("c1", 1, "a", t(1), "S"), ("c1", 2, "b", t(1), "S")]
    sat = load_multi_active_sets(spark.createDataFrame(one + one[:1], cols), None, spec)
    assert sat.count() == 2
    again = [(c, n, v, t(2), s) for c, n, v, _, s in one]
    assert load_multi_active_sets(spark.createDataFrame(again + again[1:], cols), sat, spec).count() == 0


def test_pit_without_new_snapshots_is_empty(spark):
    hub = spark.createDataFrame([("k1", t(0)), ("late", t(9))], "HK string, LOAD_DTS timestamp_ntz")
    sat = spark.createDataFrame([("k1", t(1)), ("gone", t(1))], "HK string, LOAD_DTS timestamp_ntz")
    spine = fixed_spine("2024-01-01", "2024-01-04 12:00:00")  # ends between two snapshots
    pit = build_pit(hub, "HK", {"S": sat}, spine)
    assert pit.count() == 8 and rows(pit.filter("HK = 'k1'"), "SNAPSHOT_DTS", "S")[-1] == (t(3), t(1))
    assert build_pit(hub, "HK", {"S": sat}, spine, since=F.lit(t(3))).count() == 0
    assert build_pit(hub, "HK", {"S": sat}, spine, since=F.lit(t(1))).count() == 4
    known = build_pit(hub, "HK", {"S": sat}, spine, known_keys_only=True)
    assert rows(known.select("HK").distinct()) == [("k1",)]
    assert build_pit(hub, "HK", {"S": sat}, fixed_spine("2024-02-01", "2024-01-01")).count() == 0


def test_month_ends_keep_their_numbers(spark):
    spine = Spine(F.lit(dt.datetime(2024, 1, 31)), F.lit(dt.datetime(2024, 5, 30)), "1 month")
    hub = spark.createDataFrame([("k", dt.datetime(2024, 2, 1))], "HK string, LOAD_DTS timestamp_ntz")
    pit = build_pit(hub, "HK", {"S": hub}, spine, known_keys_only=True)
    assert [r.SNAPSHOT_DTS for r in pit.orderBy("SNAPSHOT_DTS").collect()] == [dt.datetime(2024, 2, 29), dt.datetime(2024, 3, 31), dt.datetime(2024, 4, 30)]


def test_bridge_off_step_end_links_and_undelete(spark):
    day = lambda y, m=1: dt.datetime(y, m, 1)
    base = spark.createDataFrame([("b1", "o1", day(1996, 6)), ("b2", "o2", day(2002, 3)), ("b3", None, day(1995))], "B string, O string, LOAD_DTS timestamp_ntz")
    pay = spark.createDataFrame([("o1", "p1", day(1998)), ("o1", "p2", day(1999, 2))], "O string, P string, LOAD_DTS timestamp_ntz")
    spine = fixed_spine("1996-01-01", "2002-06-01", "1 year")
    plain = build_bridge(base, ["B", "O"], [(pay, "O", ["P"])], spine)
    want = [("b1", 1997, None), ("b1", 1998, "p1"), ("b1", 1999, "p1")]
    want += [("b1", y, p) for y in (2000, 2001, 2002) for p in ("p1", "p2")] + [("b3", y, None) for y in range(1996, 2003)]
    got = [(r.B, r.SNAPSHOT_DTS.year, r.P) for r in plain.collect()]
    key = lambda r: (r[0], r[1], r[2] or "")
    assert sorted(got, key=key) == sorted(want, key=key)
    gone = spark.createDataFrame([("b3", day(1997, 5), 1), ("b3", day(1999, 5), 0), ("b3", day(2001), 1)], "B string, LOAD_DTS timestamp_ntz, IS_DELETED int")
    left = build_bridge(base, ["B"], [], spine, deleted=gone, deleted_key="B").filter("B = 'b3'")
    assert sorted(r.SNAPSHOT_DTS.year for r in left.collect()) == [1996, 1997, 2000]
    final = build_bridge(base, ["B"], [], spine, deleted=gone.drop("IS_DELETED").limit(1), deleted_key="B").filter("B = 'b3'")
    assert sorted(r.SNAPSHOT_DTS.year for r in final.collect()) == [1996, 1997]


def test_driving_key_batches_equal_one_shot(spark):
    data = [("u", o, t(k), "S") for k, o in enumerate("AABBABCC")] + [("v", "A", t(3), "S"), (None, "A", t(1), "S"), ("v", None, t(1), "S"), ("w", "B", t(2), "S"), ("w", "A", t(2), "S")]
    df = spark.createDataFrame(data, "U string, O string, LOAD_DTS timestamp_ntz, REC_SRC string")
    cols = ("U", "O", "LOAD_DTS", "BEGIN_DTS", "END_DTS", "L_HK")
    found = lambda d: sorted((str(tuple(r)) for r in d.select(*cols).collect()))
    whole = found(driving_key_effectivity(df, "L_HK", ["U"], ["O"]))
    assert driving_key_rejects(df, ["U"], ["O"]).count() == 2
    stored = None
    for lo, hi in [(0, 2), (1, 4), (4, 5), (5, 9)]:  # the second overlaps the first
        batch = df.filter((F.col("LOAD_DTS") >= t(lo)) & (F.col("LOAD_DTS") < t(hi)))
        new = driving_key_effectivity(batch, "L_HK", ["U"], ["O"], stored=stored)
        new = spark.createDataFrame(new.collect(), new.schema)
        stored = new if stored is None else stored.unionByName(new)
    assert found(stored) == whole


def test_materialised_table_is_refreshed(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    old = spark.createDataFrame([(1, "old"), (2, "same")], "K int, V string")
    new = spark.createDataFrame([(1, "new"), (3, "more")], "K int, V string")
    assert materialise(old, path, "refresh", ["K"]).count() == 2
    assert rows(materialise(new, path, "refresh", ["K"])) == [(1, "new"), (2, "same"), (3, "more")]
    assert row_count_meta(spark, path).first()[0] == 3


def test_hash_drift_sees_a_missing_key(spark):
    hub = spark.createDataFrame([(None, "a")], "HK string, BK string")
    assert audit_hash_drift(hub, "HK", ["BK"]).count() == 1


def test_every_column_is_profiled_and_values_are_whole(spark):
    df = spark.range(2).select("id", F.create_map(F.lit("a"), "id").alias("m"))
    out = {r.column_name: (r.populated, r.distinct_vals) for r in P.profile_columns(df).collect()}
    assert out == {"id": (2, 2), "m": (2, None)}
    long = spark.createDataFrame([("x" * 150 + "b",), ("x" * 150 + "a",)], "v string")
    assert [r.value[-1] for r in P.top_values(long, "v").collect()] == ["a", "b"]


def test_stream_loses_no_row(spark, tmp_path):
    root = f"file://{tmp_path}"
    first = [("a", "1", t(9), "S"), (None, "2", t(9), "S"), ("b", "3", t(9), "S"), ("b", "4", t(9), "S")]
    late = [("a", "0", t(0), "S"), ("a", "1", t(9), "S")]
    targets = [VaultTarget(HUB, f"{root}/hub", rejects=f"{root}/r/hub"), VaultTarget(SAT, f"{root}/sat", rejects=f"{root}/r/sat")]
    sink = unseen_sink(f"{root}/seen", ["C_NUM", "EMAIL"], "LOAD_DTS")
    for k, batch in enumerate([first, late]):
        spark.createDataFrame(batch, FEED).write.parquet(f"{root}/in/d{k}")
        src = spark.readStream.schema(FEED).parquet(f"{root}/in/*")
        stream_load(src, targets, f"{root}/c1").awaitTermination()
        src.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/c2").trigger(availableNow=True).start().awaitTermination()
    assert rows(targets[1].read(spark), "EMAIL") == [("0",), ("1",)]
    refused = spark.read.parquet(f"{root}/r/sat")
    assert rows(refused, "EMAIL", "REASON") == [("2", "KEY"), ("3", "TIE"), ("4", "TIE")]
    assert spark.read.parquet(f"{root}/r/hub").count() == 1 == hub_rejects(spark.createDataFrame(first, FEED), HUB).count()
    assert spark.read.parquet(f"{root}/seen").count() == 5  # the late row is kept, the repeated one is not


def test_phone_mask_leaves_dates_and_numbers(spark):
    texts = ["on 2024-01-15 order 123456789", "05/06/2024 05.06.2024", "ip 192.168.100.101", "card 4111111111111111"]
    phones = ["+1 (555) 123-4567", "0412 345 678", "555-123-4567", "(02) 9123 4567"]
    df = spark.createDataFrame([(t,) for t in texts + [f"call {p} now" for p in phones]], "t string")
    assert [r[0] for r in df.select(mask_phones("t")).collect()] == texts + ["call <PHONE> now"] * len(phones)
