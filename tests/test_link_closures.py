"""Same-as chains, hierarchy closures, exploration links, refreshed tables, observations."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strongroom.operators.effectivity import load_effectivity, observed_effectivity
from strongroom.operators.link import ancestors, exploration_link, hierarchy_cycles, resolve_same_as, same_as_masters
from strongroom.plans import mart
from strongroom.sources import io
from strongroom.sources.io import materialise, scratch_path

T0 = dt.datetime(2024, 1, 1)


def sal(spark, pairs):
    rows = [(s, m, T0 + dt.timedelta(hours=k)) for k, (s, m) in enumerate(pairs)]
    return spark.createDataFrame(rows, "S string, M string, LOAD_DTS timestamp_ntz")


def brute_masters(pairs):
    first = {}
    for s, m in pairs:
        if s is not None and m is not None:
            first.setdefault(s, m)
    first = {s: m for s, m in first.items() if s != m}
    out = {}
    for s in first:
        seen, at = [s], first[s]
        while at in first and at not in seen:
            seen.append(at)
            at = first[at]
        out[s] = (min(seen[seen.index(at):]), True) if at in first else (at, False)
    return out


CASES = {
    "chain": [("a", "b"), ("b", "c"), ("c", "d")],
    "long": [(f"n{i:03}", f"n{i + 1:03}") for i in range(37)],
    "cycle": [("x", "y"), ("y", "z"), ("z", "x"), ("t", "u"), ("u", "x"), ("a", "t")],
    "pair": [("a", "b"), ("b", "a")],
    "self": [("a", "a"), ("b", "a")],
    "several masters": [("a", "b"), ("a", "c"), ("c", "d"), ("b", "e")],
    "nulls": [(None, "b"), ("a", None), ("c", "d")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_same_as_masters(spark, case):
    got = {r.S: (r.M, r.CYCLE) for r in same_as_masters(sal(spark, CASES[case]), "S", "M").collect()}
    assert got == brute_masters(CASES[case])


def test_random_same_as_links(spark):
    r = random.Random(1)
    pairs = [(f"k{r.randrange(60):02}", f"k{r.randrange(90):02}") for _ in range(70)]
    rows = same_as_masters(sal(spark, pairs), "S", "M").collect()
    assert {x.S: (x.M, x.CYCLE) for x in rows} == brute_masters(pairs) and len(rows) == len(brute_masters(pairs))


def test_rows_get_their_last_master(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "q"), (4, None)], "i int, K string")
    out = resolve_same_as(df, sal(spark, CASES["chain"]), "K", "S", "M").collect()
    assert sorted((r.i, r.K) for r in out) == [(1, "d"), (2, "d"), (3, "q"), (4, None)]


def brute_ancestors(edges):
    up = {}
    for c, p in edges:
        if c is not None and p is not None:
            up.setdefault(c, set()).add(p)
    out = {}
    for c in up:
        level, n, seen = up[c], 1, {}
        while level:
            for a in level:
                seen.setdefault(a, n)
            level, n = {b for a in level for b in up.get(a, ())} - set(seen), n + 1
        out.update({(c, a): d for a, d in seen.items()})
    return out


def test_ancestors(spark):
    r = random.Random(2)
    cases = [[(f"p{i}", f"p{i // 3}") for i in range(1, 60)], [(f"d{i}", f"d{i - 1 - r.randrange(2)}") for i in range(2, 30)] + [("d5", "d1")],
             [("a", "b"), ("b", "c"), ("c", "a"), ("z", "a"), (None, "a"), ("a", None)], [], [("s", "s")]]
    for edges in cases:
        link = spark.createDataFrame(edges, "C string, P string")
        got = ancestors(link, "C", "P")
        assert {(x.C, x.P): x.DEPTH for x in got.collect()} == brute_ancestors(edges)
        assert {x.C for x in hierarchy_cycles(got, "C", "P").collect()} == {c for c, a in brute_ancestors(edges) if c == a}


def test_exploration_link_keeps_first_load_and_source(spark):
    rows = [("a", "b", T0, "Y"), ("a", "b", T0, "X"), ("a", "b", T0 + dt.timedelta(1), "A"), (None, "b", T0, "X"), ("a", "c", None, "X")]
    out = exploration_link(spark.createDataFrame(rows, "A string, B string, LOAD_DTS timestamp_ntz, REC_SRC string"), "HK", ["A", "B"])
    assert [(r.A, r.B, r.LOAD_DTS, r.REC_SRC) for r in out.collect()] == [("a", "b", T0, "X")]


# -- refreshed tables ---------------------------------------------------------


def view(spark, rows):
    return spark.createDataFrame(rows, "K string, L int, V string")


def table(df):
    return sorted((str(r.K), str(r.L), r.V) for r in df.collect())


def files(spark, path):
    return {f for f in spark.read.parquet(path).inputFiles()}


def test_refresh_replaces_changed_keys_only(spark):
    path = scratch_path(spark, "refreshed")
    rows = [(f"k{i}", i, "old") for i in range(40)] + [(None, 1, "null key"), (None, None, "both"), ("k1", 1, "second row")]
    out = materialise(view(spark, rows), path, "refresh", ["K", "L"], buckets=8)
    assert table(out) == table(view(spark, rows)) and out.columns == ["K", "L", "V"]
    before = files(spark, path)
    materialise(view(spark, rows[::-1]), path, "refresh", ["K", "L"], buckets=8)
    assert files(spark, path) == before  # nothing changed: no file is written
    change = [("k7", 7, "new"), (None, None, "both, new"), ("k1", 1, "old")]  # k1 loses a row
    out = materialise(view(spark, change), path, "refresh", ["K", "L"], buckets=8)
    want = [r for r in rows if r[:2] not in {c[:2] for c in change}] + change
    assert table(out) == table(view(spark, want))
    kept = files(spark, path) & before
    assert kept and len(files(spark, path) - before) <= 3
    assert table(materialise(view(spark, change), path, "refresh", ["K", "L"], buckets=8)) == table(view(spark, want))
    with pytest.raises(ValueError):
        materialise(view(spark, change), path, "refresh", ["K", "L"], buckets=9)


def test_a_broken_refresh_is_finished_by_the_next(spark, monkeypatch):
    path = scratch_path(spark, "broken")
    materialise(view(spark, [("a", 1, "old"), ("b", 1, "old")]), path, "refresh", ["K"], buckets=4)
    real, calls = io.finish_refresh, []

    def fails(session, p):
        calls.append(p)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        real(session, p)

    monkeypatch.setattr(io, "finish_refresh", fails)
    with pytest.raises(RuntimeError):
        materialise(view(spark, [("a", 1, "new")]), path, "refresh", ["K"], buckets=4)
    monkeypatch.setattr(io, "finish_refresh", real)
    assert table(spark.read.parquet(path)) == [("a", "1", "old"), ("b", "1", "old")]
    out = materialise(view(spark, [("c", 1, "more")]), path, "refresh", ["K"], buckets=4)
    assert table(out) == [("a", "1", "new"), ("b", "1", "old"), ("c", "1", "more")]
    assert not io.written(spark, path + "__pending")


def test_incremental_null_keys_are_added_once(spark):
    path = scratch_path(spark, "incremental")
    rows = view(spark, [(None, 1, "x"), ("a", 1, "y")])
    for _ in range(3):
        out = materialise(rows, path, "incremental", ["K"])
    assert table(out) == table(rows)


# -- observations, fact arguments ---------------------------------------------


def test_observations_load_as_effectivity(spark):
    h = lambda *r: spark.createDataFrame([(k, T0 + dt.timedelta(days=d)) for k, d in r], "HK string, LOAD_DTS timestamp_ntz")
    eff = load_effectivity(observed_effectivity(h(("a", 3), ("a", 1), ("b", 2), (None, 4)), "HK"), None, "HK")
    again = observed_effectivity(h(("a", 3), ("a", 1)), "HK", eff)
    assert load_effectivity(again, eff, "HK").isEmpty()
    later = load_effectivity(observed_effectivity(h(("a", 5), ("c", 6)), "HK", eff), eff, "HK").collect()
    assert sorted((r.HK, r.BEGIN_DTS.day, r.END_DTS.day, r.LOAD_DTS.day) for r in later) == [("a", 2, 6, 6), ("c", 7, 7, 7)]
    late = observed_effectivity(h(("b", 0)), "HK", eff).first()
    assert (late.BEGIN_DTS.day, late.END_DTS.day) == (1, 3)


def test_fact_takes_the_link_keys_itself(spark):
    link = spark.createDataFrame([("l", "h", T0)], "L_HK string, H_HK string, LOAD_DTS timestamp_ntz")
    hub = spark.createDataFrame([("h", "1")], "H_HK string, NUM string")
    sat = spark.createDataFrame([("l", T0, "d", 5)], "L_HK string, LOAD_DTS timestamp_ntz, HASH_DIFF string, QTY int")
    out = mart.fact(link, "L_HK", hub, "H_HK", ["NUM"], [], sat, ["L_HK"], ["QTY"], "QTY")
    assert [(r.L_HK, r.NUM, r.QTY) for r in out.collect()] == [("l", "1", 5)]
    with pytest.raises(ValueError, match="lack the link key"):
        mart.fact(link, "L_HK", hub, "H_HK", [], [], sat.withColumnRenamed("L_HK", "K"), ["K"], ["QTY"], "QTY")
    with pytest.raises(ValueError, match="link has no"):
        mart.fact(link.drop("H_HK"), "L_HK", hub, "H_HK", [], [], sat, ["L_HK"], ["QTY"], "QTY")
