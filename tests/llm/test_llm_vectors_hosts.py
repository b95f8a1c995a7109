"""Whitening, centroid clustering and host rules against brute force, with
nulls, ties, repeats, empty tables, long texts and columns of clashing names."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

VECTORS = "vec_id long, embedding array<float>, label int, component string, cluster string, x int, _id string, distance string"
DOCS = "doc_id long, text string, source string, n_words string, host string, _host string, kept string, base_failed int, _w string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", 3, "c", "d") for i, v in rows], VECTORS)


def whole(v, scale=256):
    return [math.floor(scale * float(np.float32(c))) for c in v]


def finite(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


# -- whitening ----------------------------------------------------------------


@pytest.mark.parametrize("kind", ["plain", "equal", "flat", "far", "few"])
def test_rank_one_updates_match_eigh(kind):
    from strongroom.llm.whitening import Spectrum

    rng, d = np.random.default_rng(len(kind)), 12
    x = np.floor(256 * rng.standard_normal((90, d)))
    if kind == "equal":  # equal eigenvalues and repeated vectors
        x = np.eye(d).repeat(3, 0) * 7
    if kind == "flat":  # components that never vary
        x[:, 5:] = 3
    if kind == "far":
        x = x * np.logspace(0, -6, d)
    if kind == "few":  # fewer vectors than dimensions
        x = x[:4]
    a, b, c = Spectrum.empty(d), Spectrum.empty(d), Spectrum.empty(d)
    for k, v in enumerate(x):
        a.add(v)
        (b if k < len(x) // 3 else c).add(v)
    b.merge(c)
    b.merge(Spectrum.empty(d))
    off = x - x.mean(axis=0)
    scatter = off.T @ off
    for s in (a, b):
        size = np.linalg.eigvalsh(scatter)[-1]
        assert s.n == len(x) and np.allclose(s.mean, x.mean(axis=0))
        assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-12
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-12 * size
        assert np.abs(s.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * size


def brute_whitening(rows, k):
    good = [(i, whole(v)) for i, v in rows if finite(v)]
    width = max(Counter(len(x) for _, x in good).items(), key=lambda p: (p[1], p[0]))[0]
    good = [(i, x) for i, x in good if len(x) == width]
    fit = np.array(sorted({tuple(x) for _, x in good}), float)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    off = fit - fit.mean(axis=0)
    values, vecs = np.linalg.eigh(off.T @ off / n)
    out = []
    for i, x in good:
        for c in range(min(k, width)):
            e, p = values[-1 - c], vecs[:, -1 - c]
            if e > 1e-9 * values[-1]:
                out.append((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), float((np.array(x) - fit.mean(axis=0)) @ p / math.sqrt(e)), float(e / values.sum())))
    return out


def check_whitening(df, rows, k=4):
    from strongroom.llm.whitening import whiten

    got = [r.asDict() for r in whiten(df, k=k).collect()]
    want = brute_whitening(rows, k)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    have = sorted([(r["vec_id"], r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"]) for r in got], key=key)
    want = sorted(want, key=key)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    signs = {}
    for h, w in zip(have, want):
        if abs(w[4]) > 1e-6:
            assert signs.setdefault(h[1], h[4] * w[4] > 0) == (h[4] * w[4] > 0)
        assert abs(abs(h[4]) - abs(w[4])) < 1e-9 and abs(h[5] - w[5]) < 1e-9
    assert all(r["identity_error"] < 1e-9 for r in got)
    return got


def odd_rows(width, n, seed):
    rnd = random.Random(seed)
    scale = [3 * 0.8**i for i in range(width)]
    rows = [(i, [rnd.gauss(1, s) for s in scale]) for i in range(n)]
    rows += [(n + i, list(rows[7][1])) for i in range(n // 2)]  # a third are copies of one vector
    rows += [(1, list(rows[3][1])), (None, list(rows[4][1])), (900, None), (901, [None] * width), (902, [math.nan] * width),
             (903, [math.inf] + [0.0] * (width - 1)), (904, []), (905, [1.0] * (width - 1)), (906, [-0.0] * width), (907, [0.0] * width)]
    return rows


def test_whitening(spark):
    rows = odd_rows(6, 80, 1)
    df = vectors(spark, rows).repartition(5)
    got = check_whitening(df, rows)
    assert {r["vec_id"] for r in got}.isdisjoint({900, 901, 902, 903, 904, 905})


def test_whitening_over_many_partitions_matches_one(spark):
    from strongroom.llm import whitening as W

    rows = odd_rows(5, 300, 2)
    ints = W.integer_vectors(vectors(spark, rows), "vec_id", "embedding", 256)
    many, one = W.fit(ints, 4, task_rows=8), W.fit(ints, 4, task_rows=10**6)
    assert (many.n, many.sums) == (one.n, one.sums)
    assert np.abs(many.components - one.components).max() < 1e-10
    assert np.abs(many.eigenvalues / one.eigenvalues - 1).max() < 1e-12


def test_incremental_spectrum_is_what_the_refinement_starts_from(spark):
    from strongroom.llm import whitening as W

    rows = [(i, v) for i, v in odd_rows(5, 120, 3) if finite(v) and len(v) == 5]
    x = sorted({tuple(whole(v)) for _, v in rows})
    fit = spark.createDataFrame([(list(v),) for v in x], "x array<long>").repartition(40)
    s = W.spectrum(fit, 5, 40)
    off = np.array(x, float) - np.mean(x, axis=0)
    assert s.n == len(x) and np.allclose(s.values, np.linalg.eigvalsh(off.T @ off), rtol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, [])]])
def test_whitening_without_variation_is_empty(spark, rows):
    from strongroom.llm.whitening import whiten

    out = whiten(vectors(spark, rows))
    assert out.count() == 0 and "identity_error" in out.columns


def test_whitening_of_fewer_directions_than_components(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)] + [(20, [1.0, 0.0, 5.0])]
    assert {r["component"] for r in check_whitening(vectors(spark, rows), rows)} == {1, 2}


def test_whitening_of_large_values_is_exact(spark):
    rows = [(i, [float(i * 2**30), float(-i * i), 1.0]) for i in range(50)]
    check_whitening(vectors(spark, rows), rows, k=1)
    with pytest.raises(Exception, match="too large"):
        check_whitening(vectors(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0])]), [])


# -- centroids ----------------------------------------------------------------


def brute_clusters(rows, width, k, rounds, seed="2"):
    good = [(i, whole(v)) for i, v in rows if finite(v) and len(v) == width]
    name = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "~"
    centres = [x for _, x in sorted(good, key=lambda r: (name(r[0]), r[1]))[:k]]
    for turn in range(rounds + 1):
        place = []
        for _, x in good:
            far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
            place.append((far.index(min(far)), min(far)))
        if turn < rounds:
            for j in range(len(centres)):
                own = [x for (_, x), (c, _) in zip(good, place) if c == j]
                if own:
                    centres[j] = [sum(col) // len(own) for col in zip(*own)]
    total = sum(d for _, d in place)
    own = Counter()
    for c, d in place:
        own[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    return sorted([(i, c, d, own[c], total, sha[c]) for (i, _), (c, d) in zip(good, place)], key=key)


def clusters(df, **params):
    from strongroom.llm.centroids import cluster

    cols = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    key = lambda r: tuple((v is None, v or 0) for v in r)
    return sorted([tuple(r[c] for c in cols) for r in cluster(df, **params).collect()], key=key)


@pytest.mark.parametrize("k,rounds", [(7, 5), (3, 0), (500, 2)])
def test_clusters(spark, k, rounds):
    rows = odd_rows(6, 80, 4)  # copies, ties, repeated and null ids, unusable vectors
    df = vectors(spark, rows).repartition(4)
    assert clusters(df, width=6, k=k, rounds=rounds) == brute_clusters(rows, 6, k, rounds)


def test_equal_seeds_give_ties_to_the_smaller_number(spark):
    rows = [(i, [1.0, -2.0]) for i in range(30)] + [(50 + i, [4.0, 4.0]) for i in range(30)]
    got = clusters(vectors(spark, rows), width=2, k=12, rounds=3)
    assert got == brute_clusters(rows, 2, 12, 3) and len({r[1] for r in got}) == 2


def test_products_follow_only_the_changed_components(spark):
    from strongroom.llm.centroids import assign, moved

    old, new = [[1, 2, 3], [4, 5, 6]], [[1, 7, 3], [4, 5, 6]]
    assert moved(old, new) == [([1], [5]), ([], [])]
    assert moved(None, [[0, 2]]) == [([1], [2])]
    x = spark.createDataFrame([(1, [2, -3, 5]), (2, [-(2**40), 2**40, 1])], "_id long, x array<long>")
    state = assign(assign(x, None, old), old, new)
    for r in state.collect():
        assert r["dots"] == [sum(a * b for a, b in zip(r["x"], c)) for c in new]


def test_clusters_of_nothing(spark):
    assert clusters(vectors(spark, [])) == [] and clusters(vectors(spark, [(1, None), (2, [1.0])]), width=2) == []


def test_old_states_are_removed(spark, monkeypatch):
    from strongroom.llm import centroids, common

    made, real = [], common.stored_at
    monkeypatch.setattr(centroids, "stored_at", lambda df, name: made.append(real(df, name)) or made[-1])
    centroids.cluster(vectors(spark, odd_rows(3, 20, 5)), width=3, k=2, rounds=2)
    exists = [spark._jvm.org.apache.hadoop.fs.Path(p) for _, p in made]
    exists = [p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) for p in exists]
    assert exists == [False, False, True]


# -- host rules ---------------------------------------------------------------


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "a", "b", "c", "d", 1, "e") for i, t, s in rows], DOCS)


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    where = {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def texts():
    rnd = random.Random(6)
    out = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x " * 200, "a b a b a b a", "    é 日本 😀 #*$%&|<>\n\n#\n#\r\n",
           "  lead and trail \n", "same\nsame\n \n \nsame \nsame", "w1\x0bw2\x0cw3\rw4\tw5 w6\x1cw7"]
    for n in (30, 60, 200, 3000):
        for size in (3, 40, 10**6):
            words = [f"w{rnd.randrange(size)}" for _ in range(n)]
            out.append("".join(w + rnd.choice([" ", "\n", "  ", "\t"]) for w in words))
    return out


def test_counts(spark):
    from strongroom.llm.host_rules import judge

    rows = [(k, t, None) for k, t in enumerate(texts())] + [(None, "null id", "h"), (3, "repeated id", "h")]
    got = judge(docs(spark, rows)).collect()
    want = Counter((i, *brute_counts(t)) for i, t, _ in rows)
    assert Counter((r["doc_id"], *[r[c] for c in COUNTS]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not r["host_failed"])


def test_long_text_takes_time_in_proportion(spark):
    from pyspark.sql import functions as F
    from strongroom.llm.host_rules import statistics
    import time

    rnd, spent = random.Random(7), []
    for n in (50_000, 400_000):
        text = " ".join(f"w{rnd.randrange(40)}" for _ in range(n))
        df = docs(spark, [(1, text, "h")])
        t0 = time.perf_counter()
        r = statistics(df, "text", [F.col("doc_id")]).first()
        spent.append(time.perf_counter() - t0)
        assert tuple(r[c] for c in COUNTS) == brute_counts(text)
    assert spent[1] < 40 * max(spent[0], 0.5)


def clean(k):
    rnd = random.Random(k)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(80))


def test_hosts_that_mostly_fail_lose_their_documents(spark):
    from strongroom.llm.host_rules import judge

    noisy = "# " * 30
    rows = [(k, clean(k) + (noisy if k % 20 else ""), "https://WWW.Spam.example/a?b") for k in range(100)]
    rows += [(1000 + k, clean(k) + (noisy if k % 20 == 0 else ""), f"http://h{k % 10}.example/{k}") for k in range(300)]
    rows += [(2000 + k, clean(k) + noisy, "tiny.example") for k in range(1)]  # one bad page says little
    rows += [(3000 + k, clean(k), None) for k in range(5)] + [(3100, clean(3), " ")]
    got = {r["doc_id"]: r for r in judge(docs(spark, rows), keep=("source",)).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r["host_failed"] == (i < 100) and not r["base_failed"] and r["kept"] == (i >= 100)


def test_prior():
    from strongroom.llm.host_rules import beta_prior

    rnd = random.Random(8)
    hosts = [(n, sum(rnd.random() < p for _ in range(n))) for n in (500,) * 400 for p in [rnd.betavariate(2, 6)]]
    sums = lambda h: (sum(n for n, _ in h), sum(f for _, f in h), len(h), sum(n * n for n, _ in h), sum(f * f / n for n, f in h))
    alpha, beta = beta_prior(*sums(hosts))
    assert 1.5 < alpha < 2.6 and 4.5 < beta < 7.8
    same = [(500, 50)] * 40
    alpha, beta = beta_prior(*sums(same))
    assert alpha + beta > 1e5 and abs(alpha / (alpha + beta) - 0.1) < 1e-9
    assert beta_prior(0, 0, 0, 0, 0) == (0.0, pytest.approx(0, abs=1e7)) and beta_prior(*sums([(10, 10)]))[1] == 0


def test_hosts_of_an_empty_table(spark):
    from strongroom.llm.host_rules import judge

    assert judge(docs(spark, [])).count() == 0


def test_host_plan_is_native(spark):
    from strongroom.llm.host_rules import judge

    plan = judge(docs(spark, [(1, "a", "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
