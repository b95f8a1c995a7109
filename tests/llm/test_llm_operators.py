"""Operators against brute force on small frames with nulls, ties, repeats,
empty tables and columns of clashing names."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, `_text` string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with results and internals."""
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), 0.5, "x", "y") for i, t, lang, src in rows], DOCS)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# -- embeddings ---------------------------------------------------------------


def brute_links(rows, threshold):
    good = {k: v for k, (i, v, lab) in enumerate(rows) if lab is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    near = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b]):
                if max(map(abs, good[a] + good[b])) > 1e100:
                    continue  # no link here, and squares overflow
                dot = sum(x * y for x, y in zip(good[a], good[b]))
                if dot / math.sqrt(sum(x * x for x in good[a])) / math.sqrt(sum(x * x for x in good[b])) >= threshold:
                    near[a].add(b)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        out.append((rows[k][0], len(near[k]), min(ids, default=None)))
    return sorted(out, key=str)


def test_embedding_links(spark):
    from strongroom.llm.embedding_links import near_duplicates

    rnd, rows = random.Random(4), []
    for i in range(60):
        base = [rnd.gauss(0, 1) for _ in range(8)]
        rows.append((len(rows), base, i % 3))
        for _ in range(rnd.choice([0, 0, 1, 6])):
            rows.append((len(rows), [x + rnd.gauss(0, 0.06) for x in base], i % 3))
    rows += [(900, rows[0][1], 0), (900, rows[0][1], 0), (901, None, 1), (902, [0.0] * 8, 1), (903, [1.0, None] + [0.0] * 6, 1), (904, [float("nan")] * 8, 1),
             (905, [float("inf")] * 8, 1), (906, rows[0][1], None), (907, [], 1), (None, rows[0][1], 0), (909, [2.0, 1.0], 1), (910, [1e200, -5e199], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, component_id string, n_links int")
    got = near_duplicates(df).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == brute_links(rows, 0.98)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_of_a_crowd(spark):
    """More near copies than a window or a block holds."""
    from strongroom.llm.embedding_links import near_duplicates

    rnd = random.Random(8)
    base = [rnd.gauss(0, 1) for _ in range(16)]
    rows = [(i, [x + rnd.gauss(0, 0.05) for x in base], 7) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = near_duplicates(df, window=16, passes=6).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == brute_links(rows, 0.98)


def test_embedding_links_that_no_window_meets(spark):
    """Lone pairs of a dense label that isn't centred, with windows far too small for it."""
    from strongroom.llm.embedding_links import near_duplicates

    rnd = random.Random(9)
    rows = [(i, [3.0 + rnd.gauss(0, 1) for _ in range(16)], 7) for i in range(400)]
    rows += [(400 + i, [x + rnd.gauss(0, 0.3) for x in rows[i][1]], 7) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute_links(rows, 0.98)
    assert sum(n > 0 for _, n, _ in want) > 100
    for block in (1024, 50):
        got = near_duplicates(df, window=1, passes=1, block=block).collect()
        assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == want


# -- search -------------------------------------------------------------------


def test_top_k(spark):
    from strongroom.llm.topk import top_k

    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(300)] + [(i, [0.5] * 6) for i in range(300, 330)]
    rows += [(0, rows[0][1]), (400, None), (450, [None] * 6), (500, [float("nan")] * 6), (550, [1.0]), (600, []), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = top_k(df, df.where("vec_id % 50 = 0"), shard_rows=64, index_rows=32, query_rows=3).collect()
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    want = []
    for q, x in {i: x for i, x in whole if i % 50 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q and len(y) == len(x) > 0)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert top_k(df.limit(0), df.limit(0)).count() == 0


# -- SimHash ------------------------------------------------------------------


def brute_fingerprint(text, width=3):
    from xxhash import xxh64_intdigest

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    h = [xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(max(1, len(words) - width + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, bits):
    group = {k: k for k in prints}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return {k: root(k) for k in prints}


def test_simhash(spark):
    from strongroom.llm.simhash import near_duplicates

    long = " ".join(f"w{k}" for k in range(4000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "One", "en", "a"), (5, "one", "en", "a"), (6, "one two", "en", "a"), (7, "É É é x y", "fr", "a"),
            (8, long, "en", "b"), (9, long + " tail", "en", "b"), (9, long, "en", "b"), (10, "a b c d e f", "en", "b"), (11, "a b c d e g", "en", "b"), (None, "one", None, None)]
    got = near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = {k: brute_fingerprint(r[1]) for k, r in enumerate(rows)}
    groups = brute_groups(prints, 2)
    least = {}
    for k, g in groups.items():
        least[g] = min([x for x in (least.get(g), rows[k][0]) if x is not None], default=None)
    want = sorted([(rows[k][0], f"{prints[k]:016x}", least[groups[k]]) for k in prints], key=str)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=str) == want
    assert near_duplicates(docs(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("bits,cell_rows", [(2, 64), (2, 2), (3, 2)])
def test_simhash_links(spark, bits, cell_rows):
    from strongroom.llm.components import components
    from strongroom.llm.simhash import links

    rnd, prints = random.Random(bits), set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    found = components(links(spark.createDataFrame([(x,) for x in prints], "fp long"), bits, 16, cell_rows), "a", "b").collect()
    got = {r.node: r.component for r in found}
    want = brute_groups({x: x & (2**64 - 1) for x in prints}, bits)
    assert {x: got.get(x, x) for x in prints} == want


def test_components(spark):
    from strongroom.llm.components import components

    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3), (7, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


# -- secrets ------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_secret_scan(spark):
    from strongroom.llm.secrets import redact, scan

    own, common = "Zx9" + "aB3dE5gH7" * 4, "Qq1" + "zY8xW6vU4" * 4
    texts = ["", None, "é token = 'abcdef1' x", 'PassWord:"hunter22"', "secret: token = abcdefgh", "api_key=api_key=abcdef", "token=short", "AKIA" + "A1" * 8, "AKIA" + "A" * 15,
             "deadbeef" * 3, "x" + "0" * 23, "token=" + "ab12" * 10, f"see {own} here", f"see {common} here", f"and {common} there", "AKIAAKIA" + "Z9" * 10, "ſecret=abcdef \U0001f600 token = zzzzzz",
             "token = aaaaaa " * 400]
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(texts)] + [(2, texts[2], "en", "s2"), (None, texts[2], None, None)]
    got = scan(docs(spark, rows), keep=("text",))
    seen = got.withColumn("clean", redact(F.coalesce("text", F.lit("")), F.col("found"))).collect()
    assert len(seen) == len(rows)
    for r in seen:
        base = brute_base(r.text or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), r.text
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex"))
        assert set(base) <= set(r.spans.split(","))
        assert not brute_base(r.clean)
        assert r.n_live + r.n_example == len(r.found)
    by = {r.text: r for r in seen}
    assert by[f"see {own} here"].spans == f"token:4:{4 + len(own)}" and by[f"see {own} here"].clean == "see [SECRET] here"
    assert by[f"see {common} here"].spans == ""  # two owners: an example
    assert by[texts[2]].n_example == 1 and by[texts[3]].n_live == 1
    assert scan(docs(spark, rows).limit(0)).count() == 0


def test_secret_scan_asks_for_evidence(spark):
    from strongroom.llm.secrets import redact, scan

    rng = random.Random(8)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(chars) for _ in range(40)) + "aZ9" for _ in range(30)]
    clean = ["com/Org/Repo2/blob/main/src/Main", "org/wiki/List_of_FIFA_World_Cup_2018_matches", "My-Long-Blog-Post-about-the-Year-2019-and-2020", "AbstractSingletonProxyFactoryBean2Implementation",
             "aA1" * 20, "aB3" + "=" * 40, "Report_2020-01-31_to_2020-02-29_Final"]
    spread = keys[-1]  # one owner's, in four of its repositories
    rows = [(i, f"see {t} here", "en", "s") for i, t in enumerate(keys[:-1] + clean)] + [(100 + k, f"x {spread} y", f"l{k}", "s") for k in range(4)]
    got = scan(docs(spark, rows), keep=("text",))
    seen = {r.doc_id: r for r in got.withColumn("out", redact(F.col("text"), F.col("found"))).collect()}
    assert all(seen[i].spans == f"token:4:{4 + len(k)}" and seen[i].out == "see [SECRET] here" for i, k in enumerate(keys[:-1]))
    for i, t in enumerate(clean, len(keys) - 1):
        assert not any(x.startswith("token") for x in seen[i].spans.split(",")) and seen[i].out == f"see {t} here", t
    assert all(seen[100 + k].spans == "" for k in range(4))
    assert scan(docs(spark, rows), most_repos=4).where("doc_id >= 100 and n_live = 1").count() == 4


def test_secret_spans_that_overlap_are_one(spark):
    from strongroom.llm.secrets import redact, scan

    hexed = "ab12" * 8
    texts = [f"\U0001f600 token={hexed} and {hexed}", f"{hexed}token={hexed}", "token=AKIA" + "A1" * 9 + "." * 30 + f"x {hexed}", "é" * 3000 + f"secret={hexed}" + "\U0001f600" * 2500 + hexed]
    got = scan(docs(spark, [(i, t, "en", f"s{i}") for i, t in enumerate(texts)]), keep=("text",), most_owners=9)
    for r in got.withColumn("out", redact(F.col("text"), F.col("found"))).collect():
        want, at = [], 0
        for s in r.found:
            if s["start"] >= at:
                want.append(r.text[at : s["start"]] + "[SECRET]")
            at = max(at, s["end"])
        assert r.out == "".join(want) + r.text[at:] and r.spans.startswith(",".join(brute_base(r.text))[:8])


def test_secret_scan_takes_time_in_proportion(spark):
    import time

    from strongroom.llm.secrets import redact, scan

    took = {}
    for n in (1000, 50_000, 200_000):
        df = docs(spark, [(1, "".join(f"line {k} token={k:08}abcdef0123456789 end\n" for k in range(n)), "en", "s")])
        start = time.time()
        got = scan(df, keep=("text",)).select("n_assign", "n_hex", F.length(redact(F.col("text"), F.col("found"))).alias("n"), "text").first()
        took[n] = time.time() - start
        assert got.n_assign == got.n_hex == n and got.n == len(got.text) - n * (len("token=") + 24 - len("[SECRET]"))
    assert took[200_000] < 6 * took[50_000] + 5, took


# -- language -----------------------------------------------------------------


def test_language(spark):
    from strongroom.llm.language import identify, learn
    from strongroom.llm.queries import op2_language_id

    truth = {r.doc_id: r.lang for r in table(spark, "documents").select("doc_id", "lang").collect()}
    got = op2_language_id(spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    rows = [(1, "the cat and the hat", "en", "a"), (2, "le chat et la souris", "fr", "a"), (3, None, "fr", "a"), (4, "12 %% !!", "en", "a"), (5, "", None, None),
            (6, "x", None, None), (7, "the hat " * 40_000, None, "a"), (None, "le chat", None, None), (1, "the cat", "en", "a"), (8, "中文字", None, None)]
    df = docs(spark, rows)
    out = {(r.doc_id, r.n_chars): r for r in identify(df, learn(df, "text", "lang"), keep=("doc_id", "n_chars", "component_id")).collect()}
    assert len(out) == len(rows)
    assert [out[k].lang_pred for k in ((3, 0), (4, 8), (5, 0))] == ["und"] * 3
    assert out[7, 320_000].lang_pred == "en" and out[None, 7].lang_pred == "fr"
    none = identify(df, learn(df.limit(0), "text", "lang")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert identify(df.limit(0), learn(df, "text", "lang")).count() == 0


def test_languages_of_one_row_among_many(spark):
    from strongroom.llm.language import learn

    many = spark.range(30_000).select(F.concat(F.lit("the cat and the hat "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(f"le chat {chr(97 + k)}{chr(98 + k)}{chr(99 + k)}", f"x{k:02}") for k in range(20)], "text string, lang string")
    assert learn(many.unionByName(few), "text", "lang")[0] == ["en", *[f"x{k:02}" for k in range(20)]]


def test_language_vectors():
    """Chunks of a long text lose no n-gram, and a text's vector is its n-grams' sum."""
    import numpy as np

    from strongroom.llm import language as L

    numbers, vectors = L.letter_numbers(), L.letter_vectors(64, 1)
    text = "abc déf, ghi " * 20
    x = [0, *[ord(c) if c.isalpha() else 0 for c in text], 0]
    want = sum(vectors[a].astype(int) * np.roll(vectors[b], 1) * np.roll(vectors[c], 2) for a, b, c in zip(x, x[1:], x[2:]) if b)
    for chunk in (1 << 20, 7, 2):
        assert (L.bundles([text, ""], numbers, vectors, chunk)[0] == want).all()


# -- quality ------------------------------------------------------------------


def test_quality(spark):
    from strongroom.llm.quality import paths, score, train
    from strongroom.llm.queries import op7_quality

    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    got = op7_quality(spark, SF).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(got) == table(spark, "documents").count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "one", "en", "a"), (3, "one", "en", "a"), (None, "w " * 30_000, None, None)]
    df = docs(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(3, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert {r.score for r in score(df, train(df, none)).collect()} == {0.5}
    assert {r.score for r in score(df, train(df, one)).collect()} != {0.5}
    assert score(df.limit(0), train(df, none)).count() == 0
    text = "If (feature 0 <= 1.5)\n If (feature 1 > 2.0)\n  Predict: 1.0\n Else (feature 1 <= 2.0)\n  Predict: 0.0\nElse (feature 0 > 1.5)\n Predict: 0.0"
    assert paths(text, ["a", "b"]) == {(("a", "<=", 1.5),), (("a", "<=", 1.5), ("b", ">", 2.0)), (("a", "<=", 1.5), ("b", "<=", 2.0)), (("a", ">", 1.5),)}


# -- mixing -------------------------------------------------------------------


def brute_targets(sizes, weights, times):
    """Share out by weight; what a source can't take is shared among the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(times * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > times * sizes[s]}
        if not over:
            return {s: float(times * sizes[s]) if s in full else share[s] for s in names}
        full |= over


def test_mixing(spark):
    from strongroom.llm.mixing import mix, permuted, taken_texts

    for n in (1, 2, 9, 1000):
        got = [r.p for r in spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(3), 5, 24).alias("p")).collect()]
        assert sorted(got) == list(range(n))
    rnd = random.Random(6)
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(rnd.randint(0, 60))), "en", rnd.choice(["a", "a", "a", "b", "ç", None])) for i in range(150)]
    rows += [(200, None, "en", "a"), (201, "", "en", "empty"), (202, "only three words", "en", "z"), (5, rows[5][1], "en", rows[5][3]), (None, "x y", None, None)]
    df = docs(spark, rows)
    documents, slots = mix(df, keep=("text", "source"), block_words=16)
    got, dealt = documents.collect(), slots.collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes, (5, 2, 1), 3)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r["size"] == len((r.text or "").split()) and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 17 for s in sizes)
    assert sorted(x.slot for x in dealt) == list(range(len(dealt)))
    for s in sizes:
        assert sum(x.length for x in dealt if x.source == s) == taken[s]
    again = mix(df.repartition(5), keep=("text",), block_words=16)[0].collect()
    key = lambda r: (str(r.doc_id), r.text or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    texts = taken_texts(documents, "doc_id", "text", "source", ()).collect()
    assert sum(len(r.text.split()) for r in texts) == sum(taken.values())
    assert mix(df.limit(0))[0].count() == 0


def test_mixing_comes_to_the_target_of_small_sources(spark):
    from strongroom.llm.mixing import mix, permuted

    rng = random.Random(6)
    sizes = {f"s{k:02}": rng.randint(100, 400) for k in range(24)} | {"t": 128, "u": 256, "v": 1, "w": 0}
    rows = []
    for source, size in sizes.items():
        cut = rng.randint(0, size)
        rows += [(len(rows) + k, "w " * n, "en", source) for k, n in enumerate((cut, size - cut))]
    df = docs(spark, rows)
    for block in (7, 128):
        documents, slots = mix(df, keep=("source",), block_words=block)
        got = documents.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
        assert {r.source: r.taken for r in got} == {r.source: math.floor(r.target + 0.5) for r in got} and len(got) == len(sizes)
        assert slots.agg(F.sum("length")).first()[0] == sum(r.taken for r in got) and slots.where("length <= 0").count() == 0
    n = F.lit(97)
    there = spark.range(97).select("id", permuted(F.col("id"), n, F.lit(5), 3, 24).alias("y"))
    assert there.where(permuted(F.col("y"), n, F.lit(5), 3, 24, inverse=True) != F.col("id")).count() == 0


def test_mixing_takes_what_the_slots_say(spark, monkeypatch):
    from strongroom.llm import mixing

    rnd = random.Random(7)
    df = docs(spark, [(i, " ".join(f"w{i}_{k}" for k in range(rnd.randint(1, 60))), "en", rnd.choice(["a", "a", "a", "b", None])) for i in range(80)])
    drawn = mixing.slots
    sizes = lambda mixed: (sum(r.taken for r in mixed[0].collect()), sum(r.length for r in mixed[1].collect()))
    taken, dealt = sizes(mixing.mix(df, block_words=16))
    assert taken == dealt > 0
    monkeypatch.setattr(mixing, "slots", lambda *a: drawn(*a).where("slot % 3 > 0"))
    fewer, left = sizes(mixing.mix(df, block_words=16))
    assert fewer == left < dealt


# -- packing ------------------------------------------------------------------


def test_packing(spark):
    import numpy as np
    from tokenizers import Tokenizer

    from strongroom.llm.packing import pack
    from strongroom.llm.queries import word_bpe

    tokenizer = Tokenizer.from_file(word_bpe())
    odd = ["Tab\tand space x\x1cy\x85z", "é ́x ÀÉÿ × ÷ ß ΣΑΣ ﬁ ½²", "don'T 's it'S 'LL 12 a_b %%% \x00\x7f\xad", "<|endoftext|> a <|startoftext|>", "中文 \U0001f600 ‍﻿", "\r\n \n\n x  y "]
    rows = [(k, t, None, None) for k, t in enumerate([*odd, None, "", "word " * 9000, "a"])] + [(0, odd[0], None, None), (None, "x", None, None)]
    real = table(spark, "documents").limit(200).select("doc_id", "text").collect()
    rows += [(1000 + r.doc_id, r.text, None, None) for r in real]
    got = pack(docs(spark, rows), word_bpe(), group_tokens=1 << 14).collect()
    want, pieces, sequences = {}, {}, {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    for r in got:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, texts in want.items():
        at = {}
        for r in pieces[i]:
            at.setdefault(r.start, []).append(r)
        assert sum(r.length for r in pieces[i]) == sum(map(len, texts)) and {r.doc_tokens for r in pieces[i]} == set(map(len, texts))
        if len(texts) == 1:
            whole = [x for s in sorted(at) for x in at[s][0].ids]
            assert whole == texts[0] and all(len(x) == 1 for x in at.values())
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096 and end & (end - 1) == 0  # full, or a power of two: no padding
    assert pack(docs(spark, rows).limit(0), word_bpe()).count() == 0


def test_packing_balances_cost():
    from strongroom.llm.packing import assign, capacities, cost

    rnd = random.Random(1)
    lengths = [rnd.randint(1, 4000) for _ in range(600)]
    out = list(assign(lengths, 4096, 1.0, 1 / 4096))
    caps = capacities(sum(lengths), 4096)
    spent = [0.0] * len(caps)
    for _, _, n, k, _ in out:
        spent[k] += cost(n, 1.0, 1 / 4096)
    full = [s for s, c in zip(spent, caps) if c == 4096]
    alone = cost(4000, 1.0, 1 / 4096)
    assert max(full) <= max(alone + cost(96, 1.0, 1 / 4096), 1.5 * sum(full) / len(full))


# -- HTML ---------------------------------------------------------------------


def test_extraction_of_the_table(spark):
    import html

    from strongroom.llm.queries import op10_html_extraction

    pages = {r.page_id: r.html for r in table(spark, "pages").collect()}
    got = op10_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:h1|p)>", re.sub("<[^>]*$", "", article))]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_extraction_cases(spark):
    from strongroom.llm.html_text import extract

    body = "".join(f"<p>Paragraph {k} of the article has quite a few words in it, as they do.</p>" for k in range(4))
    noise = ("<header><a href=/>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class='cookie-notice'>We use cookies</div><aside>Also</aside>"
             "<form><label>Name</label><input></form><script>var x = '<p>no</p>';</script><style>p{}</style><div id=comments><p>First! A comment of a reader that is long enough.</p></div><footer>&copy; us</footer>")
    want = "\n\n".join(["Title & more", *[f"Paragraph {k} of the article has quite a few words in it, as they do." for k in range(4)], "End."])
    cases = {
        f"<html><body>{noise}<article class='post'><h1>Title &amp;\n more</h1>{body}<p>End.</article>{noise}": want,
        f"<body>{noise}<div class='page has-sidebar'><div class='story'><h1>Title &#38; more</h1>{body}<p>End.</div></div>{noise}</body>": want,
        f"<main><h1>Title &amp; <b>more</b></h1>{body}<div class=ad>Buy!</div><p>End.</p></main><p>Outside of it": want,
        f"<article><header><nav>x</nav><h1>Title &amp; more</h1></header>{body}<p>End.</p><ar": want,
        "": "", None: "", "plain   text": "plain text", "<p>a&lt;b<br>c": "a<b c", "<nav>x</nav>": "", "<script>x": "",
    }
    rows = [(k, "u", h, "x") for k, h in enumerate(cases)] + [(0, "u", next(iter(cases)), "x"), (None, None, "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert r.text == list(cases.values())[r.page_id], r
        assert r.n_chars == len(r.text)
    assert extract(df.limit(0)).count() == 0


def test_extraction_drops_boilerplate_of_flat_pages_and_overrules_words():
    from strongroom.llm.html_text import main_text

    told = [f"Paragraph {k} of the article has quite a few words in it, as they do when someone writes a text." for k in range(5)]
    body = "".join(f"<p>{t}</p>" for t in told[:3]) + "<p>Short one.</p>" + "".join(f"<p>{t}</p>" for t in told[3:])
    want = "\n\n".join(["Title", *told[:3], "Short one.", *told[3:]])
    menu = "<ul><li><a href=/>Home</a><li><a href=/a>About us</a><li><a href=/c>Contact</a></ul><div>We use cookies</div>"
    links = "<h3>More</h3><ul><li><a href=/1>One more page of this site</a><li><a href=/2>Two more pages</a></ul><div>Copyright us</div>"
    flat = f"{menu}<h1>Title</h1>{body}{links}"
    for page in (f"<html><body>{flat}</body></html>", f"<body><div>{flat}</div></body>", f"<body><form id=aspnetForm>{flat}</form></body>", f"<div class='page search related'>{flat}</div>",
                 f"<html><head><title>T</title><meta charset=utf8><body>{flat}", f"<head><title>T</title><h1>Title</h1>{body}"):
        assert main_text(page) == want, page
    widgets = "".join(f"<div class='elementor-widget elementor-widget-text'><p>{t}</p></div>" for t in told)
    assert main_text(f"<body><div>{menu}{widgets}</div></body>") == "\n\n".join(told)
    article = f"<article><h1>Title</h1>{body}<ul><li>Plain item</ul><div><a href=/x>Read this too</a></div></article>"
    assert main_text(f"<body>{menu}{article}{links}") == want + "\n\nPlain item"


def test_extraction_keeps_all_of_an_article():
    from strongroom.llm.html_text import main_text

    long = "word " * 60 + "end."
    body = f"<p>{long}</p><p>{long}</p>"

    def text_of(inner):
        return main_text(f"<body><nav><ul><li><a href=/>Home</a></ul></nav><article>{inner}</article><footer>gone</footer></body>").split("\n\n")

    assert text_of(f"<h1>T</h1><p><a href=x>The whole report</a></p>{body}<p>See <a href=y>the long list of sources</a></p>") == ["T", "The whole report", long, long, "See the long list of sources"]
    assert text_of(f"<p>{long}</p><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul><p>Short.</p>") == [long, "One", "Two", "Short."]
    assert text_of(f"<div>By hand</div><section>Opening line</section>{body}<b>closing words</b>") == ["By hand", "Opening line", long, long, "closing words"]
    for name in ("share-price", "safety-notice", "search-history", "sharePrice", "has-sidebar"):
        assert text_of(f'{body}<p class="{name}">It rose by 3 per cent.</p><p>x</p>') == [long, long, "It rose by 3 per cent.", "x"], name
    for name in ("ad", "ad-slot", "cookie-notice", "newsletter signup", "relatedPosts", "site_footer", "notice", "comment-list"):
        assert text_of(f'{body}<p class="{name}">Buy one now.</p><p>x</p>') == [long, long, "x"], name
    # A list of links before or after the prose isn't its text.
    more = "<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>"
    assert text_of(f"<h1>T</h1>{more}{body}{more}") == ["T", long, long]
    # An open comment goes on to the end, as in a browser; short ones end at once.
    assert text_of(f"{body}<!-- open <p>not shown</p> <b>nor this</b>") == [long, long]
    assert text_of(f"{body}<!-- a > b --><p>shown</p><!----><p>too</p>") == [long, long, "shown", "too"]
    assert text_of(f"<script>var a = '<!--';</script>{body}") == [long, long]
    # Growth: a page of many lines takes time in proportion.
    assert text_of("".join(f"<p>line {k}</p>" for k in range(30_000)))[-1] == "line 29999"


def test_extraction_keeps_text_after_a_sign_that_starts_no_tag():
    from strongroom.llm.html_text import main_text

    rest = "then the rest of the page " * 20
    for sign in ("< b", "<3", "<= b", "<"):
        assert main_text(f"<p>if a {sign} {rest}") == f"if a {sign} {rest}".strip()
    assert main_text("<p>some text</p><a hr") == main_text("<p>some text</p></p") == main_text("<p>some text</p><!-- x") == "some text"
    assert main_text("<p>a <") == "a <"
